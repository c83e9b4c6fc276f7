"""Files, topics and catalog tables as DataFrames."""

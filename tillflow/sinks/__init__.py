"""Writers to files, topics and catalog tables."""

"""Sales records as Spark tables and streams: read, clean, relay, measure, land."""

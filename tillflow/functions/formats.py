"""Text-format options shared by readers and writers."""

# Spark's CSV and JSON writers cut timestamps to milliseconds unless told otherwise.
EXACT_TIMESTAMPS = {
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}

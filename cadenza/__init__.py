"""Music-listening analytics on PySpark: stream, lake, landing, star schema, reports."""

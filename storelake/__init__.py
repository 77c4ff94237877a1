"""storelake: a Spark-native commerce lakehouse (ingest, staging, star schema, tests, analytics)."""

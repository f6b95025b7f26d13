"""A PySpark-native engine that turns fetched web pages into a clean, queryable recipe corpus."""

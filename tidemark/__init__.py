"""A Spark-native engine for database change streams."""

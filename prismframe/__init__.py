"""A Spark-native engine for comparing how outlets, countries and languages cover the same events."""

"""A Spark-native engine for provenance-aware text archives."""

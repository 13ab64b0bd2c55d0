"""tidemark: a PySpark-native analytics engine for multi-source time-series, array and text data."""

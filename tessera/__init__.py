"""A PySpark-native analytics engine for regulatory guide text."""

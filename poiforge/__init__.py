"""PySpark-native point-of-interest conflation engine."""

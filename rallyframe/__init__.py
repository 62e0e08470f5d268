"""A PySpark-native analytics engine for racket-sport tournament results."""

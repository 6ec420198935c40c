"""A PySpark-native engine that builds, resolves, merges, validates and analyses property graphs."""

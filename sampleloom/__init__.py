"""sampleloom: a PySpark-native engine that turns free-text sample metadata into standard, scored tables."""

__version__ = "0.1.0"

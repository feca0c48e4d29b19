"""weftline: a PySpark-native data integration and transform engine."""

__version__ = "0.1.0"

"""terrasift: a PySpark-native engine for integrating dirty geospatial feeds."""

__version__ = "0.1.0"

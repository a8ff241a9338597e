"""filigree: a PySpark-native analytics engine for company-filing data."""

__version__ = "0.1.0"

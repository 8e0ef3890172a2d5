"""PySpark-native retail demand analytics: tables in, tables out."""

__version__ = "0.1.0"

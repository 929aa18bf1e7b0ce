"""Lakeline: a PySpark-native engine for document-centric public-records data."""

__version__ = "0.1.0"

"""Operators for preparing text as training data; nothing outside this package imports it."""

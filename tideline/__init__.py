"""Tideline: change-log analytics for PySpark."""

__version__ = "0.1.0"

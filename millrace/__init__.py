"""Millrace: a layered retail event warehouse as PySpark DataFrame transforms."""

__version__ = "0.1.0"

"""Retail order-line analytics as lazy Spark DataFrame operators."""

__version__ = "1.0.0"

"""Operators for preparing training data, and the queries that apply them."""

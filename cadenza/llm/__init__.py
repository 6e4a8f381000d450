"""Operators of a training-data pipeline over document, benchmark and embedding tables."""

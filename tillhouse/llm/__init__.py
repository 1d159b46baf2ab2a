"""Operators of a training-data pipeline over web documents; their queries are in ``queries.py``."""

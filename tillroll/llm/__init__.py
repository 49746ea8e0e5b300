"""Operators of a training-data pipeline (corpus scans, deduplication, scoring, encoding).

Nothing outside this package imports it; ``queries.py`` holds the registered
queries and their SQL.
"""

"""Operators of a training-data pipeline: dedup, scoring, mixing, tokenising, output.

Nothing outside this package imports it.
"""

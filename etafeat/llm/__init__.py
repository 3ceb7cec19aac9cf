"""Operators of a training-data pipeline: near duplicates, filters, scoring, mixing, formatting."""

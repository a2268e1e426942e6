"""Operators of a training-data pipeline: dedup, search, scoring, mixing, extraction, tokens, privacy."""

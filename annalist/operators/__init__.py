"""Operators over DataFrames: hierarchies, matching, places, checks, ordered rows, aggregates."""

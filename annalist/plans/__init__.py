"""Queries: parameterised views of the compiled records, and the registry."""

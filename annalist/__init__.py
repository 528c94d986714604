"""A PySpark-native engine for noisy historical records: parsing, matching, hierarchies, places, checks, queries."""

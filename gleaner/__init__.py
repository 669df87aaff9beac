"""Gleaner: a PySpark-native engine for resumable, partitioned harvests of records and files."""

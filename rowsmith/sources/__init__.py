"""Readers and writers for CSV and Parquet tables."""

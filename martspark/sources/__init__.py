"""Readers and writers (parquet, CSV, JDBC), table schemas and the stand-in tables."""

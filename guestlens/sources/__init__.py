"""Delimited input and the Parquet warehouse."""

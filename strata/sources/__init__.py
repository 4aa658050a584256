"""Readers and writers: delimited text by contract, Parquet, JSON, sinks."""

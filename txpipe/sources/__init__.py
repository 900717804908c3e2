"""Readers and writers: the driver's tables, daily Parquet files, JSON messages."""

"""Readers and writers: declared schemas, multi-file scans, CSV/Parquet sinks, model I/O."""

"""Sinks: Parquet (plain and partitioned), tables, CSV, JSON documents."""

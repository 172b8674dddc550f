"""Sources: driver tables, files (CSV/Parquet/JSON), month-sliced scans, lookups."""

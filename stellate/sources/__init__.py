"""Table sources: Parquet and delimited files, plus driver-table adapters."""

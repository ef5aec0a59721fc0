"""Reading and writing of named tables, CSV and parquet folders."""

"""Reading delimited files and keeping published tables as plain parquet."""

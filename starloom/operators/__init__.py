"""Table operators: DataFrames in, DataFrames out. Nothing here writes a published table."""

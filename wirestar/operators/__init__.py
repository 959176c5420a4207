"""Pure transformations: DataFrames in, one DataFrame out, nothing written to a table."""

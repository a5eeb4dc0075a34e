"""DataFrame operators: DataFrames and column names in, one DataFrame out."""

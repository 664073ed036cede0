"""DataFrame operators: DataFrames in, DataFrame out, nothing executed."""

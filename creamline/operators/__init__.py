"""Table-level operators: DataFrames in, DataFrame out, nothing executed on the driver."""

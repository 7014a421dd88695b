"""The analytical questions, one function each: DataFrames in, DataFrame out."""

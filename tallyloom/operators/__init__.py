"""Building blocks: DataFrames in, DataFrame out."""

"""Analytics over research-output records, and training-data operators, on Spark DataFrames."""

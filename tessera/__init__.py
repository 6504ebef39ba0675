"""Analytics on Spark DataFrames: listing pipelines and the relational operators under them."""

"""Analytics over the citation history of versioned pages, on Spark DataFrames."""

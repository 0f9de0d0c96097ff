"""tidebook: market-data analytics on PySpark DataFrames."""

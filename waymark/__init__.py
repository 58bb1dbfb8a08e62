"""waymark: address-point analytics and corpus preparation on Spark DataFrames."""

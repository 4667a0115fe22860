"""Record linkage, prioritised merging and classification data on Spark DataFrames."""

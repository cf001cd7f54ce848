"""Document-corpus retrieval and training-data operators on Spark DataFrames."""

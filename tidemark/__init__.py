"""Tidemark: a change-data-capture apply engine and training-data operators on Spark DataFrames."""

"""Operators that prepare text for training, each a function from DataFrames to a DataFrame."""

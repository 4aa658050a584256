"""Operators of a training-data pipeline, each a function from DataFrames to a DataFrame.

Nothing else in the library imports this subpackage.
"""

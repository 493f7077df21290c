"""Operators: DataFrame (and parameters) in, DataFrame out."""

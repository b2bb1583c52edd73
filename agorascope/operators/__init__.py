"""Operators: DataFrame in, DataFrame out, nothing read or written."""

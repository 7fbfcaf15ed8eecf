"""Operators over mail tables: DataFrame in, DataFrame out."""

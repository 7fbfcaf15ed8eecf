"""Columns that are computed exactly once per row."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that no later step can make Spark compute again.

    A filter on a projected column is pushed below the projection with the column's expression
    copied into it, once per use.  Over a chain of text columns the copies multiply: a filter on a
    screening result would mask every mail many times over.  Rows produced by `inline` stop that,
    because a filter on what a generator puts out stays above it.  The array always has one
    element, so there is one row out per row in, still inside the same stage.
    """
    row = F.struct(*[expr.alias(name) for name, expr in columns.items()])
    return df.select("*", F.inline_outer(F.array(row)))

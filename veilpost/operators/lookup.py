"""Matching every mail against a small reference table.

Knowledge bases and gazetteers often have tens of rows, mails have billions.  While the reference table
is small enough (rows and bytes are measured first) it travels inside the plan as one constant
array and the mails are never shuffled.  Every operator has another way for larger tables, which gives the same rows.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shuffles_dropped
from .stage import computed_once

MAX_INLINE_ROWS = 2_000
MAX_INLINE_BYTES = 4 << 20


def _entry(order: str, fields: list[str]) -> Column:
    return F.struct(F.col(order), *[F.col(f) for f in fields if f != order])


def pack_small(table: DataFrame, order: str, fields: list[str], max_rows: int) -> tuple[str, str] | None:
    """All rows of a small table, ordered, as JSON text with its Spark type; None if it is too large.

    No more than one row beyond the limit is looked at.
    """
    head = table.limit(max_rows + 1).select(_entry(order, fields).alias("entry"))
    fits = (F.col("rows") <= max_rows) & (F.octet_length("text") <= MAX_INLINE_BYTES)
    packed = head.agg(
        F.count(F.lit(1)).alias("rows"), F.to_json(F.sort_array(F.collect_list("entry"))).alias("text")
    )
    with shuffles_dropped(table.sparkSession):
        text = packed.select(F.when(fits, F.col("text"))).first()[0]
    return None if text is None else (text, f"array<{head.schema['entry'].dataType.simpleString()}>")


def match_entries(
    df: DataFrame,
    table: DataFrame,
    order: str,
    fields: list[str],
    small: Callable[[Column], Column],
    large: Callable[[], DataFrame],
    out: str,
    max_rows: int = MAX_INLINE_ROWS,
    whole: Callable[[str, str], Column] | None = None,
) -> DataFrame:
    """Add `out = small(entries)` to every row of `df`, or give `large()` if the table is no small one.

    `small` gets the entries as an array ordered by `order`, which is unique in `table`.  `whole` may give a
    faster way to the same answer, from their JSON text and type.
    """
    packed = pack_small(table, order, fields, max_rows)
    if packed is None:
        return large()
    answer = whole(*packed) if whole else small(F.from_json(F.lit(packed[0]), packed[1]))
    return computed_once(df, **{out: answer})

"""Semantic PII: detection by dictionary or plug-in, masking of the detected values."""

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions import patterns as P
from ..functions.text import count_literal, longest_first, once, strip
from ..schemas import FINDING, SEMANTIC_ITEM
from .anchors import match_values
from .lookup import MAX_INLINE_ROWS, match_entries
from .score import replies_or_errors
from .stage import computed_once


def detect_with_gazetteer(
    df: DataFrame,
    gazetteer: DataFrame,
    text: str = "masked_email",
    key: str = "email_id",
    out: str = "semantic_items",
    max_rows: int = MAX_INLINE_ROWS,
) -> DataFrame:
    """Entries of `gazetteer(item_no, type, value)` whose value occurs in the text, by item number.

    Entries without a value, or with an empty one, occur nowhere.  Up to `max_rows` entries are tried one by one; more are
    met on anchors in one pass over each text.
    """
    entries = gazetteer.where(F.octet_length("value") > 0)
    fields = ["item_no", "type", "value"]

    def small(entries: Column) -> Column:
        return F.filter(entries, lambda e: F.contains(F.col(text), e["value"]))

    def large() -> DataFrame:
        # Item numbers only order the items.
        return match_values(df, entries, text, out, fields, "value", key, by_number=True)

    matched = match_entries(df, entries, "item_no", fields[1:], small, large, out, max_rows)
    items = F.transform(out, lambda e: F.struct(e["type"].alias("type"), e["value"].alias("value")))
    # A text that is missing has no items.
    return matched.withColumn(out, F.coalesce(items, F.array()).cast(f"array<{SEMANTIC_ITEM}>"))


def detect_with_model(
    df: DataFrame,
    reply_of: Callable[[pd.Series], pd.Series],
    text: str = "masked_email",
    out: str = "semantic_items",
    error_out: str | None = None,
) -> DataFrame:
    """Ask a plug-in for one reply text per mail, batch by batch.

    A batch that raises is asked again row by row; only the mails that raise yield no items.  Their
    errors go to the column `error_out`, if one is named.
    """

    @F.pandas_udf("reply string, error string")
    def ask(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            replies, errors = replies_or_errors(reply_of, batch)
            yield pd.DataFrame({"reply": pd.Series(replies, dtype=object), "error": pd.Series(errors, dtype=object)})

    # Not deterministic: no filter may copy the call.
    asked = df.withColumn("__asked", ask.asNondeterministic()(text))
    if error_out:
        asked = asked.withColumn(error_out, F.col("__asked.error"))
    return asked.withColumn(out, parse_item_list(F.col("__asked.reply"))).drop("__asked")


def no_items(df: DataFrame, out: str = "semantic_items") -> DataFrame:
    return df.withColumn(out, F.array().cast(f"array<{SEMANTIC_ITEM}>"))


def parse_item_list(reply: Column) -> Column:
    """Items of a reply that is a JSON list, or that holds one between its first [ and last ].

    Anything else gives an empty list: an object, a bare value or text that is not JSON.  Elements that
    are no objects are skipped.
    """
    whole = strip(reply)
    is_json = F.json_array_length(whole).isNotNull() | F.json_object_keys(whole).isNotNull()
    candidate = F.when(is_json, whole).otherwise(F.regexp_extract(reply, P.LIST_SLICE, 0))
    elements = F.when(F.json_array_length(candidate).isNotNull(), F.from_json(candidate, "array<string>"))
    objects = F.filter(elements, lambda e: F.json_object_keys(e).isNotNull())
    items = F.filter(F.transform(objects, lambda e: F.from_json(e, SEMANTIC_ITEM)), lambda i: i.isNotNull())
    return F.coalesce(items, F.array().cast(f"array<{SEMANTIC_ITEM}>"))


def valid_items(text: Column, items: Column) -> Column:
    """Items with type and value whose value occurs in the text, longest value first."""
    filled = F.filter(
        items, lambda i: (F.coalesce(i["type"], F.lit("")) != "") & (F.coalesce(i["value"], F.lit("")) != "")
    )
    tidy = F.transform(
        filled,
        lambda i: F.struct(strip(F.upper(i["type"])).alias("type"), strip(i["value"]).alias("value")),
    )
    present = F.filter(tidy, lambda i: (i["value"] != "") & F.contains(text, i["value"]))
    return longest_first(present, lambda i: F.length(i["value"]))


def mask_items(
    df: DataFrame,
    text: str = "masked_email",
    items: str = "semantic_items",
    findings: str = "detected_pii",
) -> DataFrame:
    """Replace the values one after another and append one finding per item.

    A value is counted when its turn comes, so it may count 0 when a longer one covered it, and it
    may hit text an earlier mask put there.
    """
    start = F.struct(F.col(text).alias("text"), F.array().cast(f"array<{FINDING}>").alias("found"))

    def step(state: Column, item: Column) -> Column:
        tag = F.concat(F.lit("[MASKED_"), item["type"], F.lit("]"))
        found = F.struct(
            item["type"].alias("type"),
            F.lit(fixed.METHOD_SEMANTIC).alias("method"),
            count_literal(state["text"], item["value"]).alias("count"),
            tag.alias("masked_as"),
        )
        return F.struct(
            F.replace(state["text"], item["value"], tag).alias("text"),
            F.array_append(state["found"], found).cast(f"array<{FINDING}>").alias("found"),
        )

    def masked_with(usable: Column) -> Column:
        return F.when(F.size(usable) > 0, F.aggregate(usable, start, step)).otherwise(start)

    usable = valid_items(F.col(text), F.col(items))
    return (
        computed_once(df, __state=once(usable, masked_with))
        .withColumn(text, F.col("__state.text"))
        .withColumn(findings, F.concat(findings, "__state.found"))
        .drop("__state")
    )

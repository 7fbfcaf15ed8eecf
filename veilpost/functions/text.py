"""Text expressions shared by the operators."""

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P


def strip(text) -> Column:
    """Trim every kind of white space on both ends (`trim` only knows the blank)."""
    return F.btrim(text, F.lit(P.SPACE_LIST))


def first_group(text, pattern: str) -> Column:
    """Group 1 of the first match, or NULL where nothing matches (the group is never empty)."""
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def contains_any(text: Column, words) -> Column:
    return reduce(or_, [F.contains(text, F.lit(w)) for w in words], F.lit(False))


def phrase_hits(text: Column, phrases) -> Column:
    """One boolean per phrase, in the order given."""
    return F.array(*[F.contains(text, F.lit(p)) for p in phrases])


def count_literal(text: Column, value: Column) -> Column:
    """Non-overlapping occurrences of a literal, as INT."""
    removed = F.length(text) - F.length(F.replace(text, value, F.lit("")))
    return F.when(F.length(value) > 0, (removed / F.length(value)).cast("int")).otherwise(F.lit(0))


def first_filled(*values) -> Column:
    """First value that is neither NULL nor the empty string, else ''."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values], F.lit(""))


def clean_tokens(tokens: Column) -> Column:
    """Strip tokens, drop empty ones; NULL list becomes an empty one.  A NULL token reads 'None'."""
    stripped = F.transform(tokens, lambda t: strip(F.coalesce(t, F.lit("None"))))
    kept = F.filter(stripped, lambda t: t != "")
    return F.coalesce(kept, F.array().cast("array<string>"))


def once(value: Column, use) -> Column:
    """`use(value)` with the value evaluated once, also where `use` reads it inside a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def tokens_in_text(text: Column, tokens: Column) -> Column:
    """Tokens found in the text, whatever the letter case."""
    return once(F.lower(text), lambda low: F.filter(tokens, lambda t: F.contains(low, F.lower(t))))


def longest_first(items: Column, length_of) -> Column:
    """Stable order by descending length: position breaks ties."""
    keyed = F.transform(
        items, lambda x, i: F.struct((-length_of(x)).alias("k"), i.alias("i"), x.alias("x"))
    )
    return F.transform(F.array_sort(keyed), lambda s: s["x"])

"""Retrieval: nearest knowledge-base rows, indicator ranking, context and prompt texts."""

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions.text import once
from .anchors import match_values
from .balls import nearest_in_balls
from .lookup import MAX_INLINE_ROWS, match_entries
from .stage import computed_once


def squared_l2(a: Column, b: Column) -> Column:
    """Squared distance in double precision, summed from the first component to the last."""
    terms = F.zip_with(a, b, lambda x, y: (x.cast("double") - y) * (x.cast("double") - y))
    return F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t)


def _nearest_of(centers: list[np.ndarray], k: int):
    """Pandas UDF: the k nearest centers of each vector, by distance and then by position.

    Squares are added from the first component to the last, as `squared_l2` adds them, so both give the
    same doubles.  Centers of another length are no neighbours.
    """
    by_length = {}
    for at, center in enumerate(centers):
        by_length.setdefault(len(center), []).append(at)
    grids = {size: (np.array(at), np.stack([centers[i] for i in at])) for size, at in by_length.items()}

    def nearest_rows(rows: np.ndarray):
        places, grid = grids[rows.shape[1]]
        distances = np.zeros((len(rows), len(grid)))
        for one, other in zip(rows.T, grid.T):
            distances += np.square(one[:, None] - other[None, :])
        first = np.argsort(distances, axis=1, kind="stable")[:, :k]
        for row, chosen in zip(distances, first):
            yield [{"distance": row[p], "at": int(places[p])} for p in chosen]

    @F.pandas_udf("array<struct<distance:double,at:int>>")
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            found = pd.Series([[] for _ in range(len(batch))], index=batch.index, dtype=object)
            given = batch[batch.notna()]
            lengths = given.map(len)
            for size in set(lengths) & grids.keys():
                rows = given[lengths == size]
                stacked = np.stack(rows.to_list()).astype("float64").reshape(len(rows), size)
                for at, neighbours in zip(rows.index, nearest_rows(stacked)):
                    found[at] = neighbours
            yield found

    return search


def nearest(
    df: DataFrame,
    kb: DataFrame,
    k: int,
    key: str = "email_id",
    vector: str = "vector",
    kb_id: str = "id",
    kb_vector: str = "vector",
    out: str = "nearest",
    max_rows: int = MAX_INLINE_ROWS,
    carry: list[str] = (),
) -> DataFrame:
    """Exact k nearest rows of `kb` by squared L2 as `array<struct<distance, id>>`; id breaks ties.

    `carry` adds further columns of `kb` to the structs.  Vectors that are NULL or hold NULL, on either side,
    and vectors of different lengths are no neighbours.

    Distances to a small knowledge base are matrix work on Arrow batches: numpy is some hundred
    times faster at it than lambdas over arrays.  Entries of a large one are visited by balls, as far as
    the neighbours found so far leave room for nearer ones.
    """
    def complete(v: Column) -> Column:
        return F.when(F.forall(v, lambda x: x.isNotNull()), v.cast("array<double>"))

    table = kb.select(F.col(kb_id).alias("id"), complete(F.col(kb_vector)).alias("kb_vector"), *carry).where(
        "kb_vector IS NOT NULL"
    )
    given = complete(F.col(vector))

    def hit(distance: Column, e: Column) -> Column:
        return F.struct(distance.alias("distance"), e["id"].alias("id"), *[e[c].alias(c) for c in carry])

    def small(entries: Column) -> Column:
        hits = F.transform(entries, lambda e: hit(squared_l2(given, e["kb_vector"]), e))
        return F.slice(F.sort_array(F.filter(hits, lambda h: h["distance"].isNotNull())), 1, k)

    def large() -> DataFrame:
        return nearest_in_balls(df, table, given, k, out, list(carry))

    def whole(text: str, entry_type: str) -> Column:
        centers = [np.array(e["kb_vector"], dtype="float64") for e in json.loads(text)]
        entries = F.from_json(F.lit(text), entry_type)
        found = _nearest_of(centers, k)(given)
        return F.transform(found, lambda n: hit(n["distance"], F.get(entries, n["at"])))

    return match_entries(df, table, "id", ["kb_vector", *carry], small, large, out, max_rows, whole=whole)


def rank_by_indicators(
    df: DataFrame,
    phrases: DataFrame,
    k: int = fixed.TOP_TECHNIQUES,
    text: str = "email_body",
    key: str = "email_id",
    out: str = "techniques",
    max_rows: int = MAX_INLINE_ROWS,
) -> DataFrame:
    """Techniques by number of indicator phrases in the text, most first; id breaks ties.

    Stands in for vector retrieval where no embedding model is at hand.
    """

    def first(ranked: Column) -> Column:
        return F.slice(F.sort_array(ranked), 1, k)

    def small(entries: Column) -> Column:
        def rank_in(low: Column) -> Column:
            ranked = F.transform(
                entries,
                lambda e: F.struct(
                    (-F.size(F.filter(e["phrases"], lambda p: F.contains(low, p)))).alias("neg_hits"),
                    e["id"].alias("id"),
                ),
            )
            return first(F.filter(ranked, lambda r: r["neg_hits"] < 0))

        return once(F.lower(text), rank_in)

    def large() -> DataFrame:
        """All phrases are looked for in one pass over the text, each with the technique it speaks for."""
        each = phrases.select("id", F.posexplode("phrases").alias("at", "phrase"))
        low = computed_once(df, __low=F.lower(text))
        found = match_values(low, each, "__low", "__hits", ["id", "at", "phrase"], "phrase", key)
        ids = F.transform("__hits", lambda h: h["id"])
        counted = F.transform(
            F.array_distinct(ids),
            lambda i: F.struct((-F.size(F.filter("__hits", lambda h: h["id"] == i))).alias("neg_hits"), i.alias("id")),
        )
        return found.withColumn(out, first(counted)).drop("__low", "__hits")

    ranked = match_entries(df, phrases, "id", ["phrases"], small, large, out, max_rows)
    return ranked.withColumn(
        out, F.transform(out, lambda r: F.struct(r["id"].alias("id"), (-r["neg_hits"]).alias("hits")))
    )


def technique_context(techniques: Column) -> Column:
    """'- id: text' per technique in rank order, one line each."""
    lines = F.transform(
        techniques,
        lambda t: F.concat(
            F.lit("- "), t["technique"], F.lit(": "), F.substring(t["description"], 1, fixed.CONTEXT_TECHNIQUE_CHARS)
        ),
    )
    return F.array_join(lines, "\n")


def example_context(examples: Column) -> Column:
    """Two lines per example in rank order: the start of the mail, then its label and reason."""
    lines = F.transform(
        examples,
        lambda e: F.concat(
            F.lit("Example: "),
            F.substring(e["email"], 1, fixed.CONTEXT_EXAMPLE_CHARS),
            F.lit("...\nLabel: "),
            e["label"],
            F.lit(", Reason: "),
            e["reason"],
        ),
    )
    return F.array_join(lines, "\n")


# The wording of this template is our own; any other with the same seven slots can be passed in.
JUDGE_TEMPLATE = """Decide whether the mail below is a phishing or payment-fraud attempt.

Sender domain: %s
Subject: %s
Urgency words present: %s
Money request present: %s

Mail body:
%s

Known techniques close to this mail:
%s

Labelled mails close to this one:
%s

A sender domain of "not_extracted" says nothing either way. Judge by what the body asks for, and use
the most specific technique id. Answer with one JSON object and nothing else, with the fields
is_phishing (true or false), risk_score (0.0 to 1.0), mitre_technique, why_malicious_context (at most
80 characters) and high_risk_tokens (phrases copied from the body)."""


def judge_prompt(
    parsed: Column, technique_lines: Column, example_lines: Column, template: str = JUDGE_TEMPLATE
) -> Column:
    """Prompt text for a scorer outside Spark, made from the parsed mail and its context lines."""
    flags = parsed["metadata"]
    return F.format_string(
        template,
        parsed["sender_domain"],
        parsed["subject"],
        flags["has_urgency_keywords"].cast("string"),
        flags["has_money_request"].cast("string"),
        parsed["email_body"],
        technique_lines,
        example_lines,
    )

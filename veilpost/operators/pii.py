"""Structured PII: masking in a fixed order, findings, residual check.

Each type is counted and replaced in the text as the earlier types left it, so masking is a chain.
All of it is row work: one scan, no shuffle.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions import patterns as P
from ..schemas import FINDING, RESIDUAL
from .stage import computed_once


def mask_tag(pii_type: str) -> str:
    return f"[MASKED_{pii_type}]"


def count_type(text, pii_type: str) -> Column:
    """Number of matches of one type; rows without the type's required literal are not scanned."""
    text = F.col(text) if isinstance(text, str) else text
    literal = P.REQUIRED_LITERAL.get(pii_type)
    pattern = F.lit(P.PII[pii_type])
    if literal is None:
        return F.regexp_count(text, pattern)
    scanned = text
    if pii_type in P.LINE_BOUND:
        lines = F.filter(F.split(text, "\n"), lambda line: F.contains(line, F.lit(literal)))
        scanned = F.array_join(lines, "\n")
    has_literal = F.contains(text, F.lit(literal))
    return F.when(has_literal, F.regexp_count(scanned, pattern)).when(text.isNotNull(), F.lit(0))


def _masked(text: str, pii_type: str, count: str) -> Column:
    """The text with one type masked; only rows with a hit pay for the replacement."""

    def replaced(part) -> Column:
        return F.regexp_replace(part, P.PII[pii_type], F.lit(mask_tag(pii_type)))

    whole = F.col(text)
    if pii_type in P.LINE_BOUND:
        literal = F.lit(P.REQUIRED_LITERAL[pii_type])
        lines = F.transform(
            F.split(whole, "\n"), lambda line: F.when(F.contains(line, literal), replaced(line)).otherwise(line)
        )
        masked = F.array_join(lines, "\n")
    else:
        masked = replaced(whole)
    return F.when(F.col(count) > 0, masked).otherwise(whole)


def mask_type(df: DataFrame, pii_type: str, text: str, masked: str, count: str) -> DataFrame:
    """Add `count` and `masked` for one type."""
    return df.withColumn(count, count_type(text, pii_type)).withColumn(masked, _masked(text, pii_type, count))


def mask_structured(
    df: DataFrame,
    text: str = "raw_email",
    masked: str = "masked_email",
    findings: str = "detected_pii",
    scan: str | None = None,
) -> DataFrame:
    """All types in masking order; `findings` lists the types with at least one hit.

    `scan` names a column for what `residual_check` can skip: the masked text and the last step with a hit.

    The chain is one select whose columns refer to those before them.  Text and counts pass through
    `computed_once`, so a filter on anything made from them does not repeat the chain.
    """
    current, links, counts = text, [], []
    for step, pii_type in enumerate(fixed.MASKING_ORDER):
        count, after = f"__n_{step}", f"__t_{step}"
        links += [count_type(current, pii_type).alias(count), _masked(current, pii_type, count).alias(after)]
        current = after
        counts.append(count)
    steps = [F.when(F.col(c) > 0, F.lit(i)).otherwise(F.lit(-1)) for i, c in enumerate(counts)]
    state = F.struct(
        F.col(current).alias("text"), F.array(*counts).alias("counts"), F.greatest(*steps).alias("last")
    )
    done = computed_once(df.select("*", *links), __mask=state).select(*df.columns, "__mask")
    found = F.array(
        *[
            F.struct(
                F.lit(t).alias("type"),
                F.lit(fixed.METHOD_STRUCTURED).alias("method"),
                F.get("__mask.counts", F.lit(i)).alias("count"),
                F.lit(mask_tag(t)).alias("masked_as"),
            )
            for i, t in enumerate(fixed.MASKING_ORDER)
        ]
    )
    hits = F.filter(found, lambda f: f["count"] > 0).cast(f"array<{FINDING}>")
    done = done.withColumn(masked, F.col("__mask.text")).withColumn(findings, hits)
    if scan:
        done = done.withColumn(scan, F.struct("__mask.text", "__mask.last"))
    return done.drop("__mask")


def residual_check(
    df: DataFrame,
    text: str = "masked_email",
    status: str = "final_check_status",
    residual: str = "remaining_pii",
    scan: str | None = None,
) -> DataFrame:
    """Scan the masked text for every type again: FAIL where anything is left.

    With the `scan` column of `mask_structured`, types are not scanned again in a text they were already
    looked for in: where nothing changed the text since, steps behind the last hit found nothing in it.
    """
    def left_of(pii_type: str) -> Column:
        count = count_type(text, pii_type)
        if scan is None:
            return count
        step = fixed.MASKING_ORDER.index(pii_type)
        done = (F.col(f"{scan}.last") < step) & (F.col(text) == F.col(f"{scan}.text"))
        return F.when(done, F.lit(0)).otherwise(count)

    left = F.array(*[F.struct(F.lit(t).alias("type"), left_of(t).alias("count")) for t in fixed.PII_PATTERNS])
    left = F.filter(left, lambda r: r["count"] > 0).cast(f"array<{RESIDUAL}>")
    passed = F.when(F.size(residual) > 0, F.lit(fixed.STATUS_FAIL)).otherwise(F.lit(fixed.STATUS_PASS))
    return computed_once(df, **{residual: left}).withColumn(status, passed)


def finding_texts(findings: Column) -> Column:
    """'[MASKED_X] xN (X via M)' per finding."""
    return F.transform(
        findings,
        lambda f: F.format_string(
            "%s x%d (%s via %s)", f["masked_as"], f["count"], F.upper(f["type"]), f["method"]
        ),
    )


def residual_texts(residual: Column) -> Column:
    """'X xN' per residual type."""
    return F.transform(residual, lambda r: F.format_string("%s x%d", r["type"], r["count"]))


def type_list(findings: Column) -> Column:
    """Distinct types, sorted and comma-joined; NONE where nothing was found."""
    types = F.array_sort(F.array_distinct(F.transform(findings, lambda f: F.upper(f["type"]))))
    joined = F.array_join(types, ", ")
    return F.when(F.size(types) > 0, joined).otherwise(F.lit(fixed.NO_PII))


def normalize_privacy(
    df: DataFrame, source: str, raw: str = "raw_email", privacy: str = "privacy"
) -> DataFrame:
    """Collect the privacy step of a row into one struct with display strings."""
    status = F.upper("final_check_status")
    known = status.isin(fixed.STATUS_PASS, fixed.STATUS_FAIL)
    semantic_used = F.coalesce(F.size("semantic_items") > 0, F.lit(False))
    return df.withColumn(
        privacy,
        F.struct(
            F.col(raw).alias("raw_email"),
            F.coalesce("masked_email", raw).alias("masked_email"),
            finding_texts(F.col("detected_pii")).alias("detected_pii"),
            type_list(F.col("detected_pii")).alias("pii_type"),
            F.when(semantic_used, F.lit(fixed.METHOD_BOTH))
            .otherwise(F.lit(fixed.METHOD_STRUCTURED))
            .alias("redaction_method"),
            F.when(known, status).otherwise(F.lit(fixed.STATUS_FAIL)).alias("final_check_status"),
            residual_texts(F.col("remaining_pii")).alias("remaining_pii"),
            F.lit(source).alias("source"),
        ),
    )


def coverage(df: DataFrame, before: str, after: str) -> DataFrame:
    """One row: how many texts masking changed.  Partial counts only, nothing else is shuffled."""
    changed = F.count_if(F.col(before) != F.col(after))
    total = F.count(F.lit(1))
    return df.agg(total.alias("total"), changed.alias("changed")).select(
        "total",
        "changed",
        (F.col("total") - F.col("changed")).alias("unchanged"),
        F.when(F.col("total") > 0, F.col("changed") / F.col("total")).otherwise(F.lit(0.0)).alias("coverage_rate"),
    )


def finding_totals(df: DataFrame, findings: str = "detected_pii") -> DataFrame:
    """Mails and matches per type; at most one partial row per type leaves a task."""
    return (
        df.select(F.explode_outer(findings).alias("f"))
        .where(F.col("f").isNotNull())
        .groupBy(F.col("f.type").alias("type"))
        .agg(F.count(F.lit(1)).alias("mails"), F.sum("f.count").alias("matches"))
    )

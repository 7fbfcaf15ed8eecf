"""Labelled sets: per-class samples, splits, the golden set, resume and stage-log order."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import fixed
from ..schemas import GOLDEN
from .latest import latest

BROADCAST_ROWS = 100_000


def sample_key(key: Column, seed: int) -> Column:
    """Repeatable random order: the same on every run and on every engine that has md5."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def sample_per_class(
    df: DataFrame,
    n: int = fixed.SAMPLE_PER_CLASS,
    classes: tuple = (fixed.CLASS_PHISHING, fixed.CLASS_BENIGN),
    key: str = "email_id",
    label: str = "email_type",
    seed: int = fixed.SAMPLE_SEED,
) -> DataFrame:
    """`n` rows per class with their rank 1..n.

    Ranking runs on key and label alone; `rank <= n` lets Spark cut every task to n rows per class
    before the shuffle, so a class with most of the rows is no hot spot.  The texts are read in a
    second pass that keeps only the chosen keys, which are n rows per class at most.

    Rows of one key count once: in the class of greatest name among theirs, with the row of greatest digest.
    """
    rank = F.row_number().over(W.partitionBy(label).orderBy("__order", key))
    chosen = (
        df.where(F.col(label).isin(*classes))
        .groupBy(key)
        .agg(F.max(label).alias(label))
        .withColumn("__order", sample_key(F.col(key), seed))
        .withColumn("sample_rank", rank)
        .where(F.col("sample_rank") <= n)
        .select(key, label, "sample_rank")
    )
    if n * len(classes) <= BROADCAST_ROWS:
        chosen = F.broadcast(chosen)
    drawn = df.join(chosen, [key, label]).select(*df.columns, "sample_rank")
    return latest(drawn, key)


def split_sample(sample: DataFrame, first: int = fixed.FEWSHOT_PER_CLASS) -> DataFrame:
    """Rows up to rank `first` are examples, the rest are the test set."""
    return sample.withColumn(
        "part", F.when(F.col("sample_rank") <= first, F.lit("fewshot")).otherwise(F.lit("test"))
    )


def build_fewshot(sample: DataFrame, text: str = "email_text", label: str = "email_type") -> DataFrame:
    """Example rows (email, label, technique, reason) of both classes, in one pass over the sample."""
    phishing = F.col(label) == fixed.CLASS_PHISHING
    tags = [
        F.when(phishing, F.lit(p)).otherwise(F.lit(b)).alias(name)
        for name, p, b in zip(("label", "technique", "reason"), fixed.FEWSHOT_PHISHING, fixed.FEWSHOT_BENIGN)
    ]
    return (
        split_sample(sample)
        .where(F.col("part") == "fewshot")
        .select("email_id", F.substring(text, 1, fixed.FEWSHOT_CHARS).alias("email"), *tags)
    )


def build_test_set(sample: DataFrame, text: str = "email_text", label: str = "email_type") -> DataFrame:
    """Labelled mails (raw_email, true_label) from the part of the sample the examples left over."""
    kind = F.when(F.col(label) == fixed.CLASS_PHISHING, F.lit(fixed.LABEL_PHISHING)).otherwise(
        F.lit(fixed.LABEL_BENIGN)
    )
    return (
        split_sample(sample)
        .where(F.col("part") == "test")
        .select("email_id", F.substring(text, 1, fixed.TEST_CHARS).alias("raw_email"), kind.alias("true_label"))
    )


def golden_set(spark: SparkSession) -> DataFrame:
    """The 14 golden rows, benign first, numbered from 1."""
    labelled = [(0, row) for row in fixed.GOLDEN_BENIGN] + [(1, row) for row in fixed.GOLDEN_PHISHING]
    rows = [
        (i, subject, snippet, label, fixed.GOLDEN_LOCALE, score)
        for i, (label, (subject, snippet, score)) in enumerate(labelled, start=1)
    ]
    return spark.createDataFrame(rows, GOLDEN)


def first_rows(df: DataFrame, key: str, n: int = fixed.SAMPLE_ROWS) -> DataFrame:
    """The first `n` rows by key.  Each task keeps n rows; nothing is sorted as a whole."""
    return df.orderBy(key).limit(n)


def pending(mails: DataFrame, done: DataFrame, key: str = "email_id") -> DataFrame:
    """Mails without a stored result."""
    return mails.join(done.select(key), key, "left_anti")


def stage_rank(stage: Column, status: Column) -> tuple[Column, Column]:
    def rank(value: Column, order: dict, unknown: int) -> Column:
        chain = F.lit(unknown)
        for name, position in order.items():
            chain = F.when(value == name, F.lit(position)).otherwise(chain)
        return chain

    return (
        rank(stage, fixed.STAGE_ORDER, fixed.STAGE_UNKNOWN),
        rank(status, fixed.STATUS_ORDER, fixed.STATUS_UNKNOWN),
    )


def order_stage_log(
    log: DataFrame, stage: str = "stage", status: str = "status", key: str | None = None
) -> DataFrame:
    """Stage log by stage order, then status, then `key`; unknown values last.

    A unique key defines the order of equals and lets the sort spread over more tasks than there are stages.
    """
    stage_position, status_position = stage_rank(F.col(stage), F.col(status))
    return (
        log.withColumn("stage_position", stage_position)
        .withColumn("status_position", status_position)
        .orderBy("stage_position", "status_position", *([key] if key else []))
    )

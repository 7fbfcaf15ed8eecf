"""Readers.  Every reader states its schema, so no pass over the data is spent on inference."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import schemas
from ..operators.datasets import first_rows
from .json_array import read_json_arrays


def read_spread(spark: SparkSession, path: str, key: str) -> DataFrame:
    """Parquet, spread over the cores where the files give fewer tasks than there are cores.

    A file of one row group is one task, however many cores wait.  Large inputs have more splits
    than cores and are left alone: their rows are never shuffled.
    """
    df = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def read_json(spark: SparkSession, path: str, schema: StructType, array_file: bool = False) -> DataFrame:
    """JSON lines, or with `array_file` files holding one JSON array each, in several tasks per file."""
    return read_json_arrays(spark, path, schema) if array_file else spark.read.schema(schema).json(path)


def read_labelled_mails(spark: SparkSession, path: str, array_file: bool = True) -> DataFrame:
    """(raw_email, true_label) records."""
    return read_json(spark, path, schemas.LABELLED_MAIL, array_file)


def read_techniques(spark: SparkSession, path: str, array_file: bool = True) -> DataFrame:
    """Technique knowledge base; a missing file is an error."""
    return read_json(spark, path, schemas.TECHNIQUE, array_file)


def read_examples(spark: SparkSession, path: str, array_file: bool = True) -> DataFrame:
    """Few-shot knowledge base."""
    return read_json(spark, path, schemas.EXAMPLE, array_file)


def read_verdicts(spark: SparkSession, path: str, array_file: bool = True) -> DataFrame:
    """Stored verdicts of an earlier run."""
    return read_json(spark, path, schemas.STORED_VERDICT, array_file)


def read_masked_text_sample(spark: SparkSession, path: str, key: str, n: int) -> DataFrame:
    """The first `n` rows by `key` of a parquet set with columns unmasked_text and masked_text."""
    return first_rows(spark.read.parquet(path).select(key, "unmasked_text", "masked_text"), key, n)


def with_mail_ids(df: DataFrame, columns: list[str], out: str = "email_id") -> DataFrame:
    """Key for records that have none: a hash of their content, the same on every run.

    Copies share a key; drop them or add a column that tells them apart.
    """
    return df.withColumn(out, F.xxhash64(*columns))

"""The given tables, and the public vocabulary files that operators get as parameters."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def ranks_file() -> tuple[str, str]:
    """The byte-level vocabulary of byte_bpe_50k.json as ranks, and its splitting pattern."""
    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def pieces_file() -> str:
    return public_tokenizers.path("piece_bpe_32k.model")

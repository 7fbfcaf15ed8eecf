"""Writers.  All of them write one file per task."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from ..operators.metrics import error_rows, quality, rounded_report


def save_bucketed(df: DataFrame, table: str, key: str = "email_id", buckets: int = 1_024) -> None:
    """Table bucketed and sorted by mail key.

    Mails, verdicts, scores and overrides saved with the same number of buckets meet in joins on
    the key without a shuffle of the texts.  Rows are spread by key before the write, so each
    bucket comes out as one file.
    """
    df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON lines, UTF-8 unescaped, NULL fields kept."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def flat_for_csv(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, since CSV has no nesting."""
    nested = (ArrayType, MapType, StructType)
    return df.select(
        *[
            F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with header; quotes are doubled so that line breaks and quotes in mails survive."""
    flat_for_csv(df).write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_report(results: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Two tables under `path`: the one-row report, rounded, and the misclassified rows."""
    write_json(rounded_report(quality(results)), f"{path}/report", mode)
    write_json(error_rows(results), f"{path}/errors", mode)

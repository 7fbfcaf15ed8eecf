"""Incremental screening: a file stream that takes up where it was stopped."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..plans.screening import screen


def mail_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    file_format: str = "parquet",
    files_per_batch: int = 1_000,
    name_glob: str | None = None,
) -> DataFrame:
    """Files below `path`, which may be a folder, or a glob such as `table_files` gives."""
    reader = (
        spark.readStream.format(file_format).schema(schema).option("maxFilesPerTrigger", files_per_batch)
    )
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    return reader.load(path)


def table_files(path: str) -> str:
    """A glob for one table of a folder, be it a file or a folder of part files.

    A file cannot be the path of a stream, and a filter on names does not see the folder that part files lie in.
    """
    return f"{path[:-1]}[{path[-1]}]"


def screen_available(
    mails: DataFrame,
    out: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] = screen,
) -> StreamingQuery:
    """Screen everything that has arrived since the last run and stop.

    Every mail is handled on its own, so the stream keeps no state; the checkpoint holds the list
    of files done, and the parquet sink commits a batch as a whole.
    """
    return (
        transform(mails)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )

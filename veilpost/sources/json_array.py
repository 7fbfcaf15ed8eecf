"""Files that hold one JSON array of objects, read in several tasks per file.

Spark's text source cuts a file at any `}`, so its splits are known but not where records begin: a brace may
stand in a string or close a nested object.  A first pass tells, per split, the parity of unescaped quotes
(which does not depend on what was before) and, for both answers to "does the split begin in a string", how braces
add up and how many begin a record at each depth.  Running sums over the splits of a file, some bytes each,
give every split its state at the start.  The second pass gives out whole records, and the pieces of records that
cross splits, which are put together by file and record number: one per split at most.
"""

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import fresh_dir, ship_package

#: Depths of nesting at which a split may begin.
DEPTHS = 64
_CLOSE, _OPEN, _QUOTE, _SLASH = b"}"[0], b"{"[0], b'"'[0], b"\\"[0]


def _quotes(data: np.ndarray) -> np.ndarray:
    """Quotes that no backslash escapes; a stretch of bytes ends with a brace, so no backslash reaches over its end."""
    at = np.flatnonzero(data == _QUOTE)
    places = np.arange(len(data))
    other = np.maximum.accumulate(np.where(data != _SLASH, places, -1))
    before = np.where(at > 0, at - 1 - np.append(other, -1)[at - 1], 0)
    return at[before % 2 == 0]


def _braces(data: np.ndarray, quotes: np.ndarray, inside: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, +1 or -1) of the braces outside of strings."""
    at = np.flatnonzero((data == _OPEN) | (data == _CLOSE))
    at = at[(np.searchsorted(quotes, at) + inside) % 2 == 0]
    return at, np.where(data[at] == _OPEN, 1, -1)


def _stretches(batches, n_keys: int):
    """(first row, key values, bytes with their braces put back) of runs of rows of one split."""
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(i).to_pylist() for i in range(n_keys)]
        values = batch.column("value").to_pylist()
        edges = [0, *[i for i in range(1, len(values)) if keys[0][i] != keys[0][i - 1] or keys[1][i] != keys[1][i - 1]], len(values)]
        for a, z in zip(edges[:-1], edges[1:]):
            yield tuple(k[a] for k in keys), ("}".join(values[a:z]) + "}").encode()


@dataclass
class Tally:
    """What a split does to the state, for both starts."""

    parity: int = 0
    depth: list = field(default_factory=lambda: [0, 0])
    begins: list = field(default_factory=lambda: [np.zeros(DEPTHS, np.int64), np.zeros(DEPTHS, np.int64)])

    def add(self, data: bytes) -> None:
        raw = np.frombuffer(data, np.uint8)
        quotes = _quotes(raw)
        for start in (0, 1):
            _, step = _braces(raw, quotes, (start + self.parity) % 2)
            level = self.depth[start] + np.cumsum(step) - step
            opened = -level[(step == 1) & (level <= 0)]
            self.begins[start] += np.bincount(opened[opened < DEPTHS], minlength=DEPTHS)
            self.depth[start] += int(step.sum())
        self.parity = (self.parity + len(quotes)) % 2


def _summaries(fragments: DataFrame) -> DataFrame:
    def work(batches):
        tallies: dict = {}
        for key, data in _stretches(batches, 2):
            tallies.setdefault(key, Tally()).add(data)
        rows = list(tallies.items())
        columns = [
            pa.array([k[0] for k, _ in rows], pa.string()), pa.array([k[1] for k, _ in rows], pa.int64()), pa.array([t.parity for _, t in rows], pa.int64()),
            *[pa.array([t.depth[s] for _, t in rows], pa.int64()) for s in (0, 1)],
            *[pa.array([t.begins[s].tolist() for _, t in rows], pa.list_(pa.int64())) for s in (0, 1)],
        ]
        yield pa.RecordBatch.from_arrays(columns, ["file", "block", "parity", "depth_0", "depth_1", "begins_0", "begins_1"])

    return fragments.mapInArrow(work, "file string, block long, parity long, depth_0 long, depth_1 long, begins_0 array<long>, begins_1 array<long>")


def _starts(summaries: DataFrame) -> DataFrame:
    """(file, block, inside, depth, begun): the state at the start of every split."""
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)

    def ahead(column):
        return F.coalesce(F.sum(column).over(before), F.lit(0))

    told = summaries.withColumn("inside", ahead(F.col("parity")) % 2)
    told = told.withColumn("own_depth", F.when(F.col("inside") == 0, F.col("depth_0")).otherwise(F.col("depth_1")))
    told = told.withColumn("own_begins", F.when(F.col("inside") == 0, F.col("begins_0")).otherwise(F.col("begins_1")))
    told = told.withColumn("depth", ahead(F.col("own_depth")))
    begun = F.coalesce(F.get("own_begins", F.col("depth").cast("int")), F.lit(0))
    return told.withColumn("begins", begun).withColumn("begun", ahead(F.col("begins"))).select("file", "block", "inside", "depth", "begun")


def _records(fragments: DataFrame) -> DataFrame:
    """(file, block, number, whole, text): records and pieces of records."""

    def work(batches):
        at_key, inside, depth, number, held = None, 0, 0, 0, b""
        out: list = []

        def flush(whole: bool) -> None:
            if held.strip():
                out.append((*at_key, number, whole, held.decode()))

        for (file, block, start_inside, start_depth, begun), data in _stretches(batches, 5):
            if (file, block) != at_key:
                if at_key is not None and depth > 0:
                    flush(False)
                at_key, inside, depth, number, held, crossing = (file, block), start_inside, start_depth, begun, b"", start_depth > 0
            raw = np.frombuffer(data, np.uint8)
            quotes = _quotes(raw)
            places, steps = _braces(raw, quotes, inside)
            level = depth + np.cumsum(steps)
            begin = 0 if depth > 0 else None
            for place, step, after in zip(places.tolist(), steps.tolist(), level.tolist()):
                if step == 1 and after == 1:
                    begin, number = place, number + 1
                elif step == -1 and after == 0 and begin is not None:
                    held += data[begin : place + 1]
                    flush(not crossing)
                    held, begin, crossing = b"", None, False
            if begin is not None:
                held += data[begin:]
            inside = (inside + len(quotes)) % 2
            depth = max(0, int(level[-1])) if len(level) else depth
            if len(out) > 2_000:
                yield _batch(out)
                out = []
        if at_key is not None and depth > 0:
            flush(False)
        yield _batch(out)

    return fragments.mapInArrow(work, "file string, block long, number long, whole boolean, text string")


def _batch(rows: list) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string())
    columns = list(zip(*rows)) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["file", "block", "number", "whole", "text"])


def read_json_arrays(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The objects of all array files under `path`; a field that is missing or of another type is NULL.

    How many tasks a file has follows from `spark.sql.files.maxPartitionBytes`.
    """
    ship_package(spark)
    text = spark.read.option("lineSep", "}").text(path)
    fragments = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    saved = fresh_dir(spark, "array-splits")
    _starts(_summaries(fragments)).write.parquet(saved)
    starts = spark.read.parquet(saved)
    known = fragments.join(F.broadcast(starts), ["file", "block"]).select("file", "block", "inside", "depth", "begun", "value")
    pieces = _records(known)
    crossing = pieces.where("NOT whole").groupBy("file", "number").agg(F.sort_array(F.collect_list(F.struct("block", "text"))).alias("parts"))
    joined = crossing.select(F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"))
    texts = pieces.where("whole").select("text").unionByName(joined)
    return texts.select(F.from_json("text", schema).alias("record")).select("record.*")


def write_json_arrays(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One file with one JSON array per task, NULL fields kept."""
    rows = df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}).alias("value"))

    def work(batches):
        first = True
        for batch in batches:
            lines = [("[" if first and i == 0 else ",") + text for i, text in enumerate(batch.column(0).to_pylist())]
            first = first and not lines
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["[]" if first else "]"])], ["value"])

    rows.mapInArrow(work, "value string").write.mode(mode).text(path)

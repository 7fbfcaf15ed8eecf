"""Histogram sort: splitters of a sort key are found by counting, then the rows move once.

Rows are ordered by a 64-bit key: the checksum of the text above, a hash of the document's number
below, so equal texts lie together and even a group of copies larger than a shard can be cut.  Probes
in the intervals that still hold a splitter are counted exactly over all partitions, in one pass for
all splitters, and the intervals shrink until every splitter is within tolerance.

Defined results: a null text has no bytes; rows of one key (same text, same number) stay together;
an empty table gives no rows; there may be empty shards when there are fewer keys than shards.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .exchange import save

_LOW, _HIGH = -(2**63), 2**63
PROBES = 64
TOLERANCE = 1e-4
ROWS_PER_CELL = 250_000


def text_key(doc_id: str, text: str) -> Column:
    """Sort key: checksum of the text in the high half, hash of the number in the low half."""
    high = F.coalesce(F.crc32(F.col(text).cast("binary")), F.lit(0)) - F.lit(2**31)
    return F.shiftleft(high.cast("long"), 32).bitwiseOR(F.shiftrightunsigned(F.xxhash64(doc_id), 32))


def bytes_below(rows: DataFrame, key: str, size: str, probes: np.ndarray) -> np.ndarray:
    """Exact sum of sizes of the rows whose key is below each of the ascending probes."""

    def count(batches):
        sums = np.zeros(len(probes) + 1, np.int64)
        for batch in batches:
            place = np.searchsorted(probes, np.asarray(batch.column(key)), side="right")
            np.add.at(sums, place, np.asarray(batch.column(size)))
        hit = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int64()), pa.array(sums[hit])], ["place", "bytes"])

    parts = rows.select(key, size).mapInArrow(count, "place long, bytes long")
    below = np.zeros(len(probes) + 1, np.int64)
    for row in parts.groupBy("place").agg(F.sum("bytes").alias("bytes")).collect():
        below[row.place] = row.bytes
    return np.cumsum(below)[:-1]


def find_splitters(rows: DataFrame, key: str, size: str, total: int, parts: int, tolerance: float = TOLERANCE) -> list[int]:
    """Keys that cut the order into `parts` ranges of nearly equal bytes; a range holds keys >= its splitter.

    The driver holds `parts` intervals and PROBES counts for each, whatever the number of rows.
    """
    goals = [total * i // parts for i in range(1, parts)]
    low = [(_LOW, 0)] * len(goals)
    high = [(_HIGH, total)] * len(goals)
    slack = tolerance * total / parts

    def near(i: int) -> tuple[int, int]:
        return min(low[i], high[i], key=lambda end: abs(end[1] - goals[i]))

    while True:
        open_ = [i for i in range(len(goals)) if abs(near(i)[1] - goals[i]) > slack and high[i][0] - low[i][0] > 1]
        if not open_:
            return [near(i)[0] for i in range(len(goals))]
        wanted = set()
        for i in open_:
            width = high[i][0] - low[i][0]
            wanted |= {low[i][0] + max(1, width * j // (PROBES + 1)) for j in range(1, PROBES + 1)} - {high[i][0]}
        probes = sorted(wanted)
        below = bytes_below(rows, key, size, np.array(probes, np.int64)).tolist()
        for i in open_:
            inside = [(p, b) for p, b in zip(probes, below) if low[i][0] < p < high[i][0]]
            low[i] = max([low[i], *(x for x in inside if x[1] <= goals[i])])
            high[i] = min([high[i], *(x for x in inside if x[1] > goals[i])])


def shard_rows(docs: DataFrame, key: str, size: str, shards: int = 8, tie: str = "doc_id") -> DataFrame:
    """All columns of `docs` with `shard` and `slot`, the row's gapless place in its shard, in key order.

    Shards are cut into cells of bounded size, so no task orders a whole shard; the one exchange
    goes by cell, and counts per cell turn places in cells into places in shards.
    """
    slim = save(docs.select(F.col(key).alias("key"), F.col(size).cast("long").alias("size")), "shard-keys")
    rows, total = slim.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    per_shard = max(1, -(-rows // (shards * ROWS_PER_CELL)))
    splitters = find_splitters(slim, "key", "size", total, shards * per_shard)
    edges = np.array([min(s, _HIGH - 1) for s in splitters], np.int64)

    @F.arrow_udf("int")
    def cell_of(keys: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(edges, np.asarray(keys), side="right"), pa.int32())

    counts = np.zeros(shards * per_shard + 1, np.int64)
    for row in slim.groupBy(cell_of("key").alias("cell")).count().collect():
        counts[row.cell + 1] = row["count"]
    before = np.cumsum(counts)[:-1]
    ahead = (before - before[np.arange(len(before)) // per_shard * per_shard]).tolist()
    placed = docs.withColumn("__cell", cell_of(F.col(key)))
    window = Window.partitionBy("__cell").orderBy(key, tie)
    offset = F.element_at(F.array(*[F.lit(a).cast("long") for a in ahead]), F.col("__cell") + 1)
    return (
        placed.withColumn("slot", offset + F.row_number().over(window) - F.lit(1))
        .withColumn("shard", F.floor(F.col("__cell") / F.lit(per_shard)).cast("int"))
        .drop("__cell")
    )


def shard_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = 8) -> DataFrame:
    """Every row with its `size` in bytes, `shard` and `slot`; whole rows move once.

    A null text counts no bytes, and every document one byte more than its text.
    """
    sized = docs.withColumns(
        {
            "__size": F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(1),
            "__key": text_key(doc_id, text),
        }
    )
    return shard_rows(sized, "__key", "__size", shards, doc_id).drop("__key").withColumnRenamed("__size", "size")


def write_shards(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", shards: int = 8) -> None:
    """Write one folder per shard, rows in slot order within each file."""
    shard_documents(docs, doc_id, text, shards).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)

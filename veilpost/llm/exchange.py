"""Blocks of documents, and questions that blocks ask about keys all over the corpus.

A block is some megabytes of whole documents.  It sorts its own distinct keys, sends each bucket of
the key space one packed piece, and gets one answer per key back in the same order, so keys travel
once and answers need no key.  A key comes at most once from a block, however often its words occur
there, and no bucket holds more than one entry per block and key: no key is hot.
"""

import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilpost.session import fresh_dir

BLOCK_BYTES = 8 << 20
#: Spark allows no more than 100,000 buckets; blocks beyond share buckets.
MAX_BUCKETS = 50_000

PIECE = "bucket int, block int, data binary"


def save(df: DataFrame, purpose: str, compression: str = "zstd") -> DataFrame:
    """Write to a new folder of the shared storage and read back: the lineage ends here."""
    path = fresh_dir(df.sparkSession, purpose)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def save_blocks(docs: DataFrame, key: str, text: str, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, int]:
    """All rows with a column `block`, saved so that work by block needs no further shuffle.

    Blocks are cut by a hash of the row, so no source or copied text makes one larger; only rows that
    are equal in key and text keep together.
    """
    spark: SparkSession = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length(text) + F.lit(64))).first()[0] or 0
    n_blocks = int(total // block_bytes) + 1
    buckets = min(n_blocks, MAX_BUCKETS)
    name = f"blocks_{uuid.uuid4().hex}"
    (
        docs.withColumn("block", F.pmod(F.xxhash64(key, text), F.lit(n_blocks)).cast("int"))
        .repartition(buckets, "block")
        .write.format("parquet")
        .option("compression", "zstd")
        .option("path", fresh_dir(spark, "blocks"))
        .bucketBy(buckets, "block")
        .saveAsTable(name)
    )
    return spark.table(name), n_blocks


def pack_ints(values: np.ndarray) -> bytes:
    """Non-negative integers as compressed byte planes; ascending ones are best packed as their steps."""
    planes = np.ascontiguousarray(values, np.uint64).view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack_ints(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view(np.uint64).ravel()


def pack_columns(sorted_key: np.ndarray, *others: np.ndarray) -> bytes:
    steps = sorted_key.copy()
    steps[1:] -= sorted_key[:-1]
    return pack_ints(np.concatenate([steps, *(o.astype(np.uint64) for o in others)]))


def unpack_columns(data: bytes, n: int) -> list[np.ndarray]:
    columns = np.split(unpack_ints(data), n)
    return [np.cumsum(columns[0], dtype=np.uint64), *columns[1:]]


def bucket_of(keys: np.ndarray, n_buckets: int) -> np.ndarray:
    """Equal ranges of the 64-bit key space, so that ascending keys have ascending buckets."""
    return ((keys >> np.uint64(32)) * np.uint64(n_buckets)) >> np.uint64(32)


def cut(keys: np.ndarray, n_buckets: int) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of the buckets that ascending keys fall in."""
    buckets = bucket_of(keys, n_buckets)
    edges = np.flatnonzero(np.diff(buckets, prepend=np.uint64(n_buckets)))
    ends = np.append(edges[1:], len(keys))
    return [(int(buckets[a]), int(a), int(b)) for a, b in zip(edges, ends)]


def pieces(block: int, n_buckets: int, keys: np.ndarray, *others: np.ndarray, tag: int = 0) -> pa.Table:
    """Ascending keys with their values as one packed row per bucket.

    Several kinds of key use one exchange: kind `tag` has buckets of its own.
    """
    parts = cut(keys, n_buckets)
    return pa.table(
        {
            "bucket": pa.array([tag * n_buckets + b for b, _, _ in parts], pa.int32()),
            "block": pa.array([block] * len(parts), pa.int32()),
            "data": pa.array([pack_columns(keys[a:z], *(o[a:z] for o in others)) for _, a, z in parts], pa.binary()),
        }
    )


def answers(table: pa.Table, tag: int, n_buckets: int) -> list[bytes]:
    """What came back for one kind of key, by bucket: the order of the block's ascending keys."""
    bucket = np.asarray(table.column("bucket"))
    data = table.column("data").to_pylist()
    order = np.argsort(bucket, kind="stable")
    return [data[i] for i in order if bucket[i] // n_buckets == tag]


def joined(parts: list[bytes]) -> np.ndarray:
    return np.concatenate([unpack_ints(p) for p in parts]) if parts else np.zeros(0, np.uint64)


def ask(up: DataFrame, n_columns: Callable[[int], int], merge: Callable[[int, list[np.ndarray], np.ndarray], np.ndarray]) -> DataFrame:
    """Answer every piece.

    `merge(bucket, columns, piece_of_row)` gets the rows of all pieces of a bucket and gives one
    non-negative integer per row.
    """

    def one(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        got = [unpack_columns(d, n_columns(bucket)) for d in table.column("data").to_pylist()]
        sizes = [len(g[0]) for g in got]
        columns = [np.concatenate([g[i] for g in got]) for i in range(n_columns(bucket))]
        out = merge(bucket, columns, np.repeat(np.arange(len(got)), sizes))
        ends = np.cumsum(sizes)
        data = [pack_ints(out[z - n : z]) for n, z in zip(sizes, ends)]
        return pa.table({"bucket": table.column("bucket"), "block": table.column("block"), "data": pa.array(data, pa.binary())})

    return up.groupBy("bucket").applyInArrow(one, PIECE)

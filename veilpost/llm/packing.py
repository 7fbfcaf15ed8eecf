"""Concatenate and cut: documents become one stream of tokens that fixed windows cut into sequences.

Pass one encodes every text once and keeps, for each document, the tokens before it in its partition.
A prefix sum over the partition totals turns that into global places.  Pass two cuts at multiples of
the window and writes one boundary record per piece.  No row is shuffled.

Defined results: a null text is an empty one (only the end id); repeated rows are packed each; a
document longer than the window gets several pieces; no rows give no pieces.  All windows are full
except the last, so the padding of the whole corpus is less than one window.
"""

import base64
import re
import zlib

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .exchange import save

WINDOW = 2048
END_ID = 1
_ROWS = 256
_HARD_SPACE = re.compile(r"\s(?=\s|$)|[^\S ](?=.)|^\s", re.DOTALL)
_cache: dict[str, "ChunkIds"] = {}


class ChunkIds(dict):
    """Ids of chunks met before, as little-endian 16-bit numbers; fresh once it is full."""

    def __init__(self, path: str, pattern: str, most: int = 400_000):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoder = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.most = most

    def __missing__(self, chunk: str) -> bytes:
        ids = np.array(self.encoder.encode_ordinary(chunk), "<u2").tobytes()
        if len(self) < self.most:
            self[chunk] = ids
        return ids

    def line(self, line: str) -> bytes:
        if _HARD_SPACE.search(line):
            return np.array(self.encoder.encode_ordinary(line), "<u2").tobytes()
        first, *rest = line.split(" ")
        return self[first] + b"".join([self[" " + word] for word in rest])

    def text(self, text: str) -> bytes:
        """Ids of a whole text.

        The vocabulary's pattern never joins a word to what comes before its one leading space, nor to
        a single line end before it, so such texts are encoded chunk by chunk from the cache.  Texts
        with other white space are encoded in one go.
        """
        lines = text.split("\n")
        if len(lines) > 1 and (not all(lines) or any(x[0].isspace() or x[-1].isspace() for x in lines)):
            return np.array(self.encoder.encode_ordinary(text), "<u2").tobytes()
        return self["\n"].join(map(self.line, lines))


def chunk_ids(path: str, pattern: str) -> ChunkIds:
    if path not in _cache:
        _cache[path] = ChunkIds(path, pattern)
    return _cache[path]


def encode_documents(docs: DataFrame, key: str, text: str, ranks: str, pattern: str) -> DataFrame:
    """(partition, before, key, ids): whole texts as 16-bit ids with the end id, written once."""
    schema = StructType().add("partition", "integer").add("before", "long").add(docs.schema[key]).add("ids", "binary")
    end = np.array([END_ID], "<u2").tobytes()

    def encode(batches):
        partition, before = TaskContext.get().partitionId(), 0
        cache = chunk_ids(ranks, pattern)
        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(at, _ROWS)
                ids = [cache.text(t or "") + end for t in batch.column(text).to_pylist()]
                sizes = np.array([len(i) // 2 for i in ids], np.int64)
                places = before + np.cumsum(sizes) - sizes
                before += int(sizes.sum())
                columns = [pa.array([partition] * len(ids), pa.int32()), pa.array(places), batch.column(key), pa.array(ids, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return save(docs.select(key, text).mapInArrow(encode, schema), "encoded")


def cut_windows(encoded: DataFrame, key: str, window: int = WINDOW) -> DataFrame:
    """One record per piece: where it starts in its document and where it lies in its sequence."""
    totals = (
        encoded.groupBy("partition")
        .agg(F.max(F.col("before") + F.octet_length("ids") / 2).cast("long").alias("n"))
        .orderBy("partition")
        .collect()
    )
    ends = np.cumsum([r.n for r in totals])
    base = {r.partition: int(z - r.n) for r, z in zip(totals, ends)}
    numbers = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    schema = StructType().add(encoded.schema[key])
    for field in StructType.fromDDL(numbers):
        schema = schema.add(field)

    def cut(batches):
        for batch in batches:
            begins = np.asarray(batch.column("before")) + np.array([base[p] for p in batch.column("partition").to_pylist()], np.int64)
            rows, found = [], []
            for row, (begin, data) in enumerate(zip(begins.tolist(), batch.column("ids").to_pylist())):
                ids = np.frombuffer(data, "<u2").astype("<u4")
                start = 0
                while start < len(ids):
                    offset = (begin + start) % window
                    stop = min(len(ids), start + window - offset)
                    crc = zlib.crc32(ids[start:stop].tobytes())
                    found.append((start, stop - start, crc, len(ids), (begin + start) // window, offset))
                    rows.append(row)
                    start = stop
            columns = [batch.column(key).take(pa.array(rows, pa.int64()))]
            columns += [pa.array(c, pa.int64()) for c in (zip(*found) if found else [[]] * 6)]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return encoded.mapInArrow(cut, schema)


def pack_documents(docs: DataFrame, ranks: str, pattern: str, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Boundary records of all documents packed into sequences of `window` tokens.

    `ranks` is the file of the byte-level vocabulary, `pattern` its splitting pattern.
    """
    return cut_windows(encode_documents(docs, key, text, ranks, pattern), key, window)


def tokens_of(encoded: DataFrame, text_ids: str = "ids") -> Column:
    """Number of tokens of an encoded row."""
    return (F.octet_length(encoded[text_ids]) / 2).cast("long")

"""Document fingerprints: one-permutation MinHash, densified, packed to low-order bits.

Every distinct word shingle is hashed once; its high bits pick a bin and each bin keeps its least
hash.  An empty bin copies a filled one, found by a sequence of bins of its own that does not
depend on the document, which keeps the chance of agreement at the sets' likeness.  Only `BITS` bits
per bin are stored; chance agreement of those bits is taken out of the estimate.

Defined results: a null text is an empty one; a text without words has the empty fingerprint, which
is like itself (1.0) and unlike all others (0.0); fewer words than a shingle are one shingle.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .words import mix, shingle_sets, split_words

BINS = 256
BITS = 8
SHINGLE = 5
_FILL = np.uint64(2**64 - 1)
#: Rows worked on at once in a task; long texts make them fewer.
ROWS, CHARS = 512, 4 << 20


def bin_minima(keys: np.ndarray, first: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Least hash per document and bin; `_FILL` where a bin is empty."""
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    place = doc * bins + (((keys >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)).astype(np.int64)
    # Keys ascend within a document, so writing them backwards leaves the least in each bin.
    out = np.full((len(first) - 1) * bins, _FILL, np.uint64)
    out[place[::-1]] = keys[::-1]
    return out.reshape(-1, bins)


def densify(minima: np.ndarray) -> np.ndarray:
    """Fill empty bins: attempt by attempt, each takes the bin that a hash of (bin, attempt) names, until that is a filled one."""
    out, bins = minima.copy(), minima.shape[1]
    row, col = np.nonzero((minima == _FILL) & (minima != _FILL).any(axis=1)[:, None])
    attempt = 0
    while len(row):
        attempt += 1
        source = (mix(col.astype(np.uint64) * np.uint64(1 << 32) + np.uint64(attempt)) % np.uint64(bins)).astype(np.int64)
        got = minima[row, source]
        hit = got != _FILL
        out[row[hit], col[hit]] = got[hit]
        row, col = row[~hit], col[~hit]
    return out


def fingerprints(texts, bins: int = BINS, bits: int = BITS, size: int = SHINGLE) -> list[bytes]:
    """Packed fingerprints of a string column; empty bytes for a text without words."""
    keys, first = shingle_sets(split_words(texts), size)
    low = mix(densify(bin_minima(keys, first, bins))) & np.uint64((1 << bits) - 1)
    spread = (low[:, :, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
    packed = np.packbits(spread.astype(np.uint8).reshape(len(low), -1), axis=1)
    return [row.tobytes() if n else b"" for row, n in zip(packed, np.diff(first))]


def likeness(a: bytes, b: bytes, bins: int = BINS, bits: int = BITS) -> float:
    """Estimated Jaccard likeness of two documents from their fingerprints, chance agreement removed."""
    if not a or not b:
        return float(a == b)
    differ = (np.frombuffer(a, np.uint8) ^ np.frombuffer(b, np.uint8)).view(np.uint8)
    same = float((~np.unpackbits(differ).reshape(bins, bits).any(axis=1)).mean())
    chance = 2.0**-bits
    return min(1.0, max(0.0, (same - chance) / (1 - chance)))


def fingerprint_documents(docs: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """All columns of `docs` with the packed fingerprint, no shuffle."""
    schema = StructType([*docs.schema.fields]).add(out, "binary")

    def add(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fingerprints(batch.column(text)), pa.binary())], schema.names)

    return docs.mapInArrow(add, schema)


def with_next(docs: DataFrame, key: str, text: str, work, schema: StructType) -> DataFrame:
    """`work(keys, texts, next_texts)` over all rows in the order of `key`, each with the text of the row after it; the last row is followed by the first.

    Texts move once, to ranges of the key; the first row of each range goes to the range before it
    as well.  Ranges follow a sample of the keys; where they lie does not change any result.
    A null key comes first.  Rows with equal keys are ordered by their texts.
    """
    slim = docs.select(F.coalesce(F.col(key), F.lit(-(2**63))).cast("long").alias("key"))
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    edges = sorted(set(slim.approxQuantile("key", [i / parts for i in range(1, parts)], 0.1 / parts))) if parts > 1 else []
    order = F.coalesce(F.col(key), F.lit(-(2**63))).cast("long")
    places = np.array(edges, np.int64)

    @F.arrow_udf("int")
    def range_of(keys: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(places, np.asarray(keys), side="right"), pa.int32())

    rows = docs.select(F.col(key), F.col(text).alias("text"), order.alias("order")).withColumn("part", range_of("order"))
    firsts = {r.part: r.first for r in rows.groupBy("part").agg(F.min("order").alias("first")).collect()}
    held = sorted(firsts)
    # The range that needs the first row of another one, by that row's key.
    before = {firsts[p]: held[i - 1] for i, p in enumerate(held)}
    if not before:
        return docs.sparkSession.createDataFrame([], schema)
    guest = F.create_map(*[x for k, v in before.items() for x in (F.lit(k).cast("long"), F.lit(v))])
    first_of_range = F.row_number().over(Window.partitionBy("order").orderBy("text")) == 1
    lookup = F.try_element_at(guest, F.col("order"))
    candidates = rows.where(F.col("order").isin(list(before))).withColumn("first", first_of_range)
    guests = candidates.where("first").select(key, "text", "order", lookup.alias("part"), F.lit(1).alias("guest"))
    both = rows.withColumn("guest", F.lit(0)).unionByName(guests)
    ordered = both.repartition(len(held), "part").sortWithinPartitions("part", "guest", "order", "text")

    def run(batches):
        waiting = None  # rows of one range whose next row is not known yet
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for at in range(0, table.num_rows, ROWS):
                piece = table.slice(at, ROWS)
                waiting = piece if waiting is None else pa.concat_tables([waiting, piece])
                if waiting.num_rows > 1:
                    yield from emit(waiting)
                    waiting = waiting.slice(waiting.num_rows - 1)

    def emit(table):
        texts = [t or "" for t in table.column("text").to_pylist()]
        guest = np.asarray(table.column("guest"))
        own = np.flatnonzero(guest[:-1] == 0)
        sizes = np.cumsum([len(texts[i]) for i in own])
        for rows_ in np.split(own, np.flatnonzero(np.diff(sizes // CHARS)) + 1) if len(own) else []:
            keys = table.column(key).take(pa.array(rows_)).combine_chunks()
            yield work(keys, [texts[i] for i in rows_], [texts[i + 1] for i in rows_])

    return ordered.mapInArrow(run, schema)


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as many characters from the start of the one after it."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare_with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and how like they and the next text's are."""
    fields = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    schema = StructType([docs.schema[key]])
    for field in StructType.fromDDL(fields):
        schema = schema.add(field)

    def work(keys, texts, following):
        changed = [edited(a, b) for a, b in zip(texts, following)]
        own = fingerprints(pa.array([*texts, following[-1]], pa.large_string()))
        ahead = own[1:]
        loose = [i for i in range(len(texts) - 1) if following[i] != texts[i + 1]]
        for i, print_ in zip(loose, fingerprints(pa.array([following[i] for i in loose], pa.large_string())) if loose else []):
            ahead[i] = print_
        other = fingerprints(pa.array(changed, pa.large_string()))
        columns = [
            keys,
            pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(c.encode()).hexdigest() for c in changed]),
            pa.array([f.hex() for f in own[:-1]], pa.string()),
            pa.array([f.hex() for f in other], pa.string()),
            pa.array([likeness(a, b) for a, b in zip(own, other)], pa.float64()),
            pa.array([likeness(a, b) for a, b in zip(own, ahead)], pa.float64()),
        ]
        return pa.RecordBatch.from_arrays(columns, schema.names)

    return with_next(docs, key, text, work, schema)

"""Near-duplicate documents: one-permutation MinHash, banded buckets, star-shaped candidates.

Documents with one and the same shingle set form a class, and only its least document goes on.  Its
signature comes from one hash per shingle with empty bins filled as in fingerprint.py; bands of the
signature are bucket keys.  In a bucket every member is a candidate of the least member only (its hub),
so a bucket of n members gives n - 1 candidates.  Candidates are confirmed on full sets and links joined
to components.  Members of a bucket that are still in several components go through an exact join:
shingles are ordered alike in every document, rare ones first, and a pair that is like enough shares
one among the first seventh of the smaller document and the first quarter of the larger one.  Only pairs
between components meet there, and only where sizes and places leave room for enough shared shingles.

Defined results: words are lower-cased (A-Z) runs of bytes other than white space; a text without words
is linked with nothing; a null number stands after all others and never is a component; rows with one
number are one document.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .exchange import save
from .fingerprint import bin_minima, densify
from .words import mix, shingle_sets, split_words

SHINGLE = 5
#: 40 bands of 4 bins: a pair at likeness 0.75 misses every band with a chance below 3e-7.
BANDS, ROWS = 40, 4
PERCENT = 75
_LAST = 2**63 - 1
_SLICE = 512
#: Cells in which shingles are counted to order them; what they hold changes the work, never the pairs.
_CELL_BITS = 18


def _set_hash(keys: np.ndarray, first: np.ndarray, salt: int) -> np.ndarray:
    """A hash of each document's set: the sum of its mixed members."""
    sums = np.zeros(len(keys) + 1, np.uint64)
    np.cumsum(mix(keys ^ np.uint64(salt)), out=sums[1:])
    return mix(sums[first[1:]] - sums[first[:-1]])


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def signatures(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc, n_shingles, s1, s2, signature) of every row; no shuffle."""
    schema = "doc long, n_shingles long, s1 long, s2 long, signature binary"

    def work(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, _SLICE):
                batch = whole.slice(at, _SLICE)
                keys, first = shingle_sets(split_words(batch.column("text")), SHINGLE)
                low = mix(densify(bin_minima(keys, first, BANDS * ROWS))).astype(np.uint16)
                columns = [
                    batch.column("doc"),
                    pa.array(np.diff(first).astype(np.int64)),
                    _signed(_set_hash(keys, first, 0x1234567)),
                    _signed(_set_hash(keys, first, 0x7654321)),
                    pa.array([row.tobytes() for row in low], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc", "n_shingles", "s1", "s2", "signature"])

    return docs.select(_number(key).alias("doc"), F.col(text).alias("text")).mapInArrow(work, schema)


def _number(key: str) -> Column:
    return F.coalesce(F.col(key).cast("long"), F.lit(_LAST))


def band_keys(signature: np.ndarray) -> np.ndarray:
    """Bucket keys of signatures, one column per band."""
    wide = signature.astype(np.uint64).reshape(len(signature), BANDS, ROWS)
    out = np.zeros((len(signature), BANDS), np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)
    for row in range(ROWS):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + wide[:, :, row])
    return out


def _entries(classes: DataFrame) -> DataFrame:
    """(bucket, doc) rows: every class in each of its buckets."""

    def deal(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            signature = np.stack([np.frombuffer(s, np.uint16) for s in table.column("signature").to_pylist()])
            keys = band_keys(signature)
            doc = np.repeat(np.asarray(table.column("doc")), keys.shape[1])
            yield pa.RecordBatch.from_arrays([_signed(keys.ravel()), pa.array(doc)], ["bucket", "doc"])

    return classes.mapInArrow(deal, "bucket long, doc long")


def _stars(entries: DataFrame) -> DataFrame:
    """(a, b): hub and member of every bucket, each pair once."""
    hubs = entries.groupBy("bucket").agg(F.min("doc").alias("a"), F.max("doc").alias("z")).where("a < z").select("bucket", "a")
    return entries.join(hubs, "bucket").where("doc <> a").select("a", F.col("doc").alias("b")).distinct()


def confirm(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are like enough; `texts` is (doc, text).

    A hub's text is worked on once per batch, and a hub of very many members is split by Spark.
    """
    both = pairs.join(texts.select(F.col("doc").alias("b"), F.col("text").alias("text_b")), "b").join(
        texts.select(F.col("doc").alias("a"), F.col("text").alias("text_a")), "a"
    )

    def check(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, _SLICE):
                batch = whole.slice(at, _SLICE)
                a = np.asarray(batch.column("a"))
                hub_text = batch.column("text_a")
                new = np.ones(len(a), bool)
                # Equal numbers side by side are one hub unless its text differs (one number, two texts).
                texts_a = hub_text.to_pylist()
                new[1:] = [a[i] != a[i - 1] or texts_a[i] != texts_a[i - 1] for i in range(1, len(a))]
                hub_of = np.cumsum(new) - 1
                hubs, hub_first = shingle_sets(split_words(hub_text.take(pa.array(np.flatnonzero(new)))), SHINGLE)
                members, first = shingle_sets(split_words(batch.column("text_b")), SHINGLE)
                linked = np.zeros(len(a), bool)
                for i, h in enumerate(hub_of):
                    mine, its = members[first[i] : first[i + 1]], hubs[hub_first[h] : hub_first[h + 1]]
                    shared = len(np.intersect1d(mine, its, assume_unique=True))
                    linked[i] = shared > 0 and 100 * shared >= PERCENT * (len(mine) + len(its) - shared)
                keep = pa.array(np.flatnonzero(linked))
                yield pa.RecordBatch.from_arrays([batch.column("a").take(keep), batch.column("b").take(keep)], ["a", "b"])

    return both.select("a", "b", "text_a", "text_b").mapInArrow(check, "a long, b long").distinct()


def _texts_of(docs: DataFrame, ids: DataFrame, key: str, text: str) -> DataFrame:
    rows = docs.select(_number(key).alias("doc"), F.col(text).alias("text"))
    # One plan at every size: the ids grow with the corpus and are never sent to all executors.
    return save(rows.join(ids.distinct().hint("merge"), "doc", "left_semi"), "candidate-texts")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("doc")).union(pairs.select(F.col("b").alias("doc")))


def _unresolved(entries: DataFrame, found: DataFrame) -> DataFrame:
    """(doc, component) of the members besides the hub of buckets that hold several components."""
    comp = found.select(F.col("node").alias("doc"), "component")
    placed = entries.join(comp, "doc", "left").select("bucket", "doc", F.coalesce("component", "doc").alias("component"))
    mixed = (
        placed.groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("n"), F.min("component").alias("low"), F.max("component").alias("high"), F.min("doc").alias("hub"))
        .where("n > 2 and low < high")
        .select("bucket", "hub")
    )
    # The hub has met all of them already.
    return placed.join(mixed, "bucket").where("doc <> hub").select("doc", "component").distinct()


def _cell(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(64 - _CELL_BITS)).astype(np.int64)


def _prefixes(texts: DataFrame) -> DataFrame:
    """(shingle, component, doc, n, place, low): the first shingles of every text in one order of all shingles, rare ones first.

    `low` marks those by which a document is found from one of its size or more.
    """

    def sets(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, _SLICE):
                batch = whole.slice(at, _SLICE)
                yield batch, *shingle_sets(split_words(batch.column("text")), SHINGLE)

    def count(batches):
        held = np.zeros(1 << _CELL_BITS, np.int64)
        for _, keys, _ in sets(batches):
            held += np.bincount(_cell(keys), minlength=len(held))
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(held[some])], ["cell", "n"])

    counts = texts.select("text").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    often = np.zeros(1 << _CELL_BITS, np.int64)
    often[np.asarray(counts.column("cell"))] = np.asarray(counts.column("n"))
    shared = texts.sparkSession.sparkContext.broadcast(often)

    def first(batches):
        for batch, keys, begin in sets(batches):
            size = np.diff(begin)
            row = np.repeat(np.arange(len(size)), size)
            order = np.lexsort((keys, shared.value[_cell(keys)], row))
            place, n = np.arange(len(keys)) - begin[row], size[row]
            take = place <= n - -(-PERCENT * n // 100)
            low = place <= n - -(-2 * PERCENT * n // (100 + PERCENT))
            row = row[take]
            columns = [
                _signed(keys[order][take]),
                *(batch.column(c).take(pa.array(row)) for c in ("component", "doc")),
                *(pa.array(x[take].astype(np.int64)) for x in (n, place)),
                pa.array(low[take]),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["shingle", "component", "doc", "n", "place", "low"])

    return texts.select("doc", "component", "text").mapInArrow(first, "shingle long, component long, doc long, n long, place long, low boolean")


def _between(prefixes: DataFrame) -> DataFrame:
    """(a, b): all pairs of documents of two components that may be like enough."""
    found = prefixes.where("low").select("shingle", F.col("component").alias("other"), F.col("doc").alias("y"), F.col("n").alias("n_y"), F.col("place").alias("at_y"))
    # A document asks for the other components that hold its shingle, so those of its own do not meet.
    asking = prefixes.join(found.select("shingle", "other").distinct(), "shingle").where("component <> other").drop("component", "low")
    room = f"least(n - place, n_y - at_y) * {100 + PERCENT} >= {PERCENT} * (n + n_y)"
    met = asking.join(found, ["shingle", "other"]).where(f"doc <> y AND (n_y < n OR n_y = n AND y < doc) AND {room}")
    return met.select(F.least("doc", "y").alias("a"), F.greatest("doc", "y").alias("b")).distinct()


def link_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, n_shingles, component): one row per row of `docs`; component is the least linked document."""
    rows = save(signatures(docs, key, text), "signatures")
    filled = rows.where("n_shingles > 0")
    classes = save(
        filled.groupBy("s1", "s2", "n_shingles")
        .agg(F.min("doc").alias("doc"), F.min("signature").alias("signature"))
        .select("s1", "s2", "doc", "signature"),
        "classes",
    )
    entries = _entries(classes.select("doc", "signature"))
    pairs = save(_stars(entries), "candidates")
    texts = _texts_of(docs, _ends(pairs), key, text)
    links = save(confirm(pairs, texts), "links")

    class_of = classes.select("s1", "s2", F.col("doc").alias("class"))
    placed = save(rows.drop("signature").join(class_of, ["s1", "s2"], "left").select("doc", "n_shingles", "class"), "placed")
    # One number with several sets is one document: its classes are linked.
    held = placed.where("class is not null").select("doc", "class")
    several = held.groupBy("doc").agg(F.min("class").alias("a"), F.max("class").alias("z")).where("a < z")
    same = held.join(several, "doc").where("class <> a").select("a", F.col("class").alias("b"))
    found = components(links.union(same))

    rest = save(_unresolved(entries.join(_ends(pairs).distinct(), "doc", "left_semi"), found), "mixed")
    prefixes = save(_prefixes(texts.join(rest.hint("merge"), "doc")), "prefixes")
    more = save(_between(prefixes).join(pairs, ["a", "b"], "left_anti"), "more-candidates")
    further = save(confirm(more, texts), "more-links")
    if not further.isEmpty():
        found = components(further.union(found.select(F.col("component").alias("a"), F.col("node").alias("b"))))
    found = found.withColumnRenamed("node", "class")
    return placed.join(found, "class", "left").select("doc", "n_shingles", F.coalesce("component", "class", "doc").alias("component"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: size of its shingle set, component_id, and whether it is the document that stays."""
    number = F.when(F.col("doc") < _LAST, F.col("doc"))
    component = F.when(F.col("component") < _LAST, F.col("component"))
    return (
        link_documents(docs, key, text)
        .withColumn("kept", F.col("doc") == F.col("component"))
        .select(number.alias(key), "n_shingles", component.alias("component_id"), "kept")
    )

"""Toxicity from the nearest labelled examples by exact TF-IDF cosine over all words.

Fitting takes at most MAX_EXAMPLES labelled rows, those of least hash of their number.  Every word of a
text counts: its weight is (1 + log count) times its IDF over all documents times a gain, which is 1
plus what the examples surely say about the label there (the log odds ratio, less three standard
errors).  A word that no example holds lengthens the vector only, at the IDF of a word that one more
example would bring.  Examples of one vector form a point that carries its counts of both labels.

Points lie in blocks.  Postings of all but the COMMON most frequent words are added up for every
point; for the common ones a block has its greatest weights, and is opened for a query only if its bound
reaches the query's neighbours found so far.  What is left is computed anew in double precision, so
neighbours are exact.  Their labels vote by cosine; a monotone map fitted on left-out examples turns
votes into probabilities.  Texts are scored where they lie: only counts of words that examples hold are
shuffled, and the index has a fixed bound of examples.

Defined results: a null or empty text, or one without any known word, gets the rate among examples
without one; a null label is no label; a document labelled more than once is toxic if any label says
so; without examples every score is 0.  Repeated rows get equal scores.
"""

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from .exchange import pack_ints, save, unpack_ints
from .words import IS_SIGN, split_words

MAX_EXAMPLES = 20_000
#: Gain of a word per unit of log odds ratio, and the standard errors taken off before.
GAIN, ERRORS = 3.0, 3.0
#: Words met by block, being in too many points for postings.
COMMON = 256
NEIGHBOURS = 25
PRIOR = 2.0
BLOCK = 64
EVIDENCE = 3
_SLICE = 512
#: Queries that go through the index together, and what one operation in single precision loses.
_TOGETHER, _UNIT = 64, 2.0**-23


def _terms(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, term, count) of every distinct term of every text; terms are hashes of lower-cased words."""
    words = split_words(column, IS_SIGN)
    hashes, doc = words.hashes(lower=True), words.doc_of_word()
    # Documents of a slice have nine bits, so document and the first bits of the hash sort as one number.
    if len(words.counts) <= _SLICE:
        order = np.argsort((doc.astype(np.uint64) << np.uint64(55)) | (hashes >> np.uint64(9)))
    else:
        order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    new = np.ones(len(doc), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    return doc[at], hashes[at], np.diff(np.append(at, len(doc)))


def _examples(docs: DataFrame, labels: DataFrame, key: str, text: str, train: Column) -> DataFrame:
    """(key, text, toxic): a bounded sample of labelled texts, each text once."""
    known = labels.where("toxic is not null").groupBy(key).agg((F.max("toxic") > 0).cast("int").alias("toxic")).where(train)
    sample = known.orderBy(F.xxhash64(key), key).limit(MAX_EXAMPLES)
    rows = docs.select(key, text).join(F.broadcast(sample), key)
    return rows.groupBy(F.xxhash64(text).alias("h")).agg(F.min(key).alias(key), F.first(text).alias("text"), F.max("toxic").alias("toxic"))


def _frequencies(docs: DataFrame, text: str, terms: np.ndarray) -> tuple[int, np.ndarray]:
    """How many documents there are, and how many hold each of the terms (ascending); counted in every task first."""
    known = docs.sparkSession.sparkContext.broadcast(terms)

    def count(batches):
        held, rows = np.zeros(len(known.value), np.int64), 0
        for whole in batches:
            rows += whole.num_rows
            for at in range(0, whole.num_rows, _SLICE):
                _, term, _ = _terms(whole.slice(at, _SLICE).column(0))
                place, hit = _places(known.value, term)
                held += np.bincount(place[hit], minlength=len(held))
        some = np.flatnonzero(held)
        columns = [pa.array(np.append(some, -1)), pa.array(np.append(held[some], rows))]
        yield pa.RecordBatch.from_arrays(columns, ["place", "n"])

    table = docs.select(text).mapInArrow(count, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    place, n = np.asarray(table.column("place")), np.asarray(table.column("n"))
    held = np.zeros(len(terms), np.int64)
    held[place[place >= 0]] = n[place >= 0]
    return int(n[place < 0].sum()), held


def _places(terms: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of every term among the ascending `terms`, and whether it is there."""
    if not len(terms):
        return np.zeros(len(term), np.int64), np.zeros(len(term), bool)
    place = np.minimum(np.searchsorted(terms, term), len(terms) - 1)
    return place, terms[place] == term


def _gain(size: int, hits: float, held: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """One for words that say nothing sure about the label, more for others; no word gets less."""
    cells = [toxic, hits - toxic, held - toxic, size - hits - held + toxic]
    a, b, c, d = (cell + 0.5 for cell in cells)
    return 1 + GAIN * np.maximum(0, np.abs(np.log(a * d / (b * c))) - ERRORS * np.sqrt(1 / a + 1 / b + 1 / c + 1 / d))


def _weigh(doc: np.ndarray, place: np.ndarray, hit: np.ndarray, count: np.ndarray, n_docs: int, weights: np.ndarray, other: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """Unit vectors as (term numbers, weights); words that are not hit have the weight `other` and only count for the length."""
    each = np.full(len(place), other)
    each[hit] = weights[place[hit]]
    each *= 1 + np.log(count)
    norm = np.sqrt(np.bincount(doc, each * each, minlength=n_docs))
    doc, place, each = doc[hit], place[hit].astype(np.int32), each[hit]
    each = np.round(each / norm[doc], 9).astype(np.float32)
    edges = np.searchsorted(doc, np.arange(n_docs + 1))
    return [(place[a:z], each[a:z]) for a, z in zip(edges[:-1], edges[1:])]


def _vectors(column, terms: np.ndarray, weights: np.ndarray, other: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """Unit vectors of texts over all their words."""
    doc, term, count = _terms(column)
    return _weigh(doc, *_places(terms, term), count, len(column), weights, other)


def _name(terms: np.ndarray, weights: np.ndarray) -> bytes:
    """What a vector is known by: 128 bits of hash, or nothing for an empty one."""
    return hashlib.blake2b(terms.tobytes() + weights.tobytes(), digest_size=16).digest() if len(terms) else b""


@dataclass
class Index:
    """Block-max index over points, given as (ascending term numbers, weights)."""

    points: list
    n: np.ndarray
    toxic: np.ndarray
    ids: list

    def __post_init__(self):
        self.lengths = np.array([len(t) for t, _ in self.points], np.int64)
        self.terms = np.concatenate([np.zeros(0, np.int32), *(np.asarray(t, np.int32) for t, _ in self.points)])
        self.weights = np.concatenate([np.zeros(0, np.float32), *(np.asarray(w, np.float32) for _, w in self.points)])
        self.points = range(len(self.lengths))
        self.first = None

    @staticmethod
    def unpacked(n: np.ndarray, toxic: np.ndarray, ids: list, lengths: np.ndarray, parts: list[tuple[bytes, bytes]]) -> "Index":
        """The index over packed points; what follows from them is built where it is asked first."""
        index = Index([], n, toxic, ids)
        index.lengths, index.points = lengths, range(len(lengths))
        if parts:
            index.terms, index.weights = (np.concatenate(x) for x in zip(*(_unpack_vectors(*part) for part in parts)))
        return index

    def _build(self):
        lengths = self.lengths
        self.first = np.append(0, np.cumsum(lengths))
        self.width = int(self.terms.max()) + 1 if len(self.terms) else 0
        blocks = -(-len(lengths) // BLOCK)
        held = np.bincount(self.terms, minlength=self.width)
        common = np.sort(np.argsort(-held, kind="stable")[:COMMON])
        self.slot = np.full(self.width, -1, np.int32)
        self.slot[common] = np.arange(len(common))
        point, slot = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths), self.slot[self.terms]
        dense = np.zeros((blocks, len(common), BLOCK), np.float32)
        often = slot >= 0
        dense[point[often] // BLOCK, slot[often], point[often] % BLOCK] = self.weights[often]
        self.dense, self.block_max = dense, np.ascontiguousarray(dense.max(axis=2).T) if blocks else np.zeros((len(common), 0), np.float32)
        rare = np.flatnonzero(~often)
        rare = rare[np.argsort(self.terms[rare], kind="stable")]
        self.edges = np.searchsorted(self.terms[rare], np.arange(self.width + 1))
        self.posting, self.posting_weight = point[rare].astype(np.intp), self.weights[rare]

    def vector(self, point: int) -> tuple[np.ndarray, np.ndarray]:
        if self.first is None:
            self._build()
        a, z = self.first[point], self.first[point + 1]
        return self.terms[a:z], self.weights[a:z]

    def nearest(self, vector, k: int, without: int = -1) -> list[tuple[int, float]]:
        """Points by falling cosine until they hold `k` examples, with all of equal cosine; `without` leaves one example of a point out."""
        return self.nearest_of([vector], k, [without])[0]

    def nearest_of(self, vectors: list, k: int, without: list[int]) -> list[list[tuple[int, float]]]:
        """`nearest` of several vectors at once."""
        if self.first is None:
            self._build()
        vectors = [(np.asarray(t, np.int64), np.asarray(w, np.float64)) for t, w in vectors]
        known = [t < self.width for t, _ in vectors]
        vectors = [(t[ok], w[ok]) for (t, w), ok in zip(vectors, known)]
        row = np.repeat(np.arange(len(vectors)), [len(t) for t, _ in vectors])
        term, weight = (np.concatenate(x) for x in zip(*vectors))
        slot = self.slot[term] if self.width else np.zeros(0, np.int32)
        often = slot >= 0
        query = np.zeros((len(vectors), self.block_max.shape[0]), np.float32)
        query[row[often], slot[often]] = weight[often]
        row, term, weight = row[~often], term[~often], weight[~often]
        blocks = self.block_max.shape[1]
        cosine = np.zeros((len(vectors), blocks * BLOCK), np.float32)
        first, begin, end = np.searchsorted(row, np.arange(len(vectors) + 1)), self.edges[term], self.edges[term + 1]
        for i, (a, z) in enumerate(zip(first[:-1], first[1:])):
            lists = [slice(x, y) for x, y in zip(begin[a:z].tolist(), end[a:z].tolist())]
            if lists:
                point = np.concatenate([self.posting[x] for x in lists])
                added = np.concatenate([self.posting_weight[x] for x in lists]) * np.repeat(weight[a:z], end[a:z] - begin[a:z])
                cosine[i] = np.bincount(point, added, blocks * BLOCK)
        cosine = cosine.reshape(len(vectors), blocks, BLOCK)
        # One point of each of k + 1 blocks is as near as this at least.
        most = cosine.max(axis=2)
        least = np.partition(most, blocks - k - 1, axis=1)[:, blocks - k - 1] if blocks > k else np.zeros(len(vectors), np.float32)
        # All weights are positive, so single precision is off by a share of what is added up.
        lost = 4 * _UNIT * (np.array([len(t) for t, _ in vectors]) + 16)
        opened = most + query @ self.block_max >= (least * (1 - lost))[:, None]
        cosine[~opened] = 0
        for block in np.flatnonzero(opened.any(axis=0)):
            asked = np.flatnonzero(opened[:, block])
            cosine[asked, block] += query[asked] @ self.dense[block]
        if blocks > k:
            least = np.partition(cosine.max(axis=2), blocks - k - 1, axis=1)[:, blocks - k - 1]
        flat, exact = cosine.reshape(len(vectors), -1), np.zeros(self.width)
        return [self._ranked(flat[i], float(least[i]), float(1 - lost[i]), exact, *vectors[i], k, without[i]) for i in range(len(vectors))]

    def _ranked(self, rough: np.ndarray, least: float, share: float, exact: np.ndarray, term: np.ndarray, weight: np.ndarray, k: int, without: int) -> list[tuple[int, float]]:
        at = np.flatnonzero(rough >= max(least * share, 1e-30))
        if len(at) > k:
            near = rough[at]
            at = at[near >= np.partition(near, len(near) - k - 1)[len(near) - k - 1] * share]
        if not len(at):
            return []
        length = self.first[at + 1] - self.first[at]
        held = [slice(x, x + n) for x, n in zip(self.first[at].tolist(), length.tolist())]
        exact[term] = weight
        product = exact[np.concatenate([self.terms[x] for x in held])] * np.concatenate([self.weights[x] for x in held])
        exact[term] = 0
        cosine = np.round(np.add.reduceat(product, np.cumsum(length) - length), 9)
        order = np.lexsort((at, -cosine))
        out, have, last = [], 0, 0.0
        for point, near, n in zip(at[order].tolist(), cosine[order].tolist(), self.n[at[order]].tolist()):
            if have >= k and near < last or near <= 0:
                break
            out.append((point, near))
            have, last = have + n - (point == without), near
        return out


def _pack_vectors(terms: np.ndarray, weights: np.ndarray) -> tuple[bytes, bytes]:
    return pack_ints(np.diff(terms.view(np.uint32), prepend=np.uint32(0))), pack_ints(weights.view(np.uint32))


def _unpack_vectors(steps: bytes, weights: bytes) -> tuple[np.ndarray, np.ndarray]:
    terms = np.cumsum(unpack_ints(steps).astype(np.uint32), dtype=np.uint32).view(np.int32)
    return terms, unpack_ints(weights).astype(np.uint32).view(np.float32)


class Packed:
    """Points as the driver passes them on: parts in order, opened in tasks only, where they become an `Index`."""

    def __init__(self, table: pa.Table):
        self.n, self.toxic = (np.array([x for part in table.column(c).to_pylist() for x in part], float) for c in ("n", "toxic"))
        self.ids = [x for part in table.column("ids").to_pylist() for x in part]
        self.lengths = np.array([x for part in table.column("lengths").to_pylist() for x in part], np.int64)
        self.parts = list(zip(table.column("terms").to_pylist(), table.column("weights").to_pylist()))

    def __reduce__(self):
        return Index.unpacked, (self.n, self.toxic, self.ids, self.lengths, self.parts)


def _pool_adjacent(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Monotone least-squares fit of y on x: the steps' places and heights."""
    stack: list[list[float]] = []
    for i in np.argsort(x, kind="stable"):
        stack.append([float(x[i]), float(y[i]), float(w[i])])
        while len(stack) > 1 and (stack[-2][1] >= stack[-1][1] or stack[-2][0] == stack[-1][0]):
            place, height, weight = stack.pop()
            both = stack[-1][2] + weight
            stack[-1] = [place, (stack[-1][1] * stack[-1][2] + height * weight) / both, both]
    return np.array([s[0] for s in stack]), np.array([s[1] for s in stack])


class Scorer:
    """Votes of the nearest examples, as probabilities; a vector met before in the task is looked up."""

    def __init__(self, terms: np.ndarray, weights: np.ndarray, other: float, index: Index, rate: float, bare: float):
        self.terms, self.weights, self.other, self.index, self.rate, self.bare = terms, weights, other, index, rate, bare
        self.places, self.heights = np.zeros(1), np.zeros(1)
        self.known: dict = {}
        self.shared = None

    def __getstate__(self):
        steps = np.diff(self.terms, prepend=np.uint64(0))
        return pack_ints(steps), pack_ints(self.weights.view(np.uint64)), self.other, self.index, self.rate, self.bare

    def __setstate__(self, state):
        steps, weights, *others = state
        self.__init__(np.cumsum(unpack_ints(steps), dtype=np.uint64), unpack_ints(weights).view(np.float64), *others)

    def votes(self, vectors: list, without: list[int], labels: list[int]) -> list[tuple[float, list[int]]]:
        out = []
        for near, own, label in zip(self.index.nearest_of(vectors, NEIGHBOURS, without), without, labels):
            weight, toxic = PRIOR, PRIOR * self.rate
            for point, cosine in near:
                weight += cosine * cosine * (self.index.n[point] - (point == own))
                toxic += cosine * cosine * (self.index.toxic[point] - (point == own) * label)
            out.append((float(toxic / weight), [self.index.ids[p] for p, _ in near[:EVIDENCE]]))
        return out

    def left_out(self, points: list[int]) -> tuple[list[float], list[int], list[float]]:
        """Votes on one example of each point and label that the others give, the label, and how many examples are alike."""
        toxic = self.index.toxic
        cases = [(p, label, n) for p in points for label, n in ((1, toxic[p]), (0, self.index.n[p] - toxic[p])) if n]
        got = self.votes([self.index.vector(p) for p, _, _ in cases], [p for p, _, _ in cases], [label for _, label, _ in cases])
        return [g[0] for g in got], [c[1] for c in cases], [float(c[2]) for c in cases]

    def __call__(self, vectors: list) -> list[tuple[float, list[int]]]:
        names = [_name(t, w) for t, w in vectors]
        if len(self.known) > 100_000:
            self.known.clear()
        self.known[b""] = (self.bare, [])
        new = {name: v for name, v in zip(names, vectors) if name not in self.known}
        for at in range(0, len(new), _TOGETHER):
            part = list(new.items())[at : at + _TOGETHER]
            for (name, _), (vote, evidence) in zip(part, self.votes([v for _, v in part], [-1] * len(part), [0] * len(part))):
                fitted = float(np.interp(vote, self.places, self.heights))
                # A little of the vote itself keeps the order inside a step.
                self.known[name] = (min(1.0, max(0.0, 0.98 * fitted + 0.02 * vote)), evidence)
        return [self.known[name] for name in names]


def _bags(examples: DataFrame, key: str) -> DataFrame:
    """(id, toxic, terms, counts) of every example, the words as packed numbers; saved, as they are read more than once."""

    def bags(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, _SLICE):
                batch = whole.slice(at, _SLICE)
                doc, term, count = _terms(batch.column("text"))
                edges = np.searchsorted(doc, np.arange(batch.num_rows + 1))
                packed = [pa.array([x[a:z].tobytes() for a, z in zip(edges[:-1], edges[1:])], pa.binary()) for x in (term, count.astype(np.int32))]
                columns = [batch.column(key).cast(pa.int64()), batch.column("toxic"), *packed]
                yield pa.RecordBatch.from_arrays(columns, ["id", "toxic", "terms", "counts"])

    schema = "id long, toxic int, terms binary, counts binary"
    return save(examples.select(key, "text", "toxic").mapInArrow(bags, schema), "examples")


def _unpacked(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all rows of a packed column, and how many each row has."""
    rows = column.to_pylist()
    lengths = np.array([len(r) for r in rows], np.int64) // np.dtype(kind).itemsize
    return np.frombuffer(b"".join(rows), kind), lengths


def _slices(batches):
    for whole in batches:
        for at in range(0, whole.num_rows, _SLICE):
            yield whole.slice(at, _SLICE)


def _vocabulary(bags: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All terms of the examples (ascending), how many examples hold each, and how many toxic ones."""

    def count(batches):
        for batch in _slices(batches):
            term, lengths = _unpacked(batch.column("terms"), np.uint64)
            terms, place = np.unique(term, return_inverse=True)
            toxic = np.bincount(place, np.repeat(np.asarray(batch.column("toxic")), lengths), len(terms)).astype(np.int64)
            columns = [pa.array(terms.view(np.int64)), pa.array(np.bincount(place, minlength=len(terms))), pa.array(toxic)]
            yield pa.RecordBatch.from_arrays(columns, ["term", "n", "toxic"])

    counted = bags.mapInArrow(count, "term long, n long, toxic long").groupBy("term").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic")).toArrow()
    term, n, toxic = (np.asarray(counted.column(c), np.int64) for c in ("term", "n", "toxic"))
    order = np.argsort(term.view(np.uint64))
    return term.view(np.uint64)[order], n[order], toxic[order]


def _points(bags: DataFrame, terms: np.ndarray, weights: np.ndarray, other: float, often: list[int]) -> Packed:
    """Examples of one vector as one point; those that hold the same of the terms `often` lie together."""
    known = bags.sparkSession.sparkContext.broadcast((terms, weights))
    place_of = {place: 1 << (len(often) - 1 - i) for i, place in enumerate(often)}

    def weigh(batches):
        terms, weights = known.value
        common = np.sort(np.array(often, np.int32))
        bits = np.array([place_of[p] for p in common.tolist()], np.int64)
        for batch in _slices(batches):
            (term, lengths), (count, _) = _unpacked(batch.column("terms"), np.uint64), _unpacked(batch.column("counts"), np.int32)
            doc = np.repeat(np.arange(batch.num_rows, dtype=np.int32), lengths)
            vectors = _weigh(doc, *_places(terms, term), count, batch.num_rows, weights, other)
            names, held = [_name(t, w) for t, w in vectors], [int(bits[np.isin(common, t)].sum()) for t, _ in vectors]
            packed = [pa.array([v[i].tobytes() for v in vectors], pa.binary()) for i in (0, 1)]
            columns = [pa.array(held, pa.int64()), pa.array(names, pa.binary()), batch.column("id"), batch.column("toxic"), *packed]
            yield pa.RecordBatch.from_arrays(columns, ["held", "name", "id", "toxic", "terms", "weights"])

    def pack(batches):
        for batch in _slices(batches):
            (term, lengths), (weight, _) = _unpacked(batch.column("terms"), np.int32), _unpacked(batch.column("weights"), np.float32)
            lists = [*(batch.column(c).to_pylist() for c in ("n", "toxic", "id")), lengths]
            columns = [*(pa.array([x], pa.list_(pa.int64())) for x in lists), *(pa.array([x], pa.binary()) for x in _pack_vectors(term, weight))]
            yield pa.RecordBatch.from_arrays(columns, ["n", "toxic", "ids", "lengths", "terms", "weights"])

    vectors = bags.where("octet_length(terms) > 0").mapInArrow(weigh, "held long, name binary, id long, toxic int, terms binary, weights binary")
    alike = vectors.groupBy("held", "name").agg(
        F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic"), F.min("id").alias("id"), F.first("terms").alias("terms"), F.first("weights").alias("weights")
    )
    schema = "n array<long>, toxic array<long>, ids array<long>, lengths array<long>, terms binary, weights binary"
    return Packed(alike.orderBy("held", "name").drop("held", "name").mapInArrow(pack, schema).toArrow())  # MAX_EXAMPLES at most, packed


def fit(docs: DataFrame, labels: DataFrame, train: Column, key: str = "doc_id", text: str = "text") -> Scorer:
    """Learn from the labels for which `train` (a condition on the key) holds."""
    spark = docs.sparkSession
    bags = _bags(_examples(docs, labels.select(key, "toxic"), key, text, train), key)
    bare = F.octet_length("terms") == 0
    size, hits, n, bad = bags.agg(F.count(F.lit(1)), F.sum("toxic"), F.count_if(bare), F.sum(F.when(bare, F.col("toxic")))).first()
    hits, bad = float(hits or 0), float(bad or 0)
    terms, held_here, toxic_here = _vocabulary(bags)
    n_docs, held = _frequencies(docs, text, terms) if len(terms) else (0, np.zeros(0, np.int64))
    gain = _gain(size, hits, held_here, toxic_here.astype(float))
    weights = (np.log((1 + n_docs) / (1 + held)) + 1) * gain
    other = np.log((1 + n_docs) / (1 + n_docs / (1 + size))) + 1

    # Texts of one language lie together, by the most common words they hold.
    often = np.argsort(-held_here, kind="stable")[:32].tolist()
    rate = hits / size if size else 0.0
    packed = _points(bags, terms, weights, float(other), often)
    entries = len(packed.lengths)
    scorer = Scorer(terms, weights, float(other), packed, rate, float((bad + PRIOR * rate) / (n + PRIOR)))
    scorer.shared = shared = spark.sparkContext.broadcast(scorer)
    # The points lie in the broadcast, for the tasks; the driver needs them no longer.
    scorer.index = packed = None
    if entries:

        def votes(batches):
            for batch in batches:
                points = batch.column(0).to_pylist()
                for at in range(0, len(points), _TOGETHER):
                    x, y, w = shared.value.left_out(points[at : at + _TOGETHER])
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.float64()), pa.array(y, pa.int32()), pa.array(w, pa.float64())], ["x", "y", "w"])

        tasks = -(-entries // 1024)
        got = spark.range(0, entries, 1, tasks).mapInArrow(votes, "x double, y int, w double").toArrow()
        x, y, w = (np.asarray(got.column(c), float) for c in ("x", "y", "w"))
        scorer.places, scorer.heights = _pool_adjacent(*(v[np.lexsort((w, y, x))] for v in (x, y, w)))
    return scorer


def score_documents(docs: DataFrame, scorer: Scorer, text: str = "text", score: str = "score", evidence: str = "evidence") -> DataFrame:
    """All columns of `docs` with the score and the numbers of the nearest examples."""
    schema = StructType([*docs.schema.fields]).add(score, "double").add(evidence, ArrayType(LongType()))
    shared, steps = scorer.shared, (scorer.places, scorer.heights)

    def work(batches):
        scorer = shared.value
        scorer.places, scorer.heights = steps
        for whole in batches:
            for at in range(0, whole.num_rows, _SLICE):
                batch = whole.slice(at, _SLICE)
                got = scorer(_vectors(batch.column(text), scorer.terms, scorer.weights, scorer.other))
                columns = [*batch.columns, pa.array([g[0] for g in got], pa.float64()), pa.array([g[1] for g in got], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.mapInArrow(work, schema)

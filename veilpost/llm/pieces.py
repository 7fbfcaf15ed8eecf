"""Encoding and decoding with a merge vocabulary of pieces, by suffix-array matching.

The texts of a batch are cut where no piece can lie across, and their distinct units are joined to one
text.  Its suffixes are sorted as deep as the longest piece; a binary search of every piece finds the
range of suffixes that begin with it, which are all its occurrences.  The occurrences, sorted by
position, are the edges of a lattice.  The vocabulary is one of merges, so relaxing an edge means
joining two neighbouring symbols, best score first and leftmost among equals; that gives the ids
that merging gives, where a shortest path over scores would not.

Defined results: a null or empty text has no ids; characters in no piece become byte ids; decoding gives
the text back unless it holds U+2581, which the vocabulary writes spaces with.
"""

import heapq
import re
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StructType
from sentencepiece import sentencepiece_model_pb2

SPACE = "▁"
#: Longer units are relaxed one by one from a heap.
LONG = 48
#: Ends every unit: no text of whole characters holds it.
_END = "\ud800"
_SLICE = 1024
_CHARS = 3 << 19
#: Units remembered per worker, about 200 bytes each.
_KNOWN = 600_000
_models: dict[str, "Pieces"] = {}


@dataclass
class Lattice:
    """Occurrences of pieces in the joined units, by position."""

    start: np.ndarray
    end: np.ndarray
    piece: np.ndarray


@dataclass
class Suffixes:
    """Places of all suffixes in order, and the first characters of each packed into one number."""

    places: np.ndarray
    heads: np.ndarray
    dense: np.ndarray  # number of every character that occurs, by code; 0 for the others
    bits: int
    length: int  # characters in a head


def gather(flat: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches of `flat` at `begin` with `size` items, one after the other."""
    before = np.cumsum(size) - size
    return flat[np.repeat(begin - before, size) + np.arange(int(size.sum()))]


def sort_suffixes(codes: np.ndarray, depth: int) -> Suffixes:
    """All suffixes, ordered by their first `depth` characters at least.

    As many characters as fit are packed into one number; from there prefix lengths double.
    """
    present = np.zeros(int(codes.max(initial=0)) + 1, bool)
    present[codes] = True
    dense = np.cumsum(present) * present
    numbered = dense[codes]
    bits = int(dense.max(initial=1)).bit_length()
    length = packed = min(depth, 62 // bits)
    padded = np.append(numbered, np.zeros(length, np.int64))
    head = np.zeros(len(codes), np.int64)
    for i in range(length):
        head = (head << bits) | padded[i : i + len(codes)]
    key = head
    while length < depth:
        _, rank = np.unique(key, return_inverse=True)
        ahead = np.zeros(len(rank), np.int64)
        ahead[:-length] = rank[length:] + 1
        key = rank * np.int64(len(rank) + 2) + ahead
        length *= 2
    places = np.argsort(key).astype(np.int32)
    return Suffixes(places, head[places], dense, bits, packed)


class Pieces:
    """A vocabulary read from its model file."""

    def __init__(self, path: str):
        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        if model.trainer_spec.model_type != 2 or model.normalizer_spec.name != "identity":
            raise ValueError("only merge vocabularies without normalisation are supported")
        # The vocabulary may want one space before every text; decoding takes it off again.
        self.lead = SPACE if model.normalizer_spec.add_dummy_prefix else ""
        self.text = [p.piece for p in model.pieces]
        normal = [i for i, p in enumerate(model.pieces) if p.type == 1]
        self.byte = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == 6}
        self.single = {self.text[i]: i for i in normal if len(self.text[i]) == 1}
        self.number = {self.text[i]: i for i in normal if len(self.text[i]) > 1}
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == 2)
        # Pieces of one score are equally good; the leftmost is joined first.
        scores = np.array([p.score for p in model.pieces])
        self.rank = np.unique(-scores, return_inverse=True)[1]
        if any(re.search(f"[^{SPACE}]{SPACE}", t) for t in self.number):
            raise ValueError("pieces with inner spaces are not supported")
        alone = "" if any("\n" in t for t in self.number) else "\n"
        self.unit = re.compile(f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+" + (f"|{alone}" if alone else ""))
        self.raw = {i: t.replace(SPACE, " ").encode() for i, t in enumerate(self.text)} | {i: bytes([b]) for b, i in self.byte.items()}
        lengths = np.array([len(self.raw[i]) for i in range(len(self.text))], np.int64)
        self.raw_flat = np.frombuffer(b"".join(self.raw[i] for i in range(len(self.text))), np.uint8)
        self.raw_begin, self.raw_size = np.cumsum(lengths) - lengths, lengths
        self.forget()

        words = sorted(self.number)
        self.ids = np.array([self.number[w] for w in words], np.int64)
        self.sizes = np.array([len(w) for w in words], np.int64)
        self.depth = int(self.sizes.max(initial=1))
        self.codes = np.zeros((len(words), self.depth), np.int64)
        for row, w in enumerate(words):
            self.codes[row, : len(w)] = [ord(c) for c in w]

    def forget(self) -> None:
        """Start with no known units.  Unit number n has the `size[n]` ids of `flat` from `begin[n]` on."""
        self.known: dict[str, int] = {}
        self.flat = np.zeros(0, np.int32)
        self.begin = self.size = np.zeros(0, np.int64)

    def _ranges(self, codes: np.ndarray, suffixes: Suffixes) -> tuple[np.ndarray, np.ndarray]:
        """For every piece, the first suffix that begins with it and the first one past those.

        The heads are searched first; only pieces longer than a head are searched on, in their range.
        """
        length, bits, dense = suffixes.length, suffixes.bits, suffixes.dense
        inside = np.arange(self.depth) < self.sizes[:, None]
        numbered = np.where(self.codes < len(dense), dense[np.minimum(self.codes, len(dense) - 1)], 0)
        known = ((numbered > 0) | ~inside).all(axis=1)
        least = np.zeros(len(self.ids), np.int64)
        most = np.zeros(len(self.ids), np.int64)
        for i in range(length):
            least = (least << bits) | np.where(inside[:, i], numbered[:, i], 0)
            most = (most << bits) | np.where(inside[:, i], numbered[:, i], (1 << bits) - 1)
        low = np.searchsorted(suffixes.heads, least, "left")
        high = np.searchsorted(suffixes.heads, most, "right")
        low[~known] = high[~known] = 0
        longer = np.flatnonzero((self.sizes > length) & (low < high))
        bounds = [self._bound(codes, suffixes.places, longer, low[longer], high[longer], upper) for upper in (False, True)]
        low[longer], high[longer] = bounds
        return low, high

    def _bound(self, codes, suffixes, pieces, low, high, upper: bool) -> np.ndarray:
        """For every given piece, the first suffix of its range that begins with it (or, `upper`, the first one past those)."""
        padded = np.append(codes, np.zeros(self.depth, np.int64))
        wanted = self.codes[pieces]
        inside = np.arange(self.depth) < self.sizes[pieces][:, None]
        low, high = low.copy(), high.copy()
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low
            middle = (low[open_] + high[open_]) // 2
            got = padded[suffixes[middle][:, None] + np.arange(self.depth)]
            differs = (got != wanted[open_]) & inside[open_]
            first = differs.argmax(axis=1)
            rows = np.arange(len(open_))
            same = ~differs[rows, first]
            smaller = np.where(same, upper, got[rows, first] < wanted[open_, first])
            low[open_[smaller]] = middle[smaller] + 1
            high[open_[~smaller]] = middle[~smaller]

    def match(self, codes: np.ndarray) -> Lattice:
        """All occurrences of all pieces of two or more characters, sorted by position."""
        suffixes = sort_suffixes(codes, self.depth)
        low, high = self._ranges(codes, suffixes)
        counts = high - low
        piece = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
        start = gather(suffixes.places, low, counts)
        order = np.argsort(start)
        start, piece = start[order], piece[order]
        end = (start + self.sizes[piece]).astype(np.int32)
        return Lattice(start, end, self.ids[piece].astype(np.int32))

    def _relax(self, length: int, lattice: Lattice, unit_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Join symbols, in every unit its best edge per round; gives symbol borders and the pieces at them."""
        border = np.ones(length + 1, bool)
        at = np.full(length + 1, -1, np.int64)
        following = np.arange(1, length + 3, dtype=np.int32)  # the next border behind each
        start, end, piece = lattice.start, lattice.end, lattice.piece
        key = self.rank[piece].astype(np.int64) * np.int64(length + 1) + start
        while len(start):
            alive = border[start] & border[end]
            start, end, piece, key = start[alive], end[alive], piece[alive], key[alive]
            middle = following[start]
            choice = np.flatnonzero(following[middle] == end)
            if not len(choice):
                break
            unit = unit_of[start[choice]]
            heads = np.flatnonzero(np.diff(unit, prepend=-1))
            best = np.minimum.reduceat(key[choice], heads)
            won = choice[key[choice] == np.repeat(best, np.diff(np.append(heads, len(unit))))]
            # Two pieces of one score and start in one unit cannot both join two symbols: their ends differ.
            border[middle[won]] = False
            following[start[won]] = end[won]
            at[start[won]] = piece[won]
        return border, at

    def _relax_long(self, unit: str) -> list[tuple[int, int]]:
        """(start, end) symbols of one long unit, its joins taken from a heap."""
        n = len(unit)
        following, before = list(range(1, n + 1)), list(range(-1, n))
        heap: list = []

        def offer(left: int):
            right = following[left] if 0 <= left < n else n
            if left >= 0 and right < n:
                piece = self.number.get(unit[left : following[right]]) if following[right] - left <= self.depth else None
                if piece is not None:
                    heapq.heappush(heap, (self.rank[piece], left, right, following[right]))

        for i in range(n):
            offer(i)
        gone = [False] * n
        while heap:
            _, left, right, end = heapq.heappop(heap)
            if gone[left] or gone[right] or following[left] != right or following[right] != end:
                continue
            gone[right] = True
            following[left] = end
            if end < n:
                before[end] = left
            offer(before[left])
            offer(left)
        return [(i, following[i]) for i in range(n) if not gone[i]]

    def _single(self, char: str) -> list[int]:
        if char in self.single:
            return [self.single[char]]
        return [self.byte.get(b, self.unknown) for b in char.encode()]

    def _remember(self, units: list[str], flat: np.ndarray, sizes: np.ndarray) -> None:
        self.known.update(zip(units, range(len(self.begin), len(self.begin) + len(units))))
        self.begin = np.append(self.begin, len(self.flat) + np.cumsum(sizes) - sizes)
        self.size = np.append(self.size, sizes)
        self.flat = np.append(self.flat, flat.astype(np.int32))

    def learn(self, units: list[str]) -> None:
        """Encode units not met before."""
        long = [u for u in units if len(u) > LONG]
        if long:
            found = []
            for unit in long:
                ids: list[int] = []
                for a, z in self._relax_long(unit):
                    ids += [self.number[unit[a:z]]] if z - a > 1 else self._single(unit[a])
                found.append(np.array(ids, np.int32))
            self._remember(long, np.concatenate(found), np.array([len(i) for i in found], np.int64))
        units = [u for u in units if len(u) <= LONG]
        if not units:
            return
        sizes = np.array([len(u) + 1 for u in units])
        joined = _END.join(units) + _END
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        unit_of = np.repeat(np.arange(len(units)), sizes)
        border, at = self._relax(len(codes), self.match(codes), unit_of)
        # What starts at a border is a piece, a character with ids of its own, or the end of a unit, which has none.
        chars = np.unique(codes)
        singles = [self._single(chr(c)) if chr(c) != _END else [] for c in chars]
        counts = np.array([len(ids) for ids in singles], np.int64)
        starts = np.flatnonzero(border[:-1])
        char = np.searchsorted(chars, codes[starts])
        joint = at[starts] >= 0
        # Pieces and the ids of single characters, one behind the other, are what each symbol picks its ids from.
        table = np.concatenate([np.arange(len(self.text)), np.array([*chain.from_iterable(singles)], np.int64)])
        begin = np.where(joint, at[starts], len(self.text) + (np.cumsum(counts) - counts)[char])
        size = np.where(joint, 1, counts[char])
        per_unit = np.bincount(unit_of[starts], weights=size, minlength=len(units)).astype(np.int64)
        self._remember(units, gather(table, begin, size), per_unit)

    def encode_flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text's begin (with the end of the last)."""
        if len(self.known) > _KNOWN:
            self.forget()
        cut = [self.unit.findall(self.lead + t.replace(" ", SPACE)) if t else [] for t in texts]
        counts = np.array([0, *map(len, cut)], np.int64)
        met = pa.array([*chain.from_iterable(cut)], pa.string()).dictionary_encode()
        distinct = met.dictionary.to_numpy(zero_copy_only=False).tolist()
        self.learn([u for u in distinct if u not in self.known])
        number = np.array([self.known[u] for u in distinct], np.int64)[met.indices.to_numpy()]
        size = self.size[number]
        ends = np.append(0, np.cumsum(size))[np.cumsum(counts)]
        return gather(self.flat, self.begin[number], size), ends

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text."""
        flat, ends = self.encode_flat(texts)
        return [flat[a:z] for a, z in zip(ends[:-1], ends[1:])]

    def decode_flat(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """The texts of ids that lie one after the other."""
        size = self.raw_size[ids]
        raw = gather(self.raw_flat, self.raw_begin[ids], size).tobytes()
        cuts = np.append(0, np.cumsum(size))[ends].tolist()
        texts = [raw[a:z].decode("utf-8", "replace") for a, z in zip(cuts, cuts[1:])]
        return [t[1:] if self.lead and t.startswith(" ") else t for t in texts]

    def decode(self, ids) -> str:
        return self.decode_flat(np.array(ids, np.int64), np.array([0, len(ids)]))[0]


def vocabulary(path: str) -> Pieces:
    """The vocabulary of a model file, read once per worker."""
    if path not in _models:
        _models[path] = Pieces(path)
    return _models[path]


def encode_documents(
    docs: DataFrame, path: str, text: str = "text", out: str = "ids", decoded: str | None = None
) -> DataFrame:
    """All columns of `docs` with the ids of its whole texts; no shuffle.

    `decoded` names a column for the texts that the ids decode to, made in the same pass.
    """
    schema = StructType([*docs.schema.fields]).add(out, ArrayType(IntegerType(), False))
    if decoded:
        schema = schema.add(decoded, "string")

    def work(batches):
        model = vocabulary(path)
        for batch in _bounded(batches, text):
            ids, ends = model.encode_flat([t or "" for t in batch.column(text).to_pylist()])
            lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))
            columns = [*batch.columns, lists]
            if decoded:
                columns.append(pa.array(model.decode_flat(ids, ends), pa.string()))
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.mapInArrow(work, schema)


def decode_documents(docs: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """All columns of `docs` with the texts of its ids; a null list has a null text."""
    schema = StructType([*docs.schema.fields]).add(out, "string")

    def work(batches):
        model = vocabulary(path)
        for whole in batches:
            for at in range(0, whole.num_rows, _SLICE):
                batch = whole.slice(at, _SLICE)
                lists = batch.column(ids)
                sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
                texts = model.decode_flat(lists.flatten().to_numpy(zero_copy_only=False), np.append(0, np.cumsum(sizes)))
                decoded = pa.array(texts, pa.string(), mask=lists.is_null().to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([*batch.columns, decoded], schema.names)

    return docs.mapInArrow(work, schema)


def _bounded(batches, text: str):
    """Slices of few rows and, unless one text alone is longer, of few characters."""
    for whole in batches:
        sizes = np.cumsum(pc.fill_null(pc.utf8_length(whole.column(text)), 0).to_numpy())
        begin = 0
        while begin < whole.num_rows:
            done = sizes[begin - 1] if begin else 0
            stop = max(begin + 1, min(int(np.searchsorted(sizes, done + _CHARS)), whole.num_rows))
            yield whole.slice(begin, stop - begin)
            begin = stop

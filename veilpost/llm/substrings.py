"""Repeated passages: words covered by a window that a document of smaller number holds as well.

Counting windows exactly for the whole corpus would move every window.  First, each block of documents
makes a count-min sketch of its windows (`DEPTH` rows of cells, stored sparsely); the sketches
are merged by adding cells, and each block learns which of its windows may occur twice.  A merged cell
never holds less than a window's true count, so no repeated window is missed.  Then only those
windows are grouped exactly, by 96 bits of hash, for the least document that holds them.

The sketch grows with the corpus, so the share of windows let through by chance stays the same.

Defined results: a null text has no words; rows with one number are one document; a null number comes
after all others; texts shorter than a window lose nothing; windows are judged on the input.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .exchange import PIECE, answers, ask, joined, pieces, save, save_blocks
from .words import Words, document_windows, mix, split_words, windows

WINDOW = 13
DEPTH = 2
#: Sketch cells per window of the corpus, in each row of the sketch.
CELLS_PER_WINDOW = 4
#: Smaller than other blocks: a block's windows take several arrays of 8 bytes per word.
BLOCK_BYTES = 4 << 20
_LAST = 2**63 - 1


class Windows:
    """Windows of a block: place of the first word, document, and the hash they are known by."""

    def __init__(self, table: pa.Table, size: int):
        self.words: Words = split_words(table.column("text"))
        hashes = self.words.hashes(lower=False)
        self.at, self.doc = document_windows(self.words, size)
        self.key = windows(hashes, size)[self.at]
        self._hashes, self._size = hashes, size
        self.number = np.asarray(table.column("key").combine_chunks().fill_null(_LAST))

    def check(self, chosen: np.ndarray) -> np.ndarray:
        """32 more bits of hash, independent of the key."""
        return windows(mix(self._hashes ^ np.uint64(0x5BF0A8B1)), self._size, kind=3)[self.at[chosen]] >> np.uint64(32)


def _cells(keys: np.ndarray, row: int, width: int) -> np.ndarray:
    """Cells of distinct keys in one row of the sketch, scaled to the key space so that buckets cut it evenly."""
    return _scaled(mix(keys + np.uint64((0x9E3779B97F4A7C15 * (row + 1)) % 2**64)), width) << np.uint64(64 - _bits(width))


def _scaled(keys: np.ndarray, width: int) -> np.ndarray:
    """Upper 64 bits of the 128-bit product of keys and width: all bits of a key count, and no width overflows."""
    half, low = np.uint64(32), np.uint64(2**32 - 1)
    k1, k0, w1, w0 = keys >> half, keys & low, np.uint64(width >> 32), np.uint64(width & (2**32 - 1))
    middle = k1 * w0 + (k0 * w0 >> half)
    return k1 * w1 + (middle >> half) + (k0 * w1 + (middle & low) >> half)


def _bits(width: int) -> int:
    return max(1, (width - 1).bit_length())


def _sketch(size: int, n: int, width: int):
    def sketch(table: pa.Table) -> pa.Table:
        got = Windows(table, size)
        block = table.column("block")[0].as_py()
        # A document adds one to a window's count however often it holds it, so only other documents make it repeated.
        number = got.number[got.doc]
        order = np.lexsort((number, got.key))
        keys, number = got.key[order], number[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (number[1:] != number[:-1])
        keys = keys[new]
        out = []
        for row in range(DEPTH):
            cells, counts = np.unique(_cells(keys, row, width), return_counts=True)
            out.append(pieces(block, n, cells, np.minimum(counts, 255), tag=row))
        return pa.concat_tables(out)

    return sketch


def _sum_cells(bucket: int, columns: list[np.ndarray], piece: np.ndarray) -> np.ndarray:
    _, place = np.unique(columns[0], return_inverse=True)
    return np.minimum(np.bincount(place, columns[1]), 2)[place].astype(np.uint64)


def _maybe_repeated(got: Windows, back: pa.Table, n: int, width: int) -> np.ndarray:
    """Which windows of the block the merged sketch counts at least twice in every row."""
    keep = np.ones(len(got.key), bool)
    for row in range(DEPTH):
        cells, place = np.unique(_cells(got.key, row, width), return_inverse=True)
        keep &= joined(answers(back, row, n))[place] >= 2
    return keep


def _candidates(got: Windows, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (key, check) of the windows let through, the least document of each, and the place of every such window."""
    key, check = got.key[keep], got.check(keep)
    number = got.number[got.doc[keep]]
    order = np.lexsort((number, check, key))
    key, check, number = key[order], check[order], number[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (check[1:] != check[:-1])
    place = np.empty(len(key), np.int64)
    place[order] = np.cumsum(new) - 1
    return key[new], check[new], number[new], place


def _least_document(bucket: int, columns: list[np.ndarray], piece: np.ndarray) -> np.ndarray:
    """One for a (key, check) whose least document lies in the piece, else zero."""
    key, check, number = columns[0], columns[1], columns[2].view(np.int64)
    order = np.lexsort((number, check, key))
    new = np.ones(len(key), bool)
    new[1:] = (key[order][1:] != key[order][:-1]) | (check[order][1:] != check[order][:-1])
    least = number[order][new][np.cumsum(new) - 1]
    out = np.zeros(len(key), np.uint64)
    out[order] = number[order] == least
    return out


def _exact(size: int, n: int, width: int):
    def exact(table: pa.Table, back: pa.Table) -> pa.Table:
        got = Windows(table, size)
        key, check, number, _ = _candidates(got, _maybe_repeated(got, back, n, width))
        return pieces(table.column("block")[0].as_py(), n, key, check, number.view(np.uint64), tag=DEPTH)

    return exact


def removed_words(table: pa.Table, back: pa.Table, size: int, n: int, width: int) -> tuple[Words, np.ndarray]:
    """The block's words, and for each whether a window with a smaller holder covers it."""
    got = Windows(table, size)
    keep = _maybe_repeated(got, back, n, width)
    _, _, number, place = _candidates(got, keep)
    owned = joined(answers(back, DEPTH, n)) == 1
    chosen = np.flatnonzero(keep)
    # The least document of the block keeps its words if no other block has a smaller one.
    late = ~owned[place] | (got.number[got.doc[chosen]] > number[place]) if len(chosen) else np.zeros(0, bool)
    covered = np.zeros(len(got.words.start) + 1, np.int64)
    begins = got.at[chosen[late]]
    np.add.at(covered, begins, 1)
    np.add.at(covered, begins + size, -1)
    return got.words, np.cumsum(covered)[:-1] > 0


def _over_repeats(docs: DataFrame, key: str, text: str, size: int, work, schema: StructType) -> DataFrame:
    """`work(table, words, removed)` for every block of rows."""
    others = [c for c in docs.columns if c not in (key, text)]
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"), *others)
    blocks, n = save_blocks(rows, "key", "text", BLOCK_BYTES)
    # A byte in eight begins a window at most.
    width = max(1 << 10, CELLS_PER_WINDOW * n * (BLOCK_BYTES // 8))
    slim = blocks.select("key", "text", "block")
    up = slim.groupBy("block").applyInArrow(_sketch(size, n, width), PIECE)
    cells = save(ask(up, lambda bucket: 2, _sum_cells), "sketch")
    known = slim.groupBy("block").cogroup(cells.groupBy("block"))
    owners = save(ask(known.applyInArrow(_exact(size, n, width), PIECE), lambda bucket: 3, _least_document), "window-owners")

    def apply(table: pa.Table, back: pa.Table) -> pa.Table:
        return work(table, *removed_words(table, back, size, n, width))

    return blocks.groupBy("block").cogroup(cells.unionByName(owners).groupBy("block")).applyInArrow(apply, schema)


def kept_text(words: Words, removed: np.ndarray, doc: int) -> bytes:
    """The words of a document that stay, joined by one space."""
    a, z = words.first[doc], words.first[doc + 1]
    data = words.data
    return b" ".join([data[s:e].tobytes() for s, e, gone in zip(words.start[a:z].tolist(), words.end[a:z].tolist(), removed[a:z].tolist()) if not gone])


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """Per document: words, removed words and the text that stays.

    A document that loses nothing keeps its text as it is; in others the words that stay are joined
    by one space.
    """
    schema = StructType([docs.schema[key]])
    for field in StructType.fromDDL("n_words long, n_removed long, kept_text string, kept_sha256 string"):
        schema = schema.add(field)

    def work(table: pa.Table, words: Words, removed: np.ndarray) -> pa.Table:
        n_removed = np.diff(np.append(0, np.cumsum(removed))[words.first])
        whole = table.column("text").to_pylist()
        kept = [kept_text(words, removed, d) for d in range(table.num_rows)]
        return pa.table(
            {
                key: table.column("key").cast(pa.int64()),
                "n_words": pa.array(words.counts.astype(np.int64)),
                "n_removed": pa.array(n_removed),
                "kept_text": pa.array([k.decode() if r else t for k, r, t in zip(kept, n_removed.tolist(), whole)], pa.string()),
                "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept]),
            }
        )

    return _over_repeats(docs.select(key, text), key, text, size, work, schema)


def cut_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", chars: str = "n_chars", size: int = WINDOW) -> DataFrame:
    """`docs` with repeated passages cut out of the texts, columns as they were.

    A text that loses nothing stays as it is, one that loses all its words goes with its row; `chars`, if
    it is a column, follows the text.
    """
    schema = docs.schema
    # The row travels as one column, so no column of its own can clash with those added here.
    wrapped = docs.select(F.struct(*[docs[f"`{c}`"].alias(c) for c in docs.columns]).alias("row"), F.col(key), F.col(text).alias("text"))

    def work(table: pa.Table, words: Words, removed: np.ndarray) -> pa.Table:
        lost = np.diff(np.append(0, np.cumsum(removed))[words.first])
        keep = np.flatnonzero((lost == 0) | (lost < words.counts))
        whole = table.column("text").to_pylist()
        texts = [kept_text(words, removed, d).decode() if lost[d] else whole[d] for d in keep]
        rows = table.column("row").combine_chunks().take(pa.array(keep))
        columns = {}
        for field in schema:
            column = rows.field(field.name) if not isinstance(rows, pa.ChunkedArray) else rows.chunk(0).field(field.name)
            if field.name == text:
                column = pa.array(texts, column.type)
            elif field.name == chars:
                column = pa.array([len(t) if lost[d] else c for d, t, c in zip(keep, texts, column.to_pylist())], column.type)
            columns[field.name] = column
        return pa.table(columns)

    return _over_repeats(wrapped, key, "text", size, work, schema)

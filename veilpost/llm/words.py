"""Words of whole texts as numpy arrays, for tasks that work on Arrow batches.

A word is a maximal run of bytes other than space and \\x09-\\x0D.  Words and word windows are known
by 64-bit polynomial hashes over random byte values, taken from one running sum per batch, so there
is no Python object per word.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_MULT = {1: 0x9E3779B97F4A7C15, 2: 0xD6E8FEB86659FD93, 3: 0xA0761D6478BD642F}
_MASK = (1 << 64) - 1
_powers: dict[tuple[int, bool], np.ndarray] = {}

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Also ends a word: every ASCII sign that is no letter or digit.
IS_SIGN = IS_SPACE.copy()
IS_SIGN[[b for b in range(128) if not chr(b).isalnum()]] = True
_BYTE = np.random.Generator(np.random.PCG64(20)).integers(0, 2**64, 256, np.uint64)
_LOWER = _BYTE.copy()
_LOWER[65:91] = _BYTE[97:123]


def mix(h: np.ndarray) -> np.ndarray:
    """Finish a hash so that all its bits are good."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def _power(kind: int, inverse: bool, n: int) -> np.ndarray:
    """Powers of an odd number (or of its inverse) modulo 2^64, at least n of them."""
    have = _powers.get((kind, inverse))
    if have is None or len(have) < n:
        base = pow(_MULT[kind], -1, 1 << 64) if inverse else _MULT[kind]
        have = np.full(max(n, 1 << 16), base, np.uint64)
        have[0] = 1
        _powers[(kind, inverse)] = have = np.cumprod(have, dtype=np.uint64)
    return have[:n]


def _running(values: np.ndarray, kind: int) -> np.ndarray:
    """Running sums of values times powers, with a zero in front."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _power(kind, False, len(values)), out=out[1:])
    return out


@dataclass
class Words:
    """Words of a batch: word i is bytes start[i]:end[i], document d holds words first[d]:first[d+1]."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, lower: bool) -> np.ndarray:
        sums = _running((_LOWER if lower else _BYTE)[self.data], 1)
        raw = (sums[self.end] - sums[self.start]) * _power(1, True, len(self.data) + 1)[self.start]
        return mix(raw + (self.end - self.start).astype(np.uint64))

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def windows(hashes: np.ndarray, size: int, kind: int = 2) -> np.ndarray:
    """Hash of every run of `size` words in the batch, also of those that cross documents."""
    if len(hashes) < size:
        return np.zeros(0, np.uint64)
    sums = _running(hashes, kind)
    return mix((sums[size:] - sums[:-size]) * _power(kind, True, len(hashes) + 1)[: len(hashes) - size + 1])


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the places where rows begin; a null reads as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_string())
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    places = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if offsets else np.zeros(1, np.int64)
    if data is None or not len(places) or places[-1] == places[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[places[0] : places[-1]], places - places[0]


def split_words(column, ends_word: np.ndarray = IS_SPACE) -> Words:
    """Words of every text of a string column, cut at the bytes that `ends_word` marks."""
    data, places = text_bytes(column)
    inside = ~ends_word[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    border = places[(places > 0) & (places < len(data))]
    begins[border] = inside[border]
    ends[border - 1] = inside[border - 1]
    start = np.flatnonzero(begins)
    return Words(data, start, np.flatnonzero(ends) + 1, np.searchsorted(start, places))


def document_windows(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (index of the first word) of windows that lie in one document, and their document."""
    room = np.maximum(words.counts - size + 1, 0)
    doc = np.repeat(np.arange(len(room)), room)
    ahead = np.cumsum(room) - room
    return np.arange(len(doc)) - ahead[doc] + words.first[:-1][doc], doc


def shingle_sets(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct lower-cased shingles of every document: hashes by document, ascending, and places where documents begin.

    A document of fewer words has its whole sequence as its one shingle, one without words none.
    """
    hashes = words.hashes(lower=True)
    at, doc = document_windows(words, size)
    keys = windows(hashes, size)[at]
    short = np.flatnonzero((words.counts > 0) & (words.counts < size))
    if len(short):
        sums = _running(hashes, 3)
        raw = (sums[words.first[short + 1]] - sums[words.first[short]]) * _power(3, True, len(hashes) + 1)[words.first[short]]
        keys = np.concatenate([keys, mix(raw + words.counts[short].astype(np.uint64))])
        doc = np.concatenate([doc, short])
    order = np.lexsort((keys, doc))
    keys, doc = keys[order], doc[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])
    return keys[new], np.searchsorted(doc[new], np.arange(len(words.first)))

"""Periodic runs of words in each text: seeds on diagonals, extended once per lag.

A run is a stretch of words with smallest period q, of at least max(LEAST, TIMES * q) words, that no
neighbouring word extends.  On the diagonal of lag q it holds max(LEAST - q, (TIMES - 1) * q) equal
words in a row at least.  That overlap is the length of the seeds: lags are taken in classes q..2q-1, and
the k-grams of a class are as long as the least overlap of its lags.  Such a k-gram is no shorter
than the lag, so inside of a run it comes again after exactly one period: only pairs of neighbouring
occurrences in a document are enumerated, and a word said n times gives n - 1 pairs, not n squared.

Seeds of a lag are walked in order of place with the furthest place that is covered: a seed behind it
continues the stretch, any other one opens a new stretch.  A stretch with a smaller period has no seed at its
lag, so each run is found once.  All work is on one row; nothing is shuffled.

Defined results: words are runs of bytes other than space and \\x09-\\x0D, taken as they are; a null, empty
or white text has no words, no runs and an empty collapsed text; repeated rows get equal results;
further columns stay, but columns named as the results are replaced.  Words and k-grams are known by 64-bit
hashes.
"""

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from .words import mix, split_words, windows

#: A run has this many words, and this many periods, at least.
LEAST, TIMES = 6, 4
RUNS = ArrayType(StructType().add("start", LongType()).add("length", LongType()).add("period", LongType()))
_SLICE = 512


def seed_length(low: int, high: int, least: int, times: int) -> int:
    """What every run of a lag from `low` to `high` has in common with itself, one lag on, at least."""
    return min(max(least - q, (times - 1) * q) for q in {low, *range(low, min(high, least) + 1)})


def _neighbours(keys: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, lag) of every occurrence of a key that has a next one."""
    order = np.argsort(keys)
    same = keys[order[1:]] == keys[order[:-1]]
    often = np.zeros(len(keys), bool)
    often[order[1:][same]] = True
    often[order[:-1][same]] = True
    often = np.flatnonzero(often)
    often = often[np.lexsort((at[often], keys[often]))]
    same = keys[often[1:]] == keys[often[:-1]]
    place = at[often]
    return place[:-1][same], (place[1:] - place[:-1])[same]


def find_runs(words: np.ndarray, first: np.ndarray, least: int = LEAST, times: int = TIMES) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, length, period) of all runs, by document, start and period.

    `words` are the word hashes of a batch, document d holding words first[d]:first[d+1].
    """
    if times < 3:
        raise ValueError("runs of fewer than three periods are not found by neighbouring occurrences")
    counts = np.diff(first)
    starts, lengths, periods = ([np.zeros(0, np.int64)] for _ in range(3))
    low = 1
    while (room := counts >= max(least, times * low)).any():
        high = 2 * low - 1
        k = seed_length(low, high, least, times)
        doc = np.flatnonzero(room)
        n = counts[doc] - k + 1
        doc = np.repeat(doc, n)
        at = np.arange(len(doc)) + np.repeat(first[:-1][room] - (np.cumsum(n) - n), n)
        place, lag = _neighbours(mix(windows(words, k)[at] + mix(doc.astype(np.uint64))), at)
        near = (lag >= low) & (lag <= high)
        place, lag = place[near], lag[near]
        order = np.lexsort((place, lag))
        place, lag = place[order], lag[order]
        # The furthest covered seed of a lag is the one before; a gap or another lag opens a stretch.
        opens = np.ones(len(place), bool)
        opens[1:] = (lag[1:] != lag[:-1]) | (place[1:] != place[:-1] + 1)
        head = np.flatnonzero(opens)
        last = np.append(head[1:], len(place)) - 1 if len(head) else head
        length = place[last] + k + lag[head] - place[head]
        long = length >= np.maximum(least, times * lag[head])
        starts.append(place[head][long])
        lengths.append(length[long])
        periods.append(lag[head][long])
        low = high + 1
    start, length, period = (np.concatenate(x).astype(np.int64) for x in (starts, lengths, periods))
    order = np.lexsort((period, start))
    start, length, period = start[order], length[order], period[order]
    doc = np.searchsorted(first, start, side="right") - 1
    return doc, start - first[doc], length, period


def _collapsed(column, keep: np.ndarray, first: np.ndarray, changed: np.ndarray) -> pa.Array:
    """The kept words of every text, joined by one space."""
    out = []
    for i, text in enumerate(column.to_pylist()):
        words = (text or "").encode().split()
        if changed[i]:
            words = compress(words, keep[first[i] : first[i + 1]].tolist())
        out.append(b" ".join(words))
    return pa.array(out, pa.binary()).cast(pa.string())


def collapse_runs(
    docs: DataFrame,
    text: str = "text",
    runs: str = "runs",
    collapsed: str = "collapsed",
    least: int = LEAST,
    times: int = TIMES,
) -> DataFrame:
    """Add the runs of every text (by start, then period) and the text without the repeats.

    A word goes if a run contains it after that run's first period.
    """
    kept = [f for f in docs.schema.fields if f.name not in (runs, collapsed)]
    added = StructType([StructField(runs, RUNS), StructField(collapsed, StringType())])
    schema = StructType([*kept, StructField("__text", StringType()), *added.fields])

    def work(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, _SLICE):
                batch = whole.slice(at, _SLICE)
                texts = batch.column(batch.num_columns - 1)
                words = split_words(texts)
                doc, start, length, period = find_runs(words.hashes(lower=False), words.first, least, times)
                ends = np.zeros(len(words.start) + 1, np.int64)
                begin = words.first[doc] + start
                np.add.at(ends, begin + period, 1)
                np.add.at(ends, begin + length, -1)
                keep = np.cumsum(ends)[:-1] == 0
                changed = np.bincount(doc, minlength=batch.num_rows) > 0
                struct = pa.StructArray.from_arrays([pa.array(x) for x in (start, length, period)], ["start", "length", "period"])
                edges = np.searchsorted(doc, np.arange(batch.num_rows + 1)).astype(np.int32)
                found = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), struct)
                columns = [*batch.columns, found, _collapsed(texts, keep, words.first, changed)]
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in schema.fields])

    return docs.select(*[F.col(f.name) for f in kept], F.col(text).alias("__text")).mapInArrow(work, schema).drop("__text")


def longest(runs: Column) -> Column:
    """The run of greatest length; of equal ones that of smallest start, then of smallest period.  Null without runs."""
    first = F.array_sort(
        runs,
        lambda a, b: F.when(a["length"] != b["length"], F.sign(b["length"] - a["length"]))
        .when(a["start"] != b["start"], F.sign(a["start"] - b["start"]))
        .otherwise(F.sign(a["period"] - b["period"]))
        .cast("int"),
    )
    return F.get(first, F.lit(0))

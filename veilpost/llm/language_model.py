"""Language-model scores from a weighted backoff automaton over word n-grams.

States are contexts: the word before, the start of a text, and the empty context.  A state has one arc
for every word seen after it, weighted (1 - b) c(hw)/c(h) + b P(w), and a failure arc of weight b to the
empty context, whose arcs are P(w) = (c(w) + 1)/(N + V + 1).  The backoff weight b of a state is
that of all states visited about as often: the share of their visits left by an arc taken only once
(the leave-one-out estimate of an unseen word).  Each state's probabilities sum to one.

The automaton is as large as the corpus asks for and never lies in one place: a block of documents
asks for the counts of just the states and arcs that its texts pass, walks every text once from
left to right, and adds up log-probabilities.  Words are known by a 64-bit hash.

Defined results: a null text is an empty one (its end token only); repeated rows count each; without
training rows all words are unknown; every row gets a score.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .exchange import PIECE, answers, ask, joined, pieces, save, save_blocks
from .words import mix, split_words

_START, _END = np.uint64(0x5AD0BEEF12345671), np.uint64(0xE9D0BEEF98765433)
_BINS = 64
WORDS, PAIRS = 0, 1


class Walk:
    """Tokens of a block: the arcs that its texts take, as places in the block's ascending keys."""

    def __init__(self, table: pa.Table):
        words = split_words(table.column("text"))
        hashes = words.hashes(lower=True)
        docs = len(words.first) - 1
        self.n_tokens = words.counts + 1
        self.doc = np.repeat(np.arange(docs), self.n_tokens)
        last = np.cumsum(self.n_tokens) - 1
        token = np.empty(int(self.n_tokens.sum()), np.uint64)
        inner = np.ones(len(token), bool)
        inner[last] = False
        token[inner], token[last] = hashes, _END
        context = np.empty_like(token)
        context[1:] = token[:-1]
        context[last - self.n_tokens + 1] = _START
        train = np.asarray(table.column("train").combine_chunks().fill_null(False))
        self.learns = train[self.doc]
        self.words, self.word = np.unique(token, return_inverse=True)
        self.starts = int(train.sum())
        # The start state is visited once per text, as the end token is: they share a count.
        self.context = np.searchsorted(self.words, np.where(context == _START, _END, context))
        self.pairs, self.pair = np.unique(mix(context * np.uint64(0x9E3779B97F4A7C15) ^ mix(token)), return_inverse=True)

    def counted(self, place: np.ndarray, n: int) -> np.ndarray:
        return np.bincount(place[self.learns], minlength=n)


def _count_pieces(n: int):
    def count(table: pa.Table) -> pa.Table:
        walk = Walk(table)
        block = table.column("block")[0].as_py()
        return pa.concat_tables(
            [
                pieces(block, n, walk.words, walk.counted(walk.word, len(walk.words)), tag=WORDS),
                pieces(block, n, walk.pairs, walk.counted(walk.pair, len(walk.pairs)), tag=PAIRS),
            ]
        )

    return count


def _sum_per_key(bucket: int, columns: list[np.ndarray], piece: np.ndarray) -> np.ndarray:
    _, place = np.unique(columns[0], return_inverse=True)
    return np.bincount(place, columns[1])[place].astype(np.uint64)


def _bins(counts: np.ndarray) -> np.ndarray:
    """Two bins per doubling of the visits of a state."""
    return np.minimum((2 * np.log2(np.maximum(counts, 1))).astype(np.int64), _BINS - 1)


class Model:
    """The corpus-wide counts, by block, and the few numbers every state shares."""

    def __init__(self, docs: DataFrame, key: str, text: str, train: Column):
        rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), train.alias("train"))
        self.blocks, self.n = save_blocks(rows, "key", "text")
        n = self.n
        up = self.blocks.groupBy("block").applyInArrow(_count_pieces(n), PIECE)
        self.counts = save(ask(up, lambda bucket: 2, _sum_per_key), "ngram-counts")
        totals = self._over_blocks(self._totals(), "kind int, bin int, value double").groupBy("kind", "bin").agg(F.sum("value").alias("value")).collect()
        got = {(r.kind, r.bin): r.value for r in totals}
        self.tokens = int(round(got.get((0, 0), 0)))
        self.types = int(round(got.get((1, 0), 0)))
        once = np.array([got.get((2, b), 0.0) for b in range(_BINS)])
        visits = np.array([got.get((3, b), 0.0) for b in range(_BINS)])
        # One unseen word is added to each bin, so no state is certain.
        self.backoff = (once + 1) / (visits + 1)

    def _over_blocks(self, work, schema) -> DataFrame:
        return self.blocks.groupBy("block").cogroup(self.counts.groupBy("block")).applyInArrow(work, schema)

    def _totals(self):
        n = self.n

        def totals(table: pa.Table, back: pa.Table) -> pa.Table:
            walk = Walk(table)
            word, pair = joined(answers(back, WORDS, n)), joined(answers(back, PAIRS, n))
            learned = walk.counted(walk.word, len(walk.words))
            # Every holder of a word counts its share of it, so the shares of one word add up to one.
            types = np.divide(learned, word, out=np.zeros(len(word)), where=word > 0).sum()
            bins = _bins(word[walk.context[walk.learns]])
            visits = np.bincount(bins, minlength=_BINS)
            once = np.bincount(bins, pair[walk.pair[walk.learns]] == 1, minlength=_BINS)
            kinds = [0, 1] + [2] * _BINS + [3] * _BINS
            values = [float(walk.learns.sum()), float(types), *once.tolist(), *visits.astype(float).tolist()]
            return pa.table({"kind": pa.array(kinds, pa.int32()), "bin": pa.array([0, 0, *range(_BINS), *range(_BINS)], pa.int32()), "value": pa.array(values)})

        return totals

    def score(self) -> DataFrame:
        """(key, n_tokens, n_known, base_score, score) of every document."""
        n, backoff, tokens, types = self.n, self.backoff, self.tokens, self.types
        schema = StructType([self.blocks.schema["key"]])
        for field in StructType.fromDDL("train boolean, n_tokens long, n_known long, base_score double, score double"):
            schema = schema.add(field)

        def score(table: pa.Table, back: pa.Table) -> pa.Table:
            walk = Walk(table)
            word = joined(answers(back, WORDS, n)).astype(np.float64)
            pair = joined(answers(back, PAIRS, n)).astype(np.float64)
            lowest = (word + 1) / (tokens + types + 1)
            visits = word[walk.context]
            fail = np.where(visits > 0, backoff[_bins(visits)], 1.0)
            seen = pair[walk.pair] / np.maximum(visits, 1)
            p = (1 - fail) * seen + fail * lowest[walk.word]
            docs = table.num_rows
            add = lambda x: np.bincount(walk.doc, x, minlength=docs)
            return pa.table(
                {
                    "key": table.column("key"),
                    "train": table.column("train"),
                    "n_tokens": pa.array(walk.n_tokens.astype(np.int64)),
                    "n_known": pa.array(add(word[walk.word] > 0).astype(np.int64)),
                    "base_score": pa.array(add(np.log10(lowest[walk.word]))),
                    "score": pa.array(add(np.log10(p))),
                }
            )

        return self._over_blocks(score, schema)


def score_documents(docs: DataFrame, train: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Learn from the rows where `train` holds, score all rows."""
    model = Model(docs, key, text, train)
    return model.score().select(
        F.col("key").alias(key),
        F.col("train"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )

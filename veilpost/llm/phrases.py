"""Phrase collocations: depth-truncated suffix subtrees, built apart per group of word prefixes.

Every word of a text begins a suffix, cut after `depth` words or at the end of its piece.  Prefixes are counted
level by level, by 64-bit hash: one of d words is counted only if its own first and last d - 1 words occur `least`
times.  The prefixes that occur so often are known to all tasks by a bit map of fixed size per level, which may let too
much through but keeps nothing out.  A suffix cut to its longest such prefix is a leaf.  Tasks count equal leaves before
anything is shuffled, and each leaf goes on once, with its total.

Leaves are dealt by prefix (vertical partitioning): a first word of at most BUDGET leaf rows is a prefix of its own, a
more frequent one is split by its second word, and so on down to whole leaves, which are one row each.  Prefixes are dealt to groups by hash, with some BUDGET rows a group.  Each group sorts its leaves, which
is its subtree in order, and reads every node's count from the leaves below it.  Only nodes above a split
prefix are added up over groups.

Candidates look up the counts of their parts by equi-join; all numbers are whole, products are decimals
of 38 digits.

Defined results: A-Z is lower-cased; pieces end at `.,;:!?` and \\x0A-\\x0D, words at space and tab; a null or
empty text has no words; a null language is `und`; repeated rows count as often as they are there; an
empty table has no phrases.  Only the two named columns are read.  Words are compared by 64-bit hashes inside of
a group.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .bitmaps import bit_map, marked
from .exchange import save
from .words import Words, mix, split_words

#: Leaf rows of a group, and how many groups there are at most; beyond, groups grow.
BUDGET, MAX_GROUPS = 400_000, 20_000
_SLICE = 512
#: Distinct leaves that a task holds before it gives them out.
_HELD = 100_000
_CUTS = np.zeros(256, bool)
_CUTS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_ENDS = _CUTS.copy()
_ENDS[[0x20, 0x09]] = True
_BLANK = np.zeros(256, bool)
_BLANK[0x20] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _names(column) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct languages of a column, and which of them each row has."""
    coded = column.dictionary_encode()
    words = split_words(pa.array(["=" + name for name in coded.dictionary.to_pylist()]), np.zeros(256, bool))
    return words.hashes(lower=False), np.asarray(coded.indices)


def _ahead(words: Words) -> np.ndarray:
    """How many words its piece has from every word on, itself included."""
    cuts = np.append(0, np.cumsum(_CUTS[words.data]))[words.start]
    doc = words.doc_of_word()
    new = np.ones(len(cuts), bool)
    new[1:] = (cuts[1:] != cuts[:-1]) | (doc[1:] != doc[:-1])
    ends = np.append(np.flatnonzero(new), len(cuts))
    return np.repeat(ends[1:], np.diff(ends)) - np.arange(len(cuts))


def _leaf_keys(words: Words, lang: np.ndarray, maps: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(length, key) of the leaf at every word, cut to `depth` words and to what the maps let through.

    A level without a map lets all through whose two parts may go on.  The key of a phrase is the same in every pass.
    """
    hashes, ahead = words.hashes(lower=True), _ahead(words)
    key = mix(hashes + lang)
    length, best = np.minimum(ahead, 1), key
    for d in range(2, depth + 1):
        fine = np.append(marked(maps[d - 2], key), False) if len(maps) > d - 2 else np.ones(len(key) + 1, bool)
        longer = (length == d - 1) & (ahead >= d) & fine[:-1] & fine[1:]
        at = np.flatnonzero(longer)
        grown = np.zeros(len(key), np.uint64)
        grown[at] = mix(key[at] * np.uint64(0x9E3779B97F4A7C15) + hashes[at + d - 1])
        if len(maps) >= d:
            longer &= marked(maps[d - 1], grown)
        key = grown
        best = np.where(longer, grown, best)
        length = np.where(longer, d, length)
    return length, best


def _texts(words: Words, at: np.ndarray, ahead: np.ndarray) -> pa.Array:
    """The leaves at `at` as texts, their words lower-cased and joined by one space."""
    n = ahead[at]
    ends = np.cumsum(n)
    word = np.arange(ends[-1] if len(ends) else 0) + np.repeat(at - ends + n, n)
    size = words.end[word] - words.start[word] + 1
    stop = np.cumsum(size)
    place = np.arange(stop[-1] if len(stop) else 0) + np.repeat(words.start[word] - stop + size, size)
    data = _LOWER[words.data[np.minimum(place, len(words.data) - 1)]]
    data[stop - 1] = 0x20
    # The blank after a leaf's last word goes.
    stays = np.ones(len(data), bool)
    stays[stop[ends - 1] - 1] = False
    offsets = np.append(0, stop[ends - 1] - np.arange(1, len(ends) + 1)).astype(np.int32)
    return pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(data[stays]))


def _counted(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of one entry of every key, and the total of its entries."""
    order = np.argsort(keys, kind="stable")
    new = np.ones(len(keys), bool)
    new[1:] = keys[order[1:]] != keys[order[:-1]]
    head = np.flatnonzero(new)
    return order[head], np.add.reduceat(n[order], head) if len(head) else n[:0]


def counted_leaves(docs: DataFrame, text: str, lang: str, maps: list[np.ndarray], depth: int, texts: bool) -> DataFrame:
    """(lang, leaf, key, n) of leaves as long as maps and depth allow, counted within tasks.

    With one word all leaves are given, else those of two words or more.  Without `texts`, only full-length leaves are given, as
    (key, n).
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(maps)

    def merged(parts):
        keys = np.concatenate([p[0] for p in parts])
        at, n = _counted(keys, np.concatenate([p[1] for p in parts]))
        rows = pa.concat_tables([p[2] for p in parts]).combine_chunks().take(pa.array(at)) if texts else None
        return keys[at], n, rows

    def batch_of(part):
        key, n = pa.array(part[0].view(np.int64)), pa.array(part[1], pa.int64())
        table = part[2].append_column("key", key).append_column("n", n) if texts else pa.table({"key": key, "n": n})
        return table.combine_chunks().to_batches(50_000)

    def work(batches):
        maps, parts, held = shared.value, [], 0
        for whole in batches:
            for begin in range(0, whole.num_rows, _SLICE):
                batch = whole.slice(begin, _SLICE)
                words = split_words(batch.column("text"), _ENDS)
                if not len(words.start):
                    continue
                names, of_doc = _names(batch.column("lang"))
                doc = words.doc_of_word()
                length, keys = _leaf_keys(words, names[of_doc[doc]], maps, depth)
                given = np.flatnonzero(length >= (min(depth, 2) if texts else depth))
                at, n = _counted(keys[given], np.ones(len(given), np.int64))
                at = given[at]
                rows = pa.table({"lang": batch.column("lang").take(pa.array(doc[at])), "leaf": _texts(words, at, length)}) if texts else None
                parts.append((keys[at], n, rows))
                held += len(at)
                if held > 2 * _HELD:
                    parts = [merged(parts)]
                    held = len(parts[0][0])
                    if held > _HELD:
                        yield from batch_of(parts[0])
                        parts, held = [], 0
        if parts:
            yield from batch_of(merged(parts))

    named = F.coalesce(F.col(lang).cast("string"), F.lit("und"))
    schema = "lang string, leaf string, key long, n long" if texts else "key long, n long"
    return docs.select(named.alias("lang"), F.col(text).alias("text")).mapInArrow(work, schema)


def _prefix(depth: int | Column) -> Column:
    return F.substring_index("leaf", " ", depth) if isinstance(depth, int) else F.expr("substring_index(leaf, ' ', depth)")


def grouped(rows: DataFrame, depth: int, budget: int = BUDGET) -> tuple[DataFrame, int]:
    """The leaves with `depth` of the prefix they are dealt by and their `group`; and how many groups there are."""
    total = rows.count()
    budget = max(budget, -(-total // MAX_GROUPS))
    groups = -(-2 * total // budget) or 1
    dealt = rows.withColumn("depth", F.lit(1))
    for d in range(1, depth):
        # No more than total / budget prefixes are heavier than the budget.
        heavy = (
            rows.groupBy("lang", _prefix(d).alias("prefix")).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > budget)
            .select(F.col("lang").alias("__lang"), F.col("prefix").alias("__prefix"), F.lit(1).alias("__more"))
        )
        heavy = F.broadcast(save(heavy, "heavy-prefixes"))
        met = (F.col("lang") == F.col("__lang")) & (_prefix(d) == F.col("__prefix"))
        dealt = dealt.join(heavy, met, "left").withColumn("depth", F.col("depth") + F.coalesce("__more", F.lit(0)))
        dealt = dealt.drop("__lang", "__prefix", "__more")
    group = F.pmod(F.xxhash64("lang", _prefix(F.col("depth"))), F.lit(groups)).cast("int")
    return dealt.withColumn("group", group), groups


def subtree_nodes(table: pa.Table, depth: int, least: int) -> pa.Table:
    """(lang, phrase, words, n) of the nodes of one group's subtree.

    Nodes above the prefix a leaf was dealt by are partial and all given out; others only from `least` on.
    """
    leaf = table.column("leaf").combine_chunks()
    words = split_words(leaf, _BLANK)
    hashes, counts = words.hashes(lower=False), words.counts
    path = np.zeros((depth, len(counts)), np.uint64)
    for d in range(depth):
        has = counts > d
        path[d, has] = hashes[words.first[:-1][has] + d]
    named = table.column("lang").combine_chunks().dictionary_encode()
    lang = np.asarray(named.indices)
    n, dealt = np.asarray(table.column("n")), np.asarray(table.column("depth"))
    order = np.lexsort((*path[::-1], lang))
    path, lang, n, dealt, counts = path[:, order], lang[order], n[order], dealt[order], counts[order]
    out = []
    new = np.ones(len(order), bool)
    new[1:] = lang[1:] != lang[:-1]
    for d in range(depth):
        new[1:] |= path[d, 1:] != path[d, :-1]
        head = np.flatnonzero(new)
        total = np.add.reduceat(n, head) if len(head) else n[:0]
        given = (counts[head] > d) & ((total >= least) | (dealt[head] > d + 1))
        row = order[head[given]]
        last = words.end[words.first[row] + d]
        phrase = leaf.take(pa.array(row)).cast(pa.binary()).to_pylist()
        begin = words.start[words.first[row]]
        cut = pa.array([p[:z] for p, z in zip(phrase, (last - begin).tolist())], pa.binary()).cast(pa.string())
        columns = [table.column("lang").combine_chunks().take(pa.array(row)), cut, pa.array(np.full(len(row), d + 1, np.int32)), pa.array(total[given])]
        out.append(pa.table(columns, names=["lang", "phrase", "words", "n"]))
    return pa.concat_tables(out)


def count_phrases(docs: DataFrame, depth: int, least: int, text: str = "text", lang: str = "lang", budget: int = BUDGET) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, f) of all phrases of up to `depth` words that occur `least` times; and (lang, n), all words."""
    words = counted_leaves(docs, text, lang, [], 1, True).groupBy("lang", "leaf", "key").agg(F.sum("n").alias("n"))
    words = save(words, "words")
    often = words.where(F.col("n") >= least)
    maps = [bit_map(often.select("key"))]
    for d in range(2, depth + 1):
        counted = counted_leaves(docs, text, lang, maps, d, False).groupBy("key").agg(F.sum("n").alias("n"))
        maps.append(bit_map(counted.where(F.col("n") >= least)))
    leaves = counted_leaves(docs, text, lang, maps, depth, True).groupBy("lang", "leaf").agg(F.sum("n").alias("n"))
    rows = save(leaves, "leaves")
    dealt, groups = grouped(rows, depth, budget)
    nodes = (
        dealt.repartition(groups, "group").groupBy("group")
        .applyInArrow(lambda table: subtree_nodes(table, depth, least), "lang string, phrase string, words int, n long")
        .where("words > 1").groupBy("lang", "phrase", "words").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    )
    # Leaves cut down to their first word are not given out, so words have their counts from the first level.
    single = often.select("lang", F.col("leaf").alias("phrase"), F.lit(1).alias("words"), F.col("n").alias("f"))
    return save(nodes.unionByName(single), "phrases"), words.groupBy("lang").agg(F.sum("n").alias("n"))


def _part(begin: Column, size: Column) -> Column:
    return F.array_join(F.slice("__words", begin, size), " ")


def mine(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    min_words: int = 2,
    max_words: int = 3,
    least: int = 10,
    covered_percent: int = 50,
    top: int = 2_000,
    budget: int = BUDGET,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the `top` phrases of every language by cohesion.

    A phrase is cut where floor(10^6 a^2 / (l r)) is least; it goes if a longer phrase around it has at
    least `covered_percent` of its count.
    """
    phrases, totals = count_phrases(docs, max_words, least, text, lang, budget)
    found = phrases.where(F.col("words") >= min_words).select("lang", "phrase", "words", F.col("f").alias("a"), F.split("phrase", " ").alias("__words"))
    cuts = found.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", _part(F.lit(1), F.col("k")).alias("first"), _part(F.col("k") + 1, F.col("words") - F.col("k")).alias("rest"))
    counts = phrases.select("lang", "phrase", "f")
    for part, name in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(counts.select("lang", F.col("phrase").alias(part), F.col("f").alias(name)), ["lang", part])
    # Below 10^16 occurrences no product passes 38 digits.
    wide = {c: F.col(c).cast("decimal(16,0)") for c in "alr"}
    cuts = cuts.withColumn("__up", F.lit(1_000_000).cast("decimal(7,0)") * (wide["a"] * wide["a"])).withColumn("__down", wide["l"] * wide["r"])
    cuts = cuts.withColumn("score", F.expr("__up div __down"))
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    size = F.explode(F.sequence(F.lit(min_words), F.col("words") - 1))
    inside = found.where(F.col("words") > min_words).withColumn("__size", size)
    inside = inside.withColumn("__at", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("__size") + 1)))
    around = inside.select("lang", _part(F.col("__at"), F.col("__size")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    free = scored.join(around, ["lang", "phrase"], "left").where(~F.coalesce(100 * F.col("longer") >= covered_percent * F.col("a"), F.lit(False)))

    best = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = free.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a",
        F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"),
    )

"""Size-aware join of documents by the Jaccard likeness of their word n-grams.

Documents with one and the same set form a class, and only its least document goes on.  Small sets and
large ones are joined differently; the boundary is the size at which the rows of both ways together are
fewest, by the sizes that occur.

Small sets: two sets of a and b members link if they share c(a, b) = ceil(P (a + b) / (100 + P)) of them, P
being the percentage.  Every small set enumerates its subsets of each size c that a partner can ask for.
In the bucket of one subset of c members just those sets link whose sizes sum up to no more than
(100 + P) c / P, so the bucket's set of least size links with every set that has a link there: a star holds all
links together, and nothing is left to confirm.

Large sets scan inverted lists.  Members are in one order everywhere, those that batches of documents meet
often last, and a pair that links shares one among the first (100 - P) % of either set, so only those are listed.
A list is scanned in three steps, none of which pairs all its documents:
1. every document meets the least one of the list (the hub) and follows the least hub it links with;
2. followers of one leader are one group; leaders of different components that share a list meet.  Jaccard distance is
   a metric, so groups farther apart than the radii of both and the limit allow hold no link;
3. members of what is left meet the other leader, and those near enough to it for a link meet each other.
In 2 and 3 pairs of long lists are compared inside of tasks by sketches of 1,024 parity bits first, which give a bound on
what two sets share; only pairs that may link leave the task.  Links are confirmed on full sets.  How often members are met decides about the order, never about links.

Defined results: words are lower-cased (A-Z) runs of bytes other than space and \\x09-\\x0D; a text without
words is linked with nothing; rows with one number, or without one, are one document; a null number stands after all
others and never is a component; an empty table gives an empty result.  Only the two named columns are read.  Members of sets
are known by 64-bit hashes, sets by 128 bits.
"""

import uuid
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilpost.session import fresh_dir

from .bitmaps import bit_map, marked
from .components import components
from .exchange import BLOCK_BYTES, MAX_BUCKETS, save
from .words import mix, shingle_sets, split_words

SHINGLE, PERCENT = 4, 85
#: Sizes up to which enumerating subsets is considered at all.
MOST_SMALL = 26
#: What a list entry costs, counted in enumerated subsets: it is shuffled twice and may be confirmed.
ENTRY_COST = 4
#: An n-gram is reported as frequent if a batch holds it in so many documents; so many are put last.
OFTEN, MAX_OFTEN = 3, 1 << 20
#: Leaders of a list that are joined without sketches; bits of a sketch; leaders of a list that meet in one task.
FEW, SKETCH, CHUNK = 16, 1024, 2048
_PAIRS = 1 << 16
_LAST = 2**63 - 1
_SLICE = 512
_NEAR = 1e-9


def needed(a: int, b: int, percent: int) -> int:
    """Members that sets of a and b members share at least if they link."""
    return -(-percent * (a + b) // (100 + percent))


def subset_sizes(n: int, percent: int) -> range:
    """Sizes of the subsets that a set of n members shares with partners of any size."""
    return range(needed(n, -(-percent * n // 100), percent), min(n, needed(n, 100 * n // percent, percent)) + 1)


def prefix_length(n, percent: int):
    return n - -(-percent * n // 100) + 1


def boundary(sizes: dict[int, int], percent: int) -> int:
    """The size up to which enumerating is cheaper: least rows over all sizes that occur."""

    def cost(most: int) -> int:
        subsets = sum(count * sum(comb(n, c) for c in subset_sizes(n, percent)) for n, count in sizes.items() if 0 < n <= most)
        listed = sum(count * prefix_length(n, percent) for n, count in sizes.items() if n >= least_listed(most, percent))
        return subsets + ENTRY_COST * listed

    return min(range(1, MOST_SMALL + 1), key=cost)


def least_listed(most_small: int, percent: int) -> int:
    """Least size of a partner of a large set."""
    return -(-percent * (most_small + 1) // 100)


def _number(key: str) -> Column:
    return F.coalesce(F.col(key).cast("long"), F.lit(_LAST))


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _set_sums(keys: np.ndarray, first: np.ndarray, salt: int) -> np.ndarray:
    sums = np.zeros(len(keys) + 1, np.uint64)
    np.cumsum(mix(keys ^ np.uint64(salt)), out=sums[1:])
    return sums[first[1:]] - sums[first[:-1]]


_SALTS = 0x1234567, 0x7654321


def sketches(keys: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A row of SKETCH bits per set: bit i says whether an odd number of members falls there.

    Two sets differ in at least as many members as their sketches differ in bits.
    """
    n = len(first) - 1
    cell = np.repeat(np.arange(n) * SKETCH, np.diff(first)) + (mix(keys) >> np.uint64(64 - SKETCH.bit_length() + 1)).astype(np.int64)
    odd = (np.bincount(cell, minlength=n * SKETCH) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(n, SKETCH), axis=1).view(np.uint64)


def frequent(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys that come OFTEN times at least, and how often; `keys` is sorted in place, and nothing else of its size is made but flags."""
    keys.sort()
    often = keys[OFTEN - 1 :] == keys[: len(keys) - OFTEN + 1] if len(keys) >= OFTEN else np.zeros(0, bool)
    # Of all places from which on a key comes OFTEN times, the first one.
    often[1:] &= keys[1 : len(often)] != keys[: max(0, len(often) - 1)]
    first = np.flatnonzero(often)
    return keys[first], np.searchsorted(keys, keys[first], side="right") - first


def survey(docs: DataFrame, text: str, shingle: int) -> tuple[np.ndarray, np.ndarray, dict[int, int]]:
    """Frequent n-grams (ascending) with their counts, and how many documents have each small size.

    The driver gets MAX_OFTEN numbers at most.
    """

    def count(batches):
        for whole in batches:
            parts, sizes = [np.zeros(0, np.uint64)], np.zeros(2 * MOST_SMALL + 1, np.int64)
            for at in range(0, whole.num_rows, _SLICE):
                keys, first = shingle_sets(split_words(whole.slice(at, _SLICE).column(0)), shingle)
                parts.append(keys)
                n = np.diff(first)
                sizes += np.bincount(n[n < len(sizes)], minlength=len(sizes))
            keys = np.concatenate(parts)
            parts.clear()
            value, n = frequent(keys)
            some = np.flatnonzero(sizes)
            what = np.concatenate([np.zeros(len(value), bool), np.ones(len(some), bool)])
            columns = [pa.array(what), pa.array(np.concatenate([value.view(np.int64), some])), pa.array(np.concatenate([n, sizes[some]]))]
            yield pa.RecordBatch.from_arrays(columns, ["size", "value", "n"])

    counted = save(docs.select(text).mapInArrow(count, "size boolean, value long, n long").groupBy("size", "value").agg(F.sum("n").alias("n")), "survey")
    sizes = {r["value"]: r["n"] for r in counted.where("size").collect()}
    often = counted.where("NOT size").orderBy(F.desc("n"), "value").limit(MAX_OFTEN).select("value", "n").toArrow()
    value, n = (np.array(often.column(c)) for c in ("value", "n"))
    value = value.astype(np.int64).view(np.uint64)
    order = np.argsort(value)
    return value[order], n.astype(np.int64)[order], sizes


def describe(docs: DataFrame, key: str, text: str, shingle: int, percent: int, most_small: int, often: np.ndarray, counts: np.ndarray) -> DataFrame:
    """(doc, n, s1, s2, members, prefix, sketch) of every row: its size, its set's hashes, a small set's members, a listed set's
    prefix and sketch."""
    known = docs.sparkSession.sparkContext.broadcast((often, counts))
    least = least_listed(most_small, percent)
    schema = "doc long, n long, s1 long, s2 long, members binary, prefix binary, sketch binary"

    def work(batches):
        often, counts = known.value
        for whole in batches:
            for at in range(0, whole.num_rows, _SLICE):
                batch = whole.slice(at, _SLICE)
                keys, first = shingle_sets(split_words(batch.column("text")), shingle)
                size = np.diff(first)
                s1, s2 = (_signed(mix(_set_sums(keys, first, salt))) for salt in _SALTS)
                members = [keys[a:z].tobytes() if z - a <= most_small else None for a, z in zip(first[:-1], first[1:])]
                sketch = sketches(keys, first)
                if len(often):
                    place = np.minimum(np.searchsorted(often, keys), len(often) - 1)
                    met = np.where(often[place] == keys, counts[place], 0)
                    order = np.lexsort((keys, met, np.repeat(np.arange(len(size)), size)))
                    keys = keys[order]
                ends = first[:-1] + prefix_length(size, percent)
                prefix = [keys[a:z].tobytes() if n >= least else None for a, z, n in zip(first[:-1], ends, size)]
                sketch = [row.tobytes() if n >= least else None for row, n in zip(sketch, size)]
                columns = [batch.column("doc"), pa.array(size.astype(np.int64)), s1, s2, *(pa.array(c, pa.binary()) for c in (members, prefix, sketch))]
                yield pa.RecordBatch.from_arrays(columns, ["doc", "n", "s1", "s2", "members", "prefix", "sketch"])

    return docs.select(_number(key).alias("doc"), F.col(text).alias("text")).mapInArrow(work, schema)


def subsets(classes: DataFrame, percent: int) -> DataFrame:
    """(c, h1, h2, doc, n): every subset of c members, by 128 bits of hash, that a small set may share with a partner."""

    def work(batches):
        for batch in batches:
            doc, n = np.asarray(batch.column("doc")), np.asarray(batch.column("n"))
            members = batch.column("members").to_pylist()
            for size in np.unique(n).tolist():
                at = np.flatnonzero(n == size)
                keys = np.frombuffer(b"".join(members[i] for i in at), np.uint64).reshape(len(at), size)
                each = [mix(keys ^ np.uint64(salt)) for salt in _SALTS]
                for c in subset_sizes(size, percent):
                    for gone in combinations(range(size), size - c):
                        hashes = [_signed(mix(h.sum(axis=1) - h[:, list(gone)].sum(axis=1))) for h in each]
                        columns = [pa.array(np.full(len(at), c, np.int32)), *hashes, pa.array(doc[at]), pa.array(n[at])]
                        yield pa.RecordBatch.from_arrays(columns, ["c", "h1", "h2", "doc", "n"])

    return classes.where("members is not null").select("doc", "n", "members").mapInArrow(work, "c int, h1 long, h2 long, doc long, n long")


def small_links(classes: DataFrame, percent: int) -> DataFrame:
    """(a, b): stars that hold together all links between small sets."""
    rows = subsets(classes, percent)
    hubs = rows.groupBy("c", "h1", "h2").agg(F.min(F.struct("n", "doc")).alias("hub"), F.count(F.lit(1)).alias("held")).where("held > 1")
    met = rows.join(hubs.drop("held"), ["c", "h1", "h2"]).where(f"doc <> hub.doc AND {percent} * (n + hub.n) <= {100 + percent} * c")
    return met.select(F.col("hub.doc").alias("a"), F.col("doc").alias("b")).distinct()


def entries(classes: DataFrame) -> DataFrame:
    """(gram, doc, n, left): the listed members of every set, and how many members it has from there on."""

    def work(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, _SLICE):
                batch = whole.slice(at, _SLICE)
                prefix = batch.column("prefix").to_pylist()
                length = np.array([len(p) // 8 for p in prefix], np.int64)
                keys = np.frombuffer(b"".join(prefix), np.int64)
                row = np.repeat(np.arange(len(length)), length)
                n = np.asarray(batch.column("n"))[row]
                left = n - (np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length))
                columns = [pa.array(keys), batch.column("doc").take(pa.array(row)), pa.array(n.astype(np.int32)), pa.array(left.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["gram", "doc", "n", "left"])

    return classes.where("prefix is not null").select("doc", "n", "prefix").mapInArrow(work, "gram long, doc long, n int, left int")


def likeness(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(a, b, distance, linked) of pairs, on full sets; `texts` is (doc, members).

    Sets are compared row by row where the join holds them: two sets a row are too much for batches of rows.
    """
    its = texts.select(F.col("doc").alias("b"), F.col("members").alias("set_b"))
    both = pairs.join(its, "b").join(texts.select(F.col("doc").alias("a"), F.col("members").alias("set_a")), "a")
    sizes = both.select("a", "b", F.size(F.array_intersect("set_a", "set_b")).cast("long").alias("shared"), (F.size("set_a") + F.size("set_b")).alias("total"))
    union = F.col("total") - F.col("shared")
    checked = sizes.select("a", "b", (F.lit(1.0) - F.col("shared") / union).alias("distance"), (100 * F.col("shared") >= percent * union).alias("linked"))
    # A number with several sets is as near as the nearest of them.
    return checked.groupBy("a", "b").agg(F.min("distance").alias("distance"), F.max("linked").alias("linked"))


def sets_of(docs: DataFrame, ids: DataFrame, key: str, text: str, shingle: int, members_in_all: int) -> DataFrame:
    """(doc, members): the full sets of the documents named, as lists of numbers, and of some more.

    Documents are told by a bit map of fixed size where their texts lie, so no text is shuffled.  Sets are shuffled once, into buckets
    by document, and every later join finds them there; `members_in_all` decides how many buckets there are.
    """
    spark = docs.sparkSession
    wanted = spark.sparkContext.broadcast(bit_map(ids.distinct().select(F.xxhash64("doc").alias("key"))))

    def work(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, _SLICE):
                batch = whole.slice(at, _SLICE)
                keep = pa.array(np.flatnonzero(marked(wanted.value, np.asarray(batch.column("key")).view(np.uint64))))
                keys, first = shingle_sets(split_words(batch.column("text").take(keep)), shingle)
                members = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), _signed(keys))
                yield pa.RecordBatch.from_arrays([batch.column("doc").take(keep), members], ["doc", "members"])

    rows = docs.select(_number(key).alias("doc"), F.col(text).alias("text")).withColumn("key", F.xxhash64("doc"))
    sets = rows.mapInArrow(work, "doc long, members array<long>").where(F.size("members") > 0)
    buckets = min(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8 * members_in_all // BLOCK_BYTES + 1), MAX_BUCKETS)
    name = f"sets_{uuid.uuid4().hex}"
    options = {"compression": "none", "path": fresh_dir(spark, "sets")}
    sets.repartition(buckets, "doc").write.format("parquet").options(**options).bucketBy(buckets, "doc").saveAsTable(name)
    return spark.table(name)


def _may_link(x: str, y: str, percent: int) -> str:
    """Condition on the sizes and on what is left from the shared member on, the first that both sets share."""
    return f"{100 + percent} * least({x}left, {y}left) >= {percent} * ({x}n + {y}n)"


def _pairs_of(last: np.ndarray):
    """(i, j) of all rows i < j up to last[i], some at a time."""
    n = last - np.arange(len(last))
    ends = np.cumsum(n)
    begin = 0
    while begin < len(n):
        end = max(begin + 1, int(np.searchsorted(ends, ends[begin] - n[begin] + _PAIRS, side="right")))
        i = np.repeat(np.arange(begin, end), n[begin:end])
        yield i, i + 1 + np.arange(len(i)) - np.repeat(ends[begin:end] - n[begin:end] - (ends[begin] - n[begin]), n[begin:end])
        begin = end


def near_in_lists(groups: DataFrame, drawn: DataFrame, percent: int) -> DataFrame:
    """(a, b): leaders that share a list, are of different components, and may have members that link.

    `groups` is (gram, leader, component, n, left, radius), `drawn` (leader, own, sketch).  Leaders of lists of up to FEW are joined, as
    far as sizes and places allow.  In longer lists sketches are compared too, and what they rule out is never given out.
    """
    held = groups.groupBy("gram").agg(F.count(F.lit(1)).alias("held"), F.min("component").alias("low"), F.max("component").alias("high"))
    held = save(held.where("low < high").select("gram", "held"), "held")
    few = groups.join(held.where(f"held <= {FEW}").select("gram"), "gram").drop("radius")
    one, other = few.alias("x"), few.alias("y")
    met = one.join(other, F.col("x.gram") == F.col("y.gram")).where("x.leader < y.leader AND x.component <> y.component AND " + _may_link("x.", "y.", percent))
    met = met.select(F.col("x.leader").alias("a"), F.col("y.leader").alias("b"))
    many = save(groups.join(held.where(f"held > {FEW}"), "gram"), "long-lists")
    if many.isEmpty():
        return met.distinct()
    return met.union(_near_by_sketch(many.join(drawn, "leader"), percent)).distinct()


def _near_by_sketch(groups: DataFrame, percent: int) -> DataFrame:
    """Pairs of leaders of long lists.  One of more than CHUNK is cut into chunks, each pair of which meets in a task of its own."""
    chunks = F.ceil(F.col("held") / CHUNK).cast("int")
    dealt = groups.withColumn("chunks", chunks).drop("held").withColumn("part", F.pmod(F.xxhash64("leader"), "chunks").cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    dealt = dealt.withColumn("first", F.least("part", "other")).withColumn("second", F.greatest("part", "other")).drop("other", "chunks")
    key = ["gram", "first", "second"]
    limit = 1 - percent / 100 + _NEAR

    def meet(table: pa.Table):
        names = ("leader", "component", "n", "left", "own", "radius", "part", *key)
        leader, component, n, left, own, radius, part, gram, one, two = (np.asarray(table.column(c)) for c in names)
        sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint64).reshape(len(n), -1)
        new = np.ones(len(n), bool)
        new[1:] = (gram[1:] != gram[:-1]) | (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        edge = np.append(np.flatnonzero(new), len(n))
        last = np.repeat(edge[1:], np.diff(edge)) - 1
        for i, j in _pairs_of(last):
            fine = (component[i] != component[j]) & (leader[i] != leader[j]) & ((one[i] == two[i]) | (part[i] != part[j]))
            fine &= (100 + percent) * np.minimum(left[i], left[j]) >= percent * (n[i] + n[j])
            i, j = i[fine], j[fine]
            # What the leaders share at most, and what they share at least if members of theirs link.
            differ = np.bitwise_count(sketch[i] ^ sketch[j]).sum(axis=1, dtype=np.int64)
            both = own[i] + own[j]
            like = np.maximum(0.0, 1 - limit - radius[i] - radius[j])
            fine = (both - differ) / 2 >= like / (1 + like) * both - 1e-6
            i, j = i[fine], j[fine]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(leader[i], leader[j])), pa.array(np.maximum(leader[i], leader[j]))], ["a", "b"])

    def work(batches):
        # Rows come by list; the last list of a batch may go on in the next one.
        kept = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([kept, table]) if kept is not None else table
            if not table.num_rows:
                continue
            ids = [np.asarray(table.column(c)) for c in key]
            other = np.zeros(table.num_rows, bool)
            for c in ids:
                other |= c != c[-1]
            whole = int(np.flatnonzero(other)[-1]) + 1 if other.any() else 0
            kept = table.slice(whole)
            if whole:
                yield from meet(table.slice(0, whole))
        if kept is not None and kept.num_rows:
            yield from meet(kept)

    return dealt.repartition(*key).sortWithinPartitions(*key).mapInArrow(work, "a long, b long")


def large_links(classes: DataFrame, docs: DataFrame, key: str, text: str, shingle: int, percent: int, known: DataFrame) -> DataFrame:
    """(a, b): links that hold together, with those `known`, all links of which one set is large."""
    limit = 1 - percent / 100 + _NEAR
    rows = entries(classes)
    hubs = rows.groupBy("gram").agg(
        F.min(F.struct("doc", "n", "left")).alias("hub"), F.count(F.lit(1)).alias("held"), F.min("n").alias("least_n"), F.max("left").alias("most_left")
    ).where("held > 1")
    listed = save(rows.join(hubs, "gram"), "lists")
    first = listed.where("doc <> hub.doc AND " + _may_link("", "hub.", percent)).select(F.col("hub.doc").alias("a"), F.col("doc").alias("b")).distinct()

    # 1. Stars.  A number with several sets neither leads nor follows, as its distances are no metric.
    first = save(first, "first-pairs")
    # A list of two has no other pair than this one; in longer ones the least size and the most that is left tell who has none.
    rest = listed.where(f"held > 2 AND {100 + percent} * least(left, most_left) >= {percent} * (n + least_n)").select("doc")
    sets = sets_of(docs, first.select(F.col("a").alias("doc")).union(first.select("b")).union(rest), key, text, shingle, classes.agg(F.sum("n")).first()[0] or 0)
    met = save(likeness(first, sets, shingle, percent), "first-met")
    several = classes.groupBy("doc").agg(F.count(F.lit(1)).alias("held")).where("held > 1").select("doc")
    single = met.where("linked").join(several.withColumnRenamed("doc", "a"), "a", "left_anti").join(several.withColumnRenamed("doc", "b"), "b", "left_anti")
    follow = single.groupBy("b").agg(F.min(F.struct("a", "distance")).alias("to")).select(F.col("b").alias("doc"), F.col("to.a").alias("leader"), F.col("to.distance").alias("away"))
    links = met.where("linked").select("a", "b").union(known)
    found = components(links)

    # 2. Leaders of different components on one list.
    placed = (
        listed.select("gram", "doc", "n", "left").join(follow, "doc", "left").join(found.withColumnRenamed("node", "doc"), "doc", "left")
        .select("gram", "doc", "n", "left", F.coalesce("leader", "doc").alias("leader"), F.coalesce("component", "doc").alias("component"), F.coalesce("away", F.lit(0.0)).alias("away"))
    )
    mixed = placed.groupBy("gram").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("gram")
    placed = save(placed.join(mixed, "gram"), "placed")
    if placed.isEmpty():
        return links
    radius = save(follow.groupBy("leader").agg(F.max("away").alias("radius")), "radius")
    drawn = classes.where("sketch is not null").select(F.col("doc").alias("leader"), F.col("n").alias("own"), "sketch")
    groups = placed.groupBy("gram", "leader").agg(F.min("component").alias("component"), F.min("n").alias("n"), F.max("left").alias("left"))
    groups = save(groups.join(radius, "leader", "left").na.fill(0.0, ["radius"]), "groups")
    near = near_in_lists(groups, drawn, percent).join(first, ["a", "b"], "left_anti")
    met = save(likeness(near, sets, shingle, percent).unionByName(met.where("NOT linked")), "leaders-met")
    links = links.union(met.where("linked").select("a", "b"))
    if radius.isEmpty():
        return links

    def apart(pairs: DataFrame, links: DataFrame) -> DataFrame:
        """The pairs (a, b, ...) that are not in one component."""
        now = components(links)
        pairs = pairs.join(now.select(F.col("node").alias("a"), F.col("component").alias("of_a")), "a", "left")
        pairs = pairs.join(now.select(F.col("node").alias("b"), F.col("component").alias("of_b")), "b", "left")
        return pairs.where("coalesce(of_a, a) <> coalesce(of_b, b)").drop("of_a", "of_b")

    def reach(name: str, column: str) -> DataFrame:
        return radius.select(F.col("leader").alias(name), F.col("radius").alias(column))

    close = met.where("NOT linked").join(reach("a", "at_a"), "a", "left").join(reach("b", "at_b"), "b", "left").na.fill(0.0, ["at_a", "at_b"])
    close = close.where(f"at_a + at_b > 0 AND distance <= {limit} + at_a + at_b").select("a", "b", "at_a", "at_b")
    close = save(apart(close, links), "close")
    if close.isEmpty():
        return links

    # 3. Members of close groups meet the other leader; those that reach it meet each other, as groups of their own.
    sides = close.select(F.col("a").alias("leader"), F.col("b").alias("across"), F.col("at_b").alias("reach")).union(close.select("b", "a", "at_a"))
    members = follow.select("doc", "leader").union(sides.select(F.col("leader").alias("doc"), "leader").distinct())
    asked = sides.join(members, "leader").select("across", "reach", "doc")
    across = save(likeness(asked.select(F.col("across").alias("a"), F.col("doc").alias("b")).distinct(), sets, shingle, percent), "across")
    links = links.union(across.where("linked").select("a", "b"))
    asked = asked.join(across.select(F.col("a").alias("across"), F.col("b").alias("doc"), "distance"), ["across", "doc"])
    reaching = asked.where(f"distance <= {limit} + reach").select("doc").union(sides.select(F.col("leader").alias("doc"))).distinct()
    now = components(links).withColumnRenamed("node", "doc")
    single = placed.select("gram", "doc", "n", "left").join(reaching, "doc").join(now, "doc", "left").withColumn("component", F.coalesce("component", "doc"))
    single = save(single.withColumnRenamed("doc", "leader").withColumn("radius", F.lit(0.0)), "reaching-lists")
    last = near_in_lists(single, drawn, percent)
    return links.union(likeness(last, sets, shingle, percent).where("linked").select("a", "b"))


def join_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(key, n_shingles, component_id) of every row: size of its set, and the least document reachable by links."""
    often, counts, sizes = survey(docs, text, shingle)
    most_small = boundary(sizes, percent)
    rows = save(describe(docs, key, text, shingle, percent, most_small, often, counts), "described")
    classes = save(
        rows.where("n > 0").groupBy("s1", "s2", "n").agg(F.min("doc").alias("doc"), F.min("members").alias("members"), F.min("prefix").alias("prefix"), F.min("sketch").alias("sketch")),
        "classes",
    )
    class_of = classes.select("s1", "s2", "n", F.col("doc").alias("class"))
    placed = save(rows.select("doc", "n", "s1", "s2").join(class_of, ["s1", "s2", "n"], "left").select("doc", "n", "class"), "classed")
    # One number with several sets is one document: its classes are linked.
    held = placed.where(F.col("class").isNotNull())
    several = held.groupBy("doc").agg(F.min("class").alias("a"), F.max("class").alias("z")).where("a < z")
    same = held.join(several, "doc").where("class <> a").select("a", F.col("class").alias("b")).distinct()
    known = save(small_links(classes, percent).union(same), "small-links")
    links = save(large_links(classes, docs, key, text, shingle, percent, known), "all-links")
    found = components(links).withColumnRenamed("node", "class")
    component = F.coalesce("component", "class", "doc")
    return placed.join(found, "class", "left").select(
        F.when(F.col("doc") < _LAST, F.col("doc")).alias(key),
        F.col("n").alias("n_shingles"),
        F.when(component < _LAST, component).alias("component_id"),
    )

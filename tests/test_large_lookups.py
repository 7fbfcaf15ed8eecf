"""Large gazetteers, large knowledge bases and TF-IDF against plain versions."""

import math
import random
import re
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from veilpost.operators import anchors, balls, retrieve, semantic, tfidf


def random_values(seed=2, n=1_500):
    r = random.Random(seed)
    letters = "abé日"
    values = {"".join(r.choice(letters) for _ in range(r.choice([1, 2, 3, 4, 5, 8, 14, 15, 16, 30, 46, 47, 60, 120]))) for _ in range(n)}
    values |= {"aaaaaaaaaaaaaaaaaaaa", "a" * 60, "ab" * 40, "a"}
    return sorted(values)


def random_texts(values, seed=3, n=60):
    r = random.Random(seed)
    out = [None, "", "a", "aaaa" * 40]
    for _ in range(n):
        parts = [r.choice(values) if r.random() < 0.5 else "".join(r.choice("abcé日 ") for _ in range(r.randrange(40))) for _ in range(r.randrange(6))]
        out.append("".join(parts))
    return out


def test_anchors_find_all_values():
    values, texts = random_values(), random_texts(random_values())
    known = anchors.Anchored.of(pa.array(values))
    raw = [v.encode() for v in values]
    for at in (0, 7):
        part = texts[at:]
        row, entry = known.found_in(pa.array(texts).slice(at), raw, known.levels())
        want = [(i, e) for i, t in enumerate(part) for e, v in enumerate(values) if t and v in t]
        assert list(zip(row.tolist(), entry.tolist())) == want


def test_long_values_give_out_few_anchors():
    data = np.frombuffer(random.Random(1).randbytes(100_000), np.uint8)
    given = {level: len(at) for level, at, _ in anchors.text_anchors(data, np.array([0, len(data)]), [3, 4, 5])}
    assert given[4] < 0.3 * given[3] and given[5] < 0.08 * given[3]


def test_short_values_and_near_copies_share_no_anchors():
    """Values made of few syllables, and variants of one passage, are told apart before they are joined."""
    r = random.Random(8)
    syllables = ["tion", "er", "and", "the", "on", "ou", "st"]
    short = {"".join(r.choice(syllables) for _ in range(6))[:n] for n in (10, 12, 14) for _ in range(2_000)}
    long = {"a passage that all of the copies have in common " + "".join(r.choice("abc") for _ in range(40)) for _ in range(500)}
    for values, most in ((short, 1), (long, 60)):
        assert np.unique(anchors.Anchored.of(pa.array(sorted(values))).anchor, return_counts=True)[1].max() <= most


def test_all_lengths_of_a_joined_gazetteer_are_looked_for(spark):
    """More distinct lengths than levels have, of which none may be left out."""
    values = [f"{i:03d}" + "x" * i for i in range(150)]
    table = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "item_no int, value string")
    df = spark.createDataFrame([(i, f"- {v} -") for i, v in enumerate(values)], "email_id int, body string")
    got = anchors.match_values(df, table, "body", "found", ["item_no", "value"], "value", "email_id", 0).collect()
    assert {(x.email_id, e.item_no) for x in got for e in x.found} >= {(i, i) for i in range(150)}


@pytest.mark.parametrize("max_bytes", [anchors.MAX_BYTES, 0])
def test_both_ways_to_a_large_gazetteer(spark, max_bytes):
    values = random_values(n=300)
    table = spark.createDataFrame([(i, "KIND", v) for i, v in enumerate(values)] + [(9_000, "KIND", None), (9_001, "KIND", "")], "item_no long, type string, value string")
    texts = random_texts(values, n=25)
    # Repeated keys, missing keys, and columns named as helpers are.
    rows = [(None if i % 7 == 0 else i % 11, t, "x", "y") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "email_id int, body string, text string, found string").repartition(3)
    got = anchors.match_values(df, table, "body", "found", ["item_no", "type", "value"], "value", "email_id", max_bytes)
    assert set(got.columns) == {"email_id", "body", "text", "found"}
    found = sorted(repr((r.email_id, r.body, [e.item_no for e in r.found])) for r in got.collect())
    assert found == sorted(repr((k, t, [i for i, v in enumerate(values) if t and v in t])) for k, t, _, _ in rows)


def test_many_blocks_and_an_answer_in_place_of_the_text(spark, monkeypatch):
    """Blocks of a text or two, entries packed a few at a time, entries that come twice, and blocks without any."""
    monkeypatch.setattr(anchors, "BLOCK_BYTES", 50, raising=False)
    monkeypatch.setattr(anchors, "PACK_BYTES", 200, raising=False)
    values = random_values(n=200)
    rows = [(i, v) for i, v in enumerate(values)] + [(None, "missing number"), (5, values[5])]
    table = spark.createDataFrame(rows, "item_no long, value string").repartition(3)
    texts = [*random_texts(values, n=40), "no such entry, a missing number", "-"]
    df = spark.createDataFrame(list(enumerate(texts)), "email_id int, body string").repartition(5)
    want = {i: [e for e in [(-1, "missing number"), *enumerate(values)] if t and e[1] in t] for i, t in enumerate(texts)}
    for out in ("found", "body"):
        got = anchors.match_values(df, table, "body", out, ["item_no", "value"], "value", "email_id", 0)
        assert got.columns == list(dict.fromkeys(["email_id", *(["body"] if out != "body" else []), out]))
        assert {r.email_id: [(-1 if e.item_no is None else e.item_no, e.value) for e in r[out]] for r in got.collect()} == want


def test_gazetteer_and_texts_of_a_join_are_computed_once(spark):
    values = random_values(n=150)
    texts = random_texts(values, n=15)
    made = {name: spark.sparkContext.accumulator(0) for name in ("entries", "texts")}

    def counting(df, name):
        counter = made[name]

        def work(batches):
            for batch in batches:
                counter.add(batch.num_rows)
                yield batch

        return df.mapInArrow(work, df.schema)

    table = counting(spark.createDataFrame(list(enumerate(values)), "item_no long, value string"), "entries")
    df = counting(spark.createDataFrame(list(enumerate(texts)), "email_id int, body string"), "texts")
    anchors.match_values(df, table, "body", "found", ["item_no", "value"], "value", "email_id", 0).collect()
    assert {name: counter.value for name, counter in made.items()} == {"entries": len(values), "texts": len(texts)}


def test_items_lie_by_their_numbers_not_their_values(spark):
    """Long item numbers, missing ones and entries that come twice, in several partitions."""
    values = random_values(n=120)
    numbers = [None if i % 17 == 0 else f"item {i * 7919 % 101:04d} with a long number" for i in range(len(values))]
    rows = [(n, "KIND", v) for n, v in zip(numbers, values)] + [(numbers[3], "KIND", values[3])]
    table = spark.createDataFrame(rows, "item_no string, type string, value string").repartition(4)
    fields = ["item_no", "type", "value"]
    got = anchors._with_anchors(table, fields, "value", True).collect()
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", *[x.encode() for x in r[1:]]))
    assert [(r.type, r.value) for r in sorted(got, key=lambda r: r.item_no)] == [r[1:] for r in want]
    assert len({r.item_no for r in got}) == len(got) - 1
    texts = random_texts(values, n=20)
    df = spark.createDataFrame(list(enumerate(texts)), "email_id int, masked_email string")
    found = semantic.detect_with_gazetteer(df, table.distinct(), max_rows=1).collect()
    once = list(dict.fromkeys(want))
    assert {r.email_id: [i.value for i in r.semantic_items] for r in found} == {i: [v for _, _, v in once if t and v in t] for i, t in enumerate(texts)}


def test_few_anchors_pass_the_filter_by_chance():
    r = np.random.default_rng(3)
    held, others = (r.integers(0, 2**64, n, np.uint64) for n in (40_000, 1_000_000))
    words = anchors._filter_of(held)
    assert len(anchors._passing(words, held)) == len(held)
    assert len(anchors._passing(words, others)) < 400


@pytest.mark.parametrize("max_bytes", [anchors.MAX_BYTES, 0])
def test_no_values_and_no_texts(spark, max_bytes):
    table = spark.createDataFrame([(1, "a")], "item_no int, value string")
    mails = spark.createDataFrame([(1, "a b"), (2, None)], "email_id int, body string")
    for df, entries, want in ((mails, table, [1, 0]), (mails, table.where("false"), [0, 0]), (mails.where("false"), table, [])):
        got = anchors.match_values(df, entries, "body", "found", ["item_no", "value"], "value", "email_id", max_bytes)
        assert [len(r.found) for r in got.orderBy("email_id").collect()] == want


def test_a_large_gazetteer_does_not_meet_every_mail(spark):
    """Only anchors are exploded and joined: no row per mail and block of entries."""
    table = spark.range(3_000).select("id", F.concat(F.lit("value number "), "id").alias("value"))
    df = spark.range(40).select(F.col("id").alias("email_id"), F.concat(F.lit("here is value number "), "id").alias("body"))
    got = anchors.match_values(df, table, "body", "found", ["id", "value"], "value", "email_id")
    plan = got._jdf.queryExecution().toString()
    assert "Generate" not in plan and "Join" not in plan and "Exchange" not in plan.split("Physical Plan")[-1].replace("Exchange SinglePartition", "")


def test_indicators_of_many_techniques(spark):
    r = random.Random(4)
    phrases = [(f"T{i}", [r.choice(["wire", "pay now", "é link", "click", "x", "urgent wire", ""]) for _ in range(r.randrange(5))]) for i in range(30)]
    table = spark.createDataFrame(phrases, "id string, phrases array<string>").select("id", F.filter("phrases", lambda p: p != "").alias("phrases"))
    mails = spark.createDataFrame([(1, "Urgent WIRE: pay now"), (2, None), (3, ""), (4, "É LINK x"), (4, "click")], "email_id int, email_body string")

    def answers(max_rows):
        return sorted(repr((x.email_id, x.email_body, [tuple(t) for t in x.techniques])) for x in retrieve.rank_by_indicators(mails, table, 4, max_rows=max_rows).collect() if x.email_body is not None)

    assert answers(2_000) == answers(1)


def clustered(n, dims=8, clusters=12, seed=5):
    r = np.random.default_rng(seed)
    centers = r.normal(size=(clusters, dims)) * 4
    return (centers[r.integers(0, clusters, n)] + r.normal(size=(n, dims)) * 0.2).astype("float32")


def test_balls_skip_distances_and_find_all(spark, monkeypatch):
    monkeypatch.setattr(balls, "BLOCK", 64)
    kb, queries = clustered(1_200), clustered(150, seed=6)
    table = spark.createDataFrame([(i, v.astype(float).tolist(), f"n{i}") for i, v in enumerate(kb)], "id long, kb_vector array<double>, name string")
    df = spark.createDataFrame([(i, v.astype(float).tolist()) for i, v in enumerate(queries)], "email_id long, v array<double>")
    got = balls.nearest_in_balls(df, table, F.col("v"), 5, "near", ["name"], seen="seen").collect()
    exact = balls.squared_distances(queries.astype(float), kb.astype(float))
    for row in got:
        order = np.argsort(exact[row.email_id], kind="stable")[:5]
        assert [(n.distance, n.id, n.name) for n in row.near] == [(exact[row.email_id][i], i, f"n{i}") for i in order]
    share = sum(r.seen for r in got) / (len(queries) * len(kb))
    assert share < 0.35, share


def test_balls_with_ties_copies_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(balls, "BLOCK", 8)
    monkeypatch.setattr(balls, "ASKING", 4)
    vectors = [[float(i % 5), float(i % 3)] for i in range(60)] + [[math.nan, 1.0], [math.inf, 0.0], [1.0], [2.0], [], [7.0, 7.0, 7.0]]
    table = spark.createDataFrame(list(enumerate(vectors)), "id int, vector array<double>")
    mails = spark.createDataFrame([(i % 40, v) for i, v in enumerate(vectors)] + [(None, [1.0, 1.0]), (3, None), (4, [1.0, None])], "email_id int, vector array<double>")

    def answers(max_rows):
        return sorted(repr((r.email_id, r.vector, [tuple(n) for n in r.nearest])) for r in retrieve.nearest(mails, table, 3, max_rows=max_rows).collect())

    assert answers(2_000) == answers(1)


def test_queries_are_not_written_once_per_block(spark, monkeypatch, tmp_path):
    """Where nothing can be skipped, what is kept still grows with the rows, not with the pairs."""
    monkeypatch.setattr(balls, "SLAB_BYTES", 60_000, raising=False)
    r = np.random.default_rng(9)
    kb, queries = (r.normal(size=(n, 16)) for n in (700, 400))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(kb)], "id long, kb_vector array<double>")
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(queries)], "email_id long, v array<double>")
    monkeypatch.setattr(balls, "fresh_dir", lambda _, purpose: str(tmp_path / f"{purpose}-{uuid.uuid4().hex}"))
    got = balls.nearest_in_balls(df, table, F.col("v"), 3, "near", seen="seen").collect()
    exact = balls.squared_distances(queries, kb)
    assert {x.email_id: [(n.distance, n.id) for n in x.near] for x in got} == {i: [(row[j], j) for j in np.argsort(row, kind="stable")[:3]] for i, row in enumerate(exact)}
    assert sum(x.seen for x in got) > 0.9 * exact.size
    kept = sum(f.stat().st_size for f in tmp_path.rglob("*.parquet"))
    assert kept < 2 * (kb.nbytes + queries.nbytes), kept


def test_balls_in_several_slabs(spark, monkeypatch):
    """Copies, ties, missing ids and odd vectors that lie in different slabs."""
    monkeypatch.setattr(balls, "BLOCK", 8)
    monkeypatch.setattr(balls, "SLAB_BYTES", 900)
    vectors = [[float(i % 5), float(i % 3)] for i in range(90)] + [[math.nan, 1.0], [math.inf, 0.0], [1.0], [1e200, -1e200], [1e-200, 0.0], [], [7.0, 7.0, 7.0]]
    rows = [(None if i == 40 else i // 2, v, f"n{i // 2}") for i, v in enumerate(vectors)]
    table = spark.createDataFrame(rows, "id int, vector array<double>, name string").repartition(3)

    def answers(max_rows):
        found = retrieve.nearest(table, table, 4, key="id", max_rows=max_rows, carry=["name"])
        return sorted(repr((r.id, r.vector, [tuple(n) for n in r.nearest])) for r in found.collect())

    assert answers(2_000) == answers(1)


def plain_tfidf(kb, mails, k):
    def terms(text):
        return Counter(t for t in re.split(r"[^\w]+|_", (text or "").lower()) if t)

    held = {}
    for i, text in kb:
        if i is not None:
            held.setdefault(i, Counter()).update(terms(text))
    df = Counter(t for c in held.values() for t in c)
    idf = {t: round(100 * (math.log((1 + len(held)) / (1 + n)) + 1)) for t, n in df.items()}
    weight = {i: {t: n * idf[t] for t, n in c.items()} for i, c in held.items()}
    out = []
    for key, text in mails:
        own = {t: n * idf[t] for t, n in terms(text).items() if t in idf}
        scored = []
        for i, w in weight.items():
            dot = sum(own[t] * w[t] for t in own.keys() & w.keys())
            if dot:
                length = math.sqrt(float(sum(x * x for x in own.values()))) * math.sqrt(float(sum(x * x for x in w.values())))
                scored.append((-(float(dot) / length), i))
        out += [(key, rank, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def test_tfidf_is_exact(spark):
    r = random.Random(8)
    words = ["Pay", "wire", "été", "x1", "日本", "the", "the", "of"]
    kb = [(i, " ".join(r.choice(words) for _ in range(r.randrange(12)))) for i in range(12)] + [(3, "the end"), (None, "wire"), (50, None), (51, "")]
    mails = [(i, ", ".join(r.choice([*words, "unknown"]) for _ in range(r.randrange(20)))) for i in range(30)] + [(90, None), (91, ""), (92, "unknown only")]
    index = tfidf.build_index(spark.createDataFrame(kb, "id int, text string"))
    got = tfidf.nearest_texts(spark.createDataFrame(mails, "email_id int, raw_email string"), index, 3)
    assert sorted(map(tuple, got.collect())) == plain_tfidf(kb, mails, 3)


@pytest.mark.parametrize("local_rows", [tfidf.LOCAL_ROWS, 3])
def test_both_ways_to_an_index(spark, monkeypatch, local_rows):
    monkeypatch.setattr(tfidf, "LOCAL_ROWS", local_rows)
    r = random.Random(9)
    kb = [(i, " ".join(r.choice("abcdefgh") for _ in range(9))) for i in range(9)]
    # Rows of one key are one text; rows without a key are left out.
    mails = [(i % 20, " ".join(r.choice("abcdxyz") for _ in range(12))) for i in range(30)]
    index = tfidf.build_index(spark.createDataFrame(kb, "id int, text string"))
    got = tfidf.nearest_texts(spark.createDataFrame([*mails, (None, "a b")], "email_id int, raw_email string").repartition(3), index, 4)
    whole = {}
    for key, text in mails:
        whole[key] = f"{whole.get(key, '')} {text}"
    assert sorted(map(tuple, got.collect())) == plain_tfidf(kb, whole.items(), 4)


def test_texts_meet_a_small_index_before_they_are_shuffled(spark):
    index = tfidf.build_index(spark.createDataFrame([(1, "a b")], "id int, text string"))
    mails = spark.createDataFrame([(i, f"a x{i}") for i in range(50)], "email_id int, raw_email string")
    plan = tfidf.nearest_texts(mails, index, 3)._jdf.queryExecution().executedPlan().toString()
    # Read from the end: the first shuffle is of terms that met the index, the second brings them together by text.
    assert plan.count("Exchange hashpartitioning") == 2, plan
    assert "BroadcastHashJoin" in plan.split("Exchange hashpartitioning")[-1]


def test_tfidf_of_nothing(spark):
    empty = spark.createDataFrame([], "id int, text string")
    mails = spark.createDataFrame([(1, "a")], "email_id int, raw_email string")
    assert tfidf.nearest_texts(mails, tfidf.build_index(empty), 3).count() == 0
    assert tfidf.nearest_texts(mails.where("false"), tfidf.build_index(spark.createDataFrame([(1, "a")], "id int, text string")), 3).count() == 0

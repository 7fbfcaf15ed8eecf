"""The Jaccard join, the phrases and the runs against plain versions, on given tables, edge rows and planted families."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from veilpost.llm import jaccard_join, periodic, phrases
from veilpost.llm.queries import QUERIES

from .conftest import EDGES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def answers(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


# --- joins ---------------------------------------------------------------------------------------


def plain_components(rows, size=4, percent=85):
    """Union-find over all pairs of distinct sets that share a shingle; rows of one number, or of none, are one document."""
    sets = []
    for _, text in rows:
        w = WORD.findall(lower(text))
        sets.append(frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset())
    named = [2**63 - 1 if i is None else i for i, _ in rows]
    parent = {s: s for s in sets if s}

    def root(s):
        while parent[s] != s:
            s = parent[s]
        return s

    keys, lists = list(parent), defaultdict(list)
    for at, s in enumerate(keys):
        shared = Counter(b for g in s for b in lists[g])
        for b, n in shared.items():
            if 100 * n >= percent * (len(s) + len(keys[b]) - n):
                parent[root(s)] = root(keys[b])
        for g in s:
            lists[g].append(at)
    of_number = {}
    for s, i in zip(sets, named):
        if s:
            parent[root(s)] = root(of_number.setdefault(i, s))
    least = {}
    for s, i in zip(sets, named):
        if s:
            least[root(s)] = min(i, least.get(root(s), i))
    found = [least[root(s)] if s else i for s, i in zip(sets, named)]
    return sorted([(i, len(s), None if c == 2**63 - 1 else c) for (i, _), s, c in zip(rows, sets, found)], key=repr)


def words_of(n, seed):
    r = random.Random(seed)
    return [f"w{r.randrange(10**6)}" for _ in range(n)]


def near_copies():
    """Chains and families: edits of one text, texts of two shared halves, short texts one word apart."""
    rows, r = [], random.Random(5)
    for base in range(12):
        text = words_of(r.choice([4, 6, 9, 14, 18, 24, 40, 90, 300]), base)
        for _ in range(9):
            copy = list(text)
            for _ in range(r.randrange(0, 1 + len(copy) // 40 + 2)):
                copy[r.randrange(len(copy))] = f"e{r.randrange(50)}"
            if r.random() < 0.4:
                text = copy
            rows.append(" ".join(copy))
    halves = [words_of(40, 100 + i) for i in range(5)]
    for i in range(60):
        a, b = r.sample(range(5), 2)
        rows.append(" ".join([*halves[a], *halves[b], f"own{i % 50}"]))
    return [(i + 1, t) for i, t in enumerate(rows)]


@pytest.fixture(scope="module")
def mixed(spark, table):
    """Edge rows, near copies and a family of templates, and what a plain join says about them."""
    rows = [*EDGES, *near_copies(), *[(1_000 + i, t) for i, t in family(60)]]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3), plain_components(rows)


def test_links(mixed):
    docs, want = mixed
    assert answers(jaccard_join.join_documents(docs)) == want


def test_any_boundary_gives_the_same_links(mixed, monkeypatch):
    docs, want = mixed
    monkeypatch.setattr(jaccard_join, "boundary", lambda sizes, percent: 8)
    # Every list by sketches, and cut into chunks.
    monkeypatch.setattr(jaccard_join, "FEW", 1)
    monkeypatch.setattr(jaccard_join, "CHUNK", 5)
    assert answers(jaccard_join.join_documents(docs)) == want


def test_join_query(spark, table, sf_dir, rows):
    whole = [r for r in rows if r[0] is not None and r[0] < 9001]
    assert answers(QUERIES["op11_ngram_jaccard"](spark, sf_dir)) == plain_components(whole)


def test_join_of_nothing(nothing):
    assert jaccard_join.join_documents(nothing).collect() == []


def test_boundary_follows_the_cost():
    assert jaccard_join.boundary({3: 10, 30: 1}, 85) >= 3
    few, many = jaccard_join.boundary({5: 10**6, 20: 10}, 85), jaccard_join.boundary({20: 10**6}, 85)
    assert 5 <= few and many < 20
    for n in range(1, 27):
        # A subset of every size that a partner of any size shares.
        for other in range(-(-85 * n // 100), 100 * n // 85 + 1):
            c = jaccard_join.needed(n, other, 85)
            if c <= min(n, other):
                assert c in jaccard_join.subset_sizes(n, 85)


def family(n):
    """Documents of two of ten templates and one word of their own."""
    halves, r = [words_of(60, 200 + i) for i in range(10)], random.Random(7)
    pairs = [r.sample(range(10), 2) for _ in range(n)]
    return [(i, " ".join([*halves[a], *halves[b], f"own{i}"])) for i, (a, b) in enumerate(pairs)]


def test_shared_templates_do_not_pair_all(spark, table, monkeypatch):
    met = []
    plain = jaccard_join.likeness

    def counting(pairs, *others):
        met.append(pairs.count())
        return plain(pairs, *others)

    monkeypatch.setattr(jaccard_join, "likeness", counting)
    sizes = []
    for n in (120, 240):
        met.clear()
        rows = family(n)
        assert answers(jaccard_join.join_documents(spark.createDataFrame(rows, "doc_id long, text string"))) == plain_components(rows)
        sizes.append(sum(met))
    assert sizes[1] < 3 * sizes[0]


# --- phrases -------------------------------------------------------------------------------------


def plain_phrases(rows, least=10, longest=3, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + d])) for d in range(1, longest + 1) for i in range(len(w) - d + 1))
    found = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    around = Counter()
    for (lang, p), a in found.items():
        for d in range(2, len(p)):
            for i in range(len(p) - d + 1):
                around[lang, p[i : i + d]] = max(a, around[lang, p[i : i + d]])
    by_lang = defaultdict(list)
    for (lang, p), a in found.items():
        if 100 * around[lang, p] < 50 * a:
            score, k = min((10**6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
            by_lang[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted(
        (
            (lang, rank, p.decode(), -a, l, r, n[lang], -score)
            for lang, ranked in by_lang.items()
            for rank, (score, a, p, l, r) in enumerate(sorted(ranked)[:top], 1)
        ),
        key=repr,
    )


def spoken(seed, n=400):
    """Texts of few words, so that phrases recur, with all kinds of ends and blanks."""
    r = random.Random(seed)
    vocabulary = ["a", "B", "the", "of", "x\x01", "\x01", "été", "zz", "Ünd", "q-q"]
    ends = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", " ! ", "\x0b", "?"]
    return [(r.choice(["en", "e n", "e_n", "", None, "und"]), "".join(r.choice(vocabulary) + r.choice(ends) for _ in range(r.randrange(40)))) for _ in range(n)]


@pytest.mark.parametrize("budget", [phrases.BUDGET, 40])
def test_phrases_of_any_group_size(spark, table, monkeypatch, budget):
    monkeypatch.setattr(phrases, "_HELD", 50)
    rows = spoken(3)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    assert answers(phrases.mine(docs, budget=budget)) == plain_phrases(rows)


def test_longer_phrases_and_cut(spark, table):
    rows = spoken(4)
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert answers(phrases.mine(docs, max_words=4, least=5, top=7)) == plain_phrases(rows, 5, 4, 7)


def test_phrases_of_edge_rows(spark, table):
    rows = [(r["lang"], r["text"]) for r in table.select("lang", "text").collect()]
    assert answers(phrases.mine(table)) == plain_phrases(rows)


def test_phrases_of_nothing(nothing):
    assert phrases.mine(nothing).collect() == []


def test_phrase_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["lang"], r["text"]) for r in docs.select("lang", "text").collect()]
    assert answers(QUERIES["op12_collocations"](spark, sf_dir)) == plain_phrases(rows)


def test_heavy_prefixes_are_split(spark, table):
    rows = spark.createDataFrame([("en", f"the w{i % 7} v{i}", 1) for i in range(90)] + [("en", f"o{i}", 1) for i in range(5)], "lang string, leaf string, n long")
    dealt, groups = phrases.grouped(rows, 3, 10)
    depths = {(r["leaf"].split()[0], r["depth"]) for r in dealt.collect()}
    assert ("the", 3) in depths and groups > 1 and {d for w, d in depths if w != "the"} == {1}


# --- runs ----------------------------------------------------------------------------------------


def plain_runs(w, least=6, times=4):
    """All stretches of every lag, word by word in numpy; those with a smaller period go."""
    ids = np.array([hash(x) for x in w])
    found = []
    for q in range(1, len(w) // times + 1):
        equal = np.concatenate([[0], ids[q:] == ids[:-q], [0]]).astype(int)
        begins, ends = np.flatnonzero(np.diff(equal) == 1), np.flatnonzero(np.diff(equal) == -1)
        for s, e in zip(begins.tolist(), ends.tolist()):
            part = w[s : e + q]
            if len(part) >= max(least, times * q) and not any(q % d == 0 and part[d:] == part[:-d] for d in range(1, q)):
                found.append((s, len(part), q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def dropped(runs):
    return {i for s, n, q in runs for i in range(s + q, s + n)}


@pytest.mark.parametrize("least,times", [(6, 4), (1, 3), (20, 4), (9, 6)])
def test_runs_of_random_words(least, times):
    r = random.Random(11)
    texts = []
    for _ in range(300):
        w = [r.choice("ab" if r.random() < 0.5 else "abcdefgh") for _ in range(r.randrange(30))]
        for _ in range(r.randrange(3)):
            at, unit = r.randrange(len(w) + 1), [r.choice("abc") for _ in range(r.randrange(1, 9))]
            w[at:at] = (unit * r.randrange(2, 9))[: r.randrange(1, 60)]
        texts.append(w)
    ids = np.array([periodic.mix(np.array([ord(c)], np.uint64))[0] for w in texts for c in w], np.uint64)
    first = np.append(0, np.cumsum([len(w) for w in texts]))
    got = defaultdict(list)
    for doc, *run in zip(*(x.tolist() for x in periodic.find_runs(ids, first, least, times))):
        got[doc].append(tuple(run))
    for i, w in enumerate(texts):
        assert got[i] == plain_runs(w, least, times), w


def test_runs_need_three_periods():
    with pytest.raises(ValueError):
        periodic.find_runs(np.zeros(0, np.uint64), np.zeros(1, np.int64), 6, 2)


def test_one_word_many_times_is_linear():
    n = 300_000
    doc, start, length, period = periodic.find_runs(np.full(n, 7, np.uint64), np.array([0, n]))
    assert [x.tolist() for x in (doc, start, length, period)] == [[0], [0], [n], [1]]


def test_collapsed_texts_of_edge_rows(spark, table, rows):
    long_rows = {9007, 9008, 9009}
    got = periodic.collapse_runs(table, collapsed="spans").where(f"coalesce(doc_id, 0) not in {tuple(long_rows)}")
    assert set(got.columns) == {*table.columns, "runs"}
    want = []
    for i, text in rows:
        if i not in long_rows:
            w = WORD.findall(text or "")
            runs = plain_runs(w)
            want.append((i, runs, " ".join(x for k, x in enumerate(w) if k not in dropped(runs))))
    found = [(r["doc_id"], [tuple(x) for x in r["runs"]], r["spans"]) for r in got.collect()]
    assert sorted(found, key=repr) == sorted(want, key=repr)


def test_runs_of_nothing(nothing):
    assert periodic.collapse_runs(nothing).collect() == []


def test_run_query(spark, sf_dir, rows):
    def plain(i, text):
        w = WORD.findall(text or "")
        h = zlib.crc32(str(i).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
        runs = plain_runs(w)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
        kept = " ".join(x for k, x in enumerate(w) if k not in dropped(runs))
        lines = "".join(f"{s},{size},{q}\n" for s, size, q in runs)
        return (i, len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha(lines), sha(kept))

    whole = [r for r in rows if r[0] is not None and r[0] < 9001]
    assert answers(QUERIES["op13_periodic_runs"](spark, sf_dir)) == sorted((plain(*r) for r in whole), key=repr)


def test_full_sets_never_travel_in_batches(spark, capsys):
    """Pairs with both full sets stay in the rows of the join; a number with several sets is as near as the nearest."""
    sets = [(1, [1, 2, 3, 4]), (2, [2, 3, 4, 9]), (3, [-5]), (4, [-5, 7]), (4, [-5]), (5, list(range(100))), (6, list(range(3, 103)))]
    texts = spark.createDataFrame(sets, "doc long, members array<long>")
    pairs = spark.createDataFrame([(1, 2), (1, 3), (3, 4), (5, 6)], "a long, b long")
    found = jaccard_join.likeness(pairs, texts, 4, 85)
    found.explain()
    assert "InArrow" not in capsys.readouterr().out
    assert sorted(map(tuple, found.collect())) == [(1, 2, 1 - 3 / 5, False), (1, 3, 1.0, False), (3, 4, 0.0, True), (5, 6, 1 - 97 / 103, True)]
    assert max(len(i) for i, _ in jaccard_join._pairs_of(np.full(1_200, 1_199))) <= 1 << 17


def test_full_sets_are_shuffled_once(spark, capsys):
    """Sets lie in buckets by document, so a join on either side moves pairs, and no set that no pair asks for."""
    docs = spark.createDataFrame([(i, " ".join(f"w{(i // 3 * 5 + j) % 150}" for j in range(20))) for i in range(60)], "doc_id long, text string")
    sets = jaccard_join.sets_of(docs, docs.select(docs.doc_id.alias("doc")), "doc_id", "text", 4, 60 * 17)
    pairs = spark.createDataFrame([(i, i + 1) for i in range(59)], "a long, b long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = jaccard_join.likeness(pairs, sets, 4, 85)
        found.explain()
        assert sum(r.linked for r in found.collect()) == 40
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    plan = capsys.readouterr().out
    assert plan.count("SortMergeJoin") == plan.count("Exchange hashpartitioning") == 2, plan


def test_frequent_keys_take_little_room():
    import tracemalloc

    rng = np.random.default_rng(4)
    for size in (0, 1, 2, 3, 50, 2_000):
        keys = rng.integers(0, max(1, size // 2), size).astype(np.uint64)
        want = {k: n for k, n in Counter(keys.tolist()).items() if n >= jaccard_join.OFTEN}
        got, n = jaccard_join.frequent(keys)
        assert got.tolist() == sorted(want) and n.tolist() == [want[k] for k in sorted(want)]
    keys = rng.integers(0, 1 << 62, 1_000_000).astype(np.uint64)
    tracemalloc.start()
    jaccard_join.frequent(keys)
    assert tracemalloc.get_traced_memory()[1] < keys.nbytes / 2
    tracemalloc.stop()

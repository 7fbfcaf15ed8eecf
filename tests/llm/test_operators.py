"""Each operator against a plain version on small rows with all the edge cases, and on an empty table."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from veilpost.llm import fingerprint, language_model, near_duplicates, outliers, packing, personal_data, pieces, sharding, substrings, toxicity
from veilpost.llm.components import components
from veilpost.llm.tables import pieces_file, ranks_file

WORD = r"[^\x20\x09-\x0D]+"


def words(text, lower=False):
    text = text or ""
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text) if lower else text)


def ordered(pairs):
    return sorted(pairs, key=repr)


def test_outliers_counts(table, rows, nothing):
    got = outliers.judge(table).collect()
    want = []
    for i, t in rows:
        w = words(t)
        grams = [tuple(w[j : j + 5]) for j in range(len(w) - 4)]
        often = collections.Counter(grams)
        inside = [0] * len(w)
        for j, g in enumerate(grams):
            if often[g] > 1:
                inside[j : j + 5] = [1] * 5
        lines = [x for x in (t or "").split("\n") if words(x)]
        n = sum(inside)
        want.append((i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), n, len(w) < 10 or 100 * n > 20 * len(w)))
    assert ordered((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == ordered(want)
    assert not any(r.kept and r.base_failed for r in got)
    assert outliers.judge(nothing).count() == 0


def test_outliers_find_planted_vectors(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.multivariate_normal([5, 1.6, 1, 1, 1], np.diag([0.6, 0.05, 0.4, 0.5, 0.5]), 600) * 1024).astype(int)
    x[::6, 2] += 9000  # a sixth of the rows lie far off; plain means and variances would hide them
    data = spark.createDataFrame([("g", *map(int, r)) for r in x], "g string, x1 long, x2 long, x3 long, x4 long, x5 long")
    params = outliers.fit(data)
    far = outliers._with_distance(data.join(params, "g")).select((F.col("d2") / F.col("scale") > outliers.CUTOFF).alias("far"), "x3").collect()
    assert {r.x3 > 7000 for r in far if r.far} == {True} and sum(r.far for r in far) == 100


def test_language_model(table, rows, nothing):
    train = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) != 2, F.lit(True))
    got = language_model.score_documents(table, train).collect()
    learns = lambda i: i is None or zlib.crc32(str(i).encode()) % 7 != 2
    tokens = [(i, [*words(t, True), "\n"]) for i, t in rows]
    counts = collections.Counter(w for i, ws in tokens if learns(i) for w in ws)
    n, v = sum(counts.values()), len(counts)
    want = [(i, len(ws), sum(counts[w] > 0 for w in ws), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), 4)) for i, ws in tokens]
    assert ordered((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == ordered(want)
    assert all(r.score < 0 for r in got)
    held = [r for r in got if not r.train]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert language_model.score_documents(nothing, train).count() == 0


def test_language_model_sums_to_one(spark):
    texts = ["a b a c", "a b", "c a", "", "b b b a"]
    probe = [f"a {w}" for w in ["a", "b", "c"]]
    docs = spark.createDataFrame([(i, t, True) for i, t in enumerate(texts)] + [(100 + i, t, False) for i, t in enumerate(probe)] + [(200, "a", False), (201, "zz", False)], "doc_id long, text string, train boolean")
    model = language_model.Model(docs, "doc_id", "text", F.col("train"))
    # Probability after "a" of every known word, of the end, and of one unseen word.
    n, v = model.tokens, model.types
    counts = collections.Counter(w for t in texts for w in [*t.split(), "\n"])
    pairs = collections.Counter(p for t in texts for p in zip(t.split(), [*t.split()[1:], "\n"]))
    back = model.backoff[language_model._bins(np.array([counts["a"]]))][0]
    p = lambda w: (1 - back) * pairs["a", w] / counts["a"] + back * (counts[w] + 1) / (n + v + 1)
    assert math.isclose(sum(map(p, [*counts, "unseen"])), 1)
    got = {r.key: r.score for r in model.score().collect()}
    assert math.isclose(got[101] - got[100], math.log10(p("b") / p("a")) + math.log10(_end(model, counts, pairs, "b") / _end(model, counts, pairs, "a")), abs_tol=1e-9)


def _end(model, counts, pairs, word):
    back = model.backoff[language_model._bins(np.array([counts[word]]))][0]
    return (1 - back) * pairs[word, "\n"] / counts[word] + back * (counts["\n"] + 1) / (model.tokens + model.types + 1)


def test_index_is_exact():
    rng = np.random.default_rng(5)
    points = sorted({tuple(sorted(rng.choice(40, rng.integers(1, 6), replace=False).tolist())) for _ in range(900)})
    units = [(p, tuple(np.round(np.full(len(p), 1 / math.sqrt(len(p))), 9))) for p in points]
    n = rng.integers(1, 5, len(units)).astype(float)
    index = toxicity.Index(units, n, np.zeros(len(units)), list(range(len(units))))
    for q in units[::37]:
        cosine = np.array([sum(w * dict(zip(*q)).get(t, 0) for t, w in zip(*u)) for u in units])
        got = index.nearest(q, 25)
        assert sum(n[p] for p, _ in got) >= 25
        least = min(c for _, c in got)
        assert {p for p, _ in got} == set(np.flatnonzero(cosine >= least - 1e-7)) and all(abs(cosine[p] - c) < 1e-6 for p, c in got)


def test_toxicity(spark, nothing):
    rng = np.random.default_rng(1)
    vocab = [f"word{i}" for i in range(300)]
    rows, marks = [], []
    for i in range(900):
        toxic = i % 6 == 0
        rows.append((i, " ".join([*rng.choice(vocab, 30), *(rng.choice(["vile", "awful"], 2) if toxic else [])])))
        marks.append((i, int(toxic)))
    rows += [(1000, None), (1001, ""), (1002, "Vile, AWFUL!"), (1002, "Vile, AWFUL!"), (None, "word1")]
    marks += [(3, None), (None, 1), (6, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    train = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) != 0, F.lit(True))
    got = toxicity.score_documents(docs, toxicity.fit(docs, labels, train)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    known = dict(marks[:900])
    held = [r for r in got if r.doc_id in known and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert sum((r.score >= 0.5) == known[r.doc_id] for r in held) / len(held) > 0.97
    by = {r.doc_id: r for r in got}
    assert by[1000].score == by[1001].score < 0.5 <= by[1002].score and by[1002].evidence
    empty = toxicity.fit(docs, labels.limit(0), train)
    assert {r.score for r in toxicity.score_documents(docs, empty).collect()} == {0.0}
    assert toxicity.score_documents(nothing.select("doc_id", "text"), empty).count() == 0


def test_toxicity_of_few_labels_uses_every_word(spark):
    """Words too rare among few labels for any test of significance still make texts near."""
    rows = [(i, f"{'nasty' if i % 4 == 0 else 'kind'} own{i} t{i % 4}") for i in range(40)] + [(100, "nasty"), (101, "kind"), (102, "unheard")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(40)], "doc_id long, toxic int")
    scorer = toxicity.fit(docs, labels, F.lit(True))
    assert len(scorer.terms) == 46
    # Frequencies are those of all documents, labelled or not: "kind" is in 30 examples and one more text.
    held = dict(zip(scorer.terms.tolist(), toxicity._frequencies(docs, "text", scorer.terms)[1].tolist()))
    assert max(held.values()) == 31
    by = {r.doc_id: r for r in toxicity.score_documents(docs, scorer).collect()}
    assert by[100].score > by[101].score and by[100].evidence and by[101].evidence and not by[102].evidence
    assert by[100].evidence[0] % 4 == 0 and by[0].evidence[0] == 0 and by[1].evidence[0] == 1


def test_shards(table, rows, nothing):
    got = sharding.shard_documents(table.select("doc_id", "text", "key"), shards=4).collect()
    assert ordered((r.doc_id, r.text, r["size"]) for r in got) == ordered((i, t, len((t or "").encode()) + 1) for i, t in rows)
    total, most = collections.Counter(), max(r["size"] for r in got)
    slots = collections.defaultdict(list)
    for r in got:
        total[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(total.values()) - min(total.values()) <= 2 * most
    assert sharding.shard_documents(nothing.select("doc_id", "text")).count() == 0


def test_hot_copies_are_split(spark):
    docs = spark.createDataFrame([(i, "copy " * 20 if i % 3 else f"own {i}") for i in range(3000)], "doc_id long, text string")
    sizes = [r[1] for r in sharding.shard_documents(docs, shards=8).groupBy("shard").agg(F.sum("size")).collect()]
    assert len(sizes) == 8 and max(sizes) - min(sizes) <= 400


def test_pieces(table, rows, nothing):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=pieces_file())
    encoded = pieces.encode_documents(table.select("doc_id", "text"), pieces_file())
    got = pieces.decode_documents(encoded, pieces_file()).collect()
    want = [(i, t, library.encode(t or ""), t or "") for i, t in rows]
    assert ordered((r.doc_id, r.text, list(r.ids), r.decoded) for r in got) == ordered(want)
    once = pieces.encode_documents(encoded.select("doc_id", "text"), pieces_file(), decoded="decoded").collect()
    assert ordered((r.doc_id, r.text, list(r.ids), r.decoded) for r in once) == ordered(want)
    missing = encoded.selectExpr("doc_id", "IF(text = '', NULL, ids) AS ids", "text")
    assert all(r.decoded is None for r in pieces.decode_documents(missing, pieces_file()).where("ids IS NULL").collect())
    assert pieces.encode_documents(nothing.select("doc_id", "text"), pieces_file()).count() == 0


def test_pieces_of_hard_texts():
    import random

    import sentencepiece

    library, own = sentencepiece.SentencePieceProcessor(model_file=pieces_file()), pieces.Pieces(pieces_file())
    pick = random.Random(4)
    texts = ["   a  b ", "\n\n x", "日本語 𝒳 ñ", "a" * 500, "abcdefghij" * 30, "\x00 z\x00q"]
    texts += ["".join(pick.choice("abehitn  \n.,é") for _ in range(pick.randint(1, 120))) for _ in range(500)]
    assert [i.tolist() for i in own.encode(texts)] == library.encode(texts)


@pytest.mark.parametrize("size", [13])
def test_repeats(table, rows, nothing, size):
    first = {}
    rank = lambda i: math.inf if i is None else i
    for i, t in rows:
        w = words(t)
        for j in range(len(w) - size + 1):
            key = tuple(w[j : j + size])
            first[key] = min(first.get(key, math.inf), rank(i))
    want = []
    for i, t in rows:
        w = words(t)
        gone = [0] * len(w)
        for j in range(len(w) - size + 1):
            if first[tuple(w[j : j + size])] < rank(i):
                gone[j : j + size] = [1] * size
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        want.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    got = substrings.remove_repeats(table).collect()
    assert ordered((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == ordered(want)
    cut = substrings.cut_repeats(table)
    assert cut.columns == table.columns
    lost = [r for r in want if r[2] and r[1] == r[2]]
    assert cut.count() == len(rows) - len(lost)
    assert substrings.remove_repeats(nothing).count() == 0


@pytest.mark.parametrize("width", [1 << 10, 5 << 21, 1 << 32, (1 << 32) + 12345, 9 << 32])
def test_sketch_cells_of_any_width(width):
    keys = np.random.default_rng(8).integers(0, 2**64, 20_000, np.uint64)
    assert substrings._scaled(keys, width).tolist() == [int(k) * width >> 64 for k in keys]
    cells = substrings._cells(keys, 0, width) >> np.uint64(64 - substrings._bits(width))
    # They lie evenly over the whole row of the sketch.
    eighths = np.bincount((cells.astype(float) * 8 / width).astype(int), minlength=8)
    assert len(eighths) == 8 and eighths.min() > 2200 and eighths.max() < 2800


def _spans(text):
    kinds = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }

    def good(kind, value):
        d = re.sub("[^0-9]", "", value)
        if kind == "card":
            total = sum(int(c) * (1 + i % 2) - 9 * (int(c) * (1 + i % 2) > 9) for i, c in enumerate(d[::-1]))
            return 12 <= len(d) <= 19 and total % 10 == 0
        return {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in value.split(".")), "phone": 9 <= len(d) <= 15}[kind]

    found = [(m.start(), k, kind, m.end()) for k, (kind, p) in enumerate(kinds.items()) for m in re.finditer(p, text) if good(kind, m[0])]
    return [f"{kind}:{a}:{z}" for a, _, kind, z in sorted(found)]


def test_personal_data(spark, table, rows, nothing):
    hard = ["1.2.3.4.5.6.7.8 a@b.c@d.e a@b..c", "+" * 50 + "1 234 567 890 1", "4111-1111-1111-1111" * 3, "0001.002.03.4 " + "7 " * 2000, "a" * 5000 + "@" + "b." * 500 + "c", "x@y.z " * 700]
    docs = table.select("doc_id", "text").union(spark.createDataFrame([(9100 + i, t) for i, t in enumerate(hard)], "doc_id long, text string"))
    candidates = personal_data.with_candidates(docs)
    model = personal_data.fit(candidates)
    strict = F.filter("spans", lambda s: s["strict"])
    found = candidates.withColumn("spans", personal_data.spans(model))
    got = found.select("doc_id", personal_data.spans_text(strict).alias("strict"), personal_data.spans_text(F.col("spans")).alias("all")).collect()
    want = [(i, ",".join(_spans(t or ""))) for i, t in [*rows, *((9100 + i, t) for i, t in enumerate(hard))]]
    assert ordered((r.doc_id, r.strict) for r in got) == ordered(want)
    assert all(set(r.strict.split(",")) <= set(r["all"].split(",")) | {""} for r in got)
    masked = personal_data.mask_documents(table, model)
    assert masked.dtypes == table.dtypes
    text = masked.where("doc_id = 9013").first().text
    assert text == "mail [EMAIL] or [PHONE], card [CARD] at [IP] and 999.1.1.1"
    assert personal_data.estimate([]) == {} and personal_data.mask_documents(nothing, {}).count() == 0


def test_estimates_learn_labelers():
    pattern = collections.namedtuple("pattern", "kind votes n")
    seen = [pattern("k", [1, 1, 1, 1, 1], 400), pattern("k", [1, -1, 1, 1, 1], 380), pattern("k", [-1, 1, -1, -1, 0], 390), pattern("k", [-1, -1, -1, -1, 0], 410)]
    _, weights = personal_data.estimate(seen)["k"]
    # The second labeler votes at random and gets no weight; the first decides.
    assert abs(weights[1][1]) < 0.3 and weights[0][1] > 3 > -3 > weights[0][-1]


def shingles(text):
    w = words(text, True)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def test_near_duplicates(spark, table, rows, nothing):
    base = [f"t{i}" for i in range(120)]
    near = [(20_000 + k, " ".join(["edit%d" % k if i == 7 * k % 120 else w for i, w in enumerate(base)])) for k in range(60)]
    docs = table.select("doc_id", "text").union(spark.createDataFrame(near, "doc_id long, text string"))
    everything = [*rows, *near]
    number = lambda i: 2**63 - 1 if i is None else i
    sets = [(number(i), shingles(t)) for i, t in everything]
    least = {i: i for i, _ in sets}

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for a, (i, s) in enumerate(sets):
        for j, o in sets[:a]:
            if s and o and 100 * len(s & o) >= 75 * len(s | o):
                x, y = sorted((root(i), root(j)))
                least[y] = x
    want = []
    for (i, _), (n, s) in zip(everything, sets):
        component = root(n)
        want.append((i, len(s), None if component == 2**63 - 1 else component, n == component))
    got = near_duplicates.near_duplicates(docs).collect()
    assert ordered((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == ordered(want)
    assert near_duplicates.near_duplicates(nothing).count() == 0


def test_near_duplicates_in_a_family_of_one_template(spark):
    """Buckets full of documents that share a long template and are no near-duplicates, but for three of them."""
    template = [f"form{i}" for i in range(300)]
    family = [(i, " ".join([*template, *(f"own{i}x{j}" for j in range(70 if i < 160 else 40))])) for i in range(163)]
    for i, text in family[::40] + family[160:]:
        alike = [j for j, o in family if j != i and 100 * len(shingles(text) & shingles(o)) >= 75 * len(shingles(text) | shingles(o))]
        assert alike == ([j for j in (160, 161, 162) if j != i] if i >= 160 else [])
    got = near_duplicates.near_duplicates(spark.createDataFrame(family, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: min(i, 160) for i, _ in family}


def test_components_of_a_chain(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (100, 101)]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)}
    assert len(got) == 81


def test_fingerprints(table, rows, nothing):
    got = fingerprint.compare_with_next(table).collect()
    order = sorted(rows, key=lambda r: (-math.inf if r[0] is None else r[0], r[1] or ""))
    texts = [t or "" for _, t in order]
    following = texts[1:] + texts[:1]
    edits = [a[: len(a) - len(a) // 2] + b[: len(a) // 2] for a, b in zip(texts, following)]
    want = [(i, len(t), hashlib.sha256(e.encode()).hexdigest()) for (i, _), t, e in zip(order, texts, edits)]
    assert ordered((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == ordered(want)
    jaccard = lambda a, b: 1.0 if a == b else len(a & b) / max(1, len(a | b))
    true = {(i, e[2]): (jaccard(shingles(t), shingles(x)), jaccard(shingles(t), shingles(n))) for (i, _), t, x, n, e in zip(order, texts, edits, following, want)}
    for r in got:
        near, ahead = true[r.doc_id, r.edited_sha256]
        assert abs(r.near_edited - near) < 0.17 and (r.doc_id in (9011, 9012, None) or abs(r.near_next - ahead) < 0.17)
    by_text = collections.defaultdict(set)
    full = fingerprint.fingerprint_documents(table.select("doc_id", "text"), out="print").collect()
    for r in full:
        by_text[r.text or ""].add(bytes(r.print))
    assert all(len(v) == 1 for v in by_text.values()) and by_text[""] == {b""}
    assert fingerprint.compare_with_next(nothing).count() == 0


def test_packing(table, rows, nothing):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    got = packing.pack_documents(table, *ranks_file()).collect()
    lengths = collections.Counter()
    by_sequence = collections.defaultdict(list)
    encoded = {t: [*tokenizer.encode(t, add_special_tokens=False).ids, 1] for t in {t or "" for _, t in rows}}
    pieces_ = collections.Counter((i, len(encoded[t or ""])) for i, t in rows)
    crc = {}
    for i, t in rows:
        crc[i] = encoded[t or ""]
    for r in got:
        ids = crc[r.doc_id]
        assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
        lengths[r.doc_id, r.doc_tokens] += r.length
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert lengths == {k: k[1] * n for k, n in pieces_.items()}
    last = max(by_sequence)
    assert sorted(by_sequence) == list(range(last + 1))
    for s, found in by_sequence.items():
        found.sort()
        assert [o for o, _ in found] == [sum(n for _, n in found[:k]) for k in range(len(found))]
        assert s == last or sum(n for _, n in found) == packing.WINDOW
    assert packing.pack_documents(nothing, *ranks_file()).count() == 0


def test_cached_chunks_are_the_tokenizers_ids():
    import random

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    own, pick = packing.ChunkIds(*ranks_file()), random.Random(2)
    texts = ["".join(pick.choice("ab'st \n\t1é.,   \x1c") for _ in range(pick.randint(0, 60))) for _ in range(3000)] + ["<|endoftext|> x", " a", "\na", "a\n", "a \n b"]
    for t in texts:
        assert np.frombuffer(own.text(t), "<u2").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_toxicity_is_fitted_without_the_examples_on_the_driver(spark, monkeypatch):
    """Words and vectors of examples reach the driver as one line per word and as packed parts, never as rows of an example."""
    from pyspark.sql import DataFrame

    rows = [(i, f"{'nasty' if i % 4 == 0 else 'kind'} " + " ".join(f"w{(i * 7 + j) % 211}" for j in range(100)) + f" own{i}") for i in range(300)]
    docs = spark.createDataFrame([*rows, (300, rows[0][1]), (None, rows[1][1])], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(301)], "doc_id long, toxic int")
    got, to_arrow = [], DataFrame.toArrow
    monkeypatch.setattr(DataFrame, "toArrow", lambda self: got.append(to_arrow(self)) or got[-1])
    scorer = toxicity.fit(docs, labels, F.lit(True))
    assert not any({"counts", "text"} & set(table.column_names) for table in got)
    assert sum(table.nbytes for table in got) < 300 * 101 * 8 / 4
    assert scorer.index is None
    index = scorer.shared.value.index
    assert index.n.sum() == 300 and index.toxic.sum() == 75 and sorted(index.ids) == sorted(set(index.ids))
    by = {r.doc_id: r for r in toxicity.score_documents(docs, scorer).collect()}
    assert by[0].score == by[300].score and by[1].score == by[None].score and by[0].score > by[1].score

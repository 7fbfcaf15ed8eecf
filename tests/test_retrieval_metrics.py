import numpy as np
import pytest
from pyspark.sql import functions as F

from veilpost import fixed
from veilpost.operators import datasets as D
from veilpost.operators import kb as K
from veilpost.operators import metrics as M
from veilpost.operators import retrieve
from veilpost.operators.semantic import detect_with_gazetteer


def vectors(n, dims, seed):
    return np.random.default_rng(seed).integers(-3, 4, (n, dims)).astype("float64")


@pytest.mark.parametrize("max_rows", [2000, 4])
def test_nearest_is_exact_both_ways(spark, max_rows):
    """Small integers make ties; a limit of 4 rows forces the block way."""
    queries, centers = vectors(60, 5, 1), vectors(23, 5, 2)
    q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(queries)], "email_id int, vector array<float>")
    k = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(centers)], "id int, vector array<float>")
    got = {r.email_id: [(n.distance, n.id) for n in r.nearest] for r in retrieve.nearest(q, k, 3, max_rows=max_rows).collect()}
    for i, v in enumerate(queries):
        want = sorted((float(((v - c) ** 2).sum()), j) for j, c in enumerate(centers))[:3]
        assert got[i] == want


@pytest.mark.parametrize("max_rows", [2000, 3])
def test_gazetteer_both_ways(spark, max_rows):
    words = [(i, "NAME", w) for i, w in enumerate(["Ann", "Bob", "An", "zz", "B", "Carl", "Dora", "Eve", "nn"])]
    gazetteer = spark.createDataFrame(words, "item_no int, type string, value string")
    mails = {1: "Ann and Bob", 2: "nobody", 3: "Eve, Dora, Carl, Ann"}
    df = spark.createDataFrame(list(mails.items()), "email_id int, masked_email string")
    rows = detect_with_gazetteer(df, gazetteer, max_rows=max_rows).collect()
    assert len(rows) == 3
    for r in rows:
        assert [i.value for i in r.semantic_items] == [w for _, _, w in words if w in mails[r.email_id]]


@pytest.mark.parametrize("max_rows", [2000, 3])
def test_indicator_rank_both_ways(spark, max_rows):
    kb = K.custom_indicators(spark).withColumnRenamed("custom", "indicators")
    texts = {1: "Click here to verify your account, CEO overseas", 2: "nothing", 3: "enable macros. Tax audit. Lawsuit warning"}
    df = spark.createDataFrame(list(texts.items()), "email_id int, email_body string")
    for r in retrieve.rank_by_indicators(df, K.indicator_phrases(kb), 2, max_rows=max_rows).collect():
        low = texts[r.email_id].lower()
        hits = [(-sum(p.strip().lower() in low for p in v.split(",")), t) for t, v in fixed.CUSTOM_INDICATORS.items()]
        assert [(-t.hits, t.id) for t in r.techniques] == sorted(h for h in hits if h[0] < 0)[:2]


def test_small_tables_need_no_shuffle(spark):
    kb = K.indicator_phrases(K.custom_indicators(spark).withColumnRenamed("custom", "indicators"))
    df = spark.range(10).select(F.col("id").alias("email_id"), F.lit("click here").alias("email_body"))
    plan = retrieve.rank_by_indicators(df, kb)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_upsert(spark):
    a = spark.createDataFrame([("x", 1, "old"), ("y", 1, "keep")], "id string, version int, v string")
    b = spark.createDataFrame([("x", 2, "new"), ("z", 1, "add")], "id string, version int, v string")
    assert sorted(tuple(r) for r in K.upsert(a, b).collect()) == [("x", 2, "new"), ("y", 1, "keep"), ("z", 1, "add")]


def test_kb_build(spark):
    rows = [("T1566", "Phishing", "Email with a LINK", False), ("T1566.002", "Link", "x" * 600, False), ("T1566.001", "Old", "y", True), ("T9999", "Other", "z", False)]
    kb = {r.id: r for r in K.build_kb(spark.createDataFrame(rows, "id string, name string, description string, revoked boolean"), K.custom_indicators(spark)).collect()}
    assert set(kb) == {"T1566", "T1566.002"}
    assert kb["T1566"].indicators == "email, link" and len(kb["T1566.002"].description) == 500
    assert kb["T1566.002"].indicators == fixed.CUSTOM_INDICATORS["T1566.002"]


# --- metrics -------------------------------------------------------------------------------------

GOLDEN_TABLE = [(0.50, 7, 0, 0, 7), (0.87, 5, 0, 2, 7), (0.90, 3, 0, 4, 7)]


@pytest.mark.parametrize("alpha,tp,fp,fn,tn", GOLDEN_TABLE)
def test_golden_metrics(spark, alpha, tp, fp, fn, tn):
    row = M.metrics_at(D.golden_set(spark), alpha).first()
    assert (row.TP, row.FP, row.FN, row.TN) == (tp, fp, fn, tn)


def test_published_report_counts(spark):
    """27 / 27 / 3 / 3 give 0.9 throughout."""
    rows = [(True, "phishing")] * 27 + [(False, "benign")] * 27 + [(True, "benign")] * 3 + [(False, "phishing")] * 3
    report = M.quality(spark.createDataFrame(rows, "is_phishing boolean, true_label string")).first()
    assert (report.TP, report.TN, report.FP, report.FN) == (27, 27, 3, 3)
    for rate in ("precision", "recall", "f1_score", "accuracy"):
        assert report[rate] == pytest.approx(0.9)


def test_accuracy_counts_skipped_rows(spark):
    rows = [(True, "phishing"), (None, "phishing"), (False, "unknown")]
    report = M.quality(spark.createDataFrame(rows, "is_phishing boolean, true_label string")).first()
    assert (report.total, report.TP, report.accuracy) == (3, 1, pytest.approx(1 / 3))


def test_empty_metrics(spark):
    report = M.quality(spark.createDataFrame([], "is_phishing boolean, true_label string")).first()
    assert tuple(report) == (0, 0, 0, 0, 0, 0.0, 0.0, 0.0, 0.0)


def scored(spark):
    rng = np.random.default_rng(3)
    odd = [0.0, 1.0, 0.29, 0.57, 0.58, 1.2, -0.1, float("nan"), None]
    scores = list(np.round(rng.random(300), 3)) + [i / 100 for i in range(101)] + odd
    rows = [(int(rng.integers(0, 2)), None if s is None else float(s)) for s in scores]
    return rows, spark.createDataFrame(rows, "label int, predicted_score double")


def test_sweep_equals_single_thresholds(spark):
    rows, df = scored(spark)
    sweep = {round(r.alpha * 100): r for r in M.alpha_sweep(df).collect()}
    assert len(sweep) == 101
    for i in range(101):
        said = [s is not None and s >= i / 100 for _, s in rows]
        real = [label == 1 for label, _ in rows]
        want = [sum(p and r for p, r in zip(said, real)), sum(p and not r for p, r in zip(said, real))]
        assert [sweep[i].TP, sweep[i].FP] == want, i
        assert sweep[i].TP + sweep[i].FN == sum(real)


@pytest.mark.parametrize("ranges", [1, 3, 64])
def test_pr_curve(spark, ranges):
    rows, df = scored(spark)
    usable = [(label, s) for label, s in rows if s is not None and s == s]
    got = {r.threshold: r for r in M.pr_curve(df.where("not isnan(predicted_score)"), ranges=ranges).collect()}
    positives = sum(label for label, _ in usable)
    assert set(got) == {s for _, s in usable} | {None}
    assert (got[None].precision, got[None].recall) == (1.0, 0.0)
    for s in set(got) - {None}:
        above = [label for label, x in usable if x >= s]
        assert got[s].precision == sum(above) / len(above) and got[s].recall == sum(above) / positives
    falling = sorted((k for k in got if k is not None), reverse=True)
    assert all(got[a].recall <= got[b].recall for a, b in zip(falling, falling[1:]))


def test_confusion_cells_are_complete(spark):
    df = spark.createDataFrame([(1, 1)], "label int, predicted int")
    assert sorted(tuple(r) for r in M.confusion_cells(df).collect()) == [(0, 0, 0), (0, 1, 0), (1, 0, 0), (1, 1, 1)]


# --- data sets -----------------------------------------------------------------------------------


def test_sample_and_split(spark):
    kind = F.when(F.col("id") % 3 == 0, F.lit(fixed.CLASS_PHISHING)).otherwise(F.lit(fixed.CLASS_BENIGN))
    df = spark.range(600).select(F.col("id").alias("email_id"), kind.alias("email_type"), F.col("id").cast("string").alias("email_text"))
    sample = D.sample_per_class(df)
    assert {r.email_type: r["count"] for r in sample.groupBy("email_type").count().collect()} == {fixed.CLASS_PHISHING: 50, fixed.CLASS_BENIGN: 50}
    few, test = D.build_fewshot(sample), D.build_test_set(sample)
    assert (few.count(), test.count()) == (40, 60)
    assert few.join(test, "email_id").count() == 0
    again = D.sample_per_class(df.repartition(7))
    assert sorted(sample.collect()) == sorted(again.collect())


def test_sample_cuts_before_the_shuffle(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.col("doc_id").alias("email_id"), F.col("source").alias("email_type"), F.col("text").alias("email_text")
    )
    plan = D.sample_per_class(df, classes=("src1", "src2"))._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_stage_log_order(spark):
    log = [("C", "complete"), ("A", "complete"), ("B", "complete"), ("A", "running"), ("X", "running"), ("B", "odd"), ("B", "skipped")]
    got = [(r.stage, r.status) for r in D.order_stage_log(spark.createDataFrame(log, "stage string, status string")).collect()]
    assert got == [("B", "skipped"), ("B", "complete"), ("B", "odd"), ("A", "running"), ("A", "complete"), ("C", "complete"), ("X", "running")]


def test_golden_set(spark):
    rows = D.golden_set(spark).collect()
    assert [r.id for r in rows] == list(range(1, 15)) and sum(r.label for r in rows) == 7

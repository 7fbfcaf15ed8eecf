"""Stored knowledge bases and stored metric counts that later runs add to."""

import pytest
from pyspark.sql import functions as F

from veilpost.operators import metrics
from veilpost.operators.kb_store import KbStore

SCHEMA = "id string, version int, payload string"


@pytest.fixture()
def store(spark, tmp_path):
    return KbStore(spark, str(tmp_path / "kb"), spark.createDataFrame([], SCHEMA).schema, buckets=4)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_rounds_keep_the_highest_version(spark, store):
    assert store.read().count() == 0 and store.upsert(store.read()) == 0
    first = [(f"k{i}", 1, "a") for i in range(20)] + [(None, 1, "n")]
    assert store.upsert(spark.createDataFrame(first, SCHEMA)) == 1
    before = store.manifest()
    # One key newer, one older, one equal, one repeated, one of no key.
    second = [("k1", 2, "b"), ("k2", 0, "b"), ("k3", 1, "b"), ("k1", 3, "c"), (None, 2, "m")]
    assert store.upsert(spark.createDataFrame(second, SCHEMA)) == 2
    want = {i: (1, "a") for i, _, _ in first} | {"k1": (3, "c"), "k3": (1, "b"), None: (2, "m")}
    assert {r.id: (r.version, r.payload) for r in store.read().collect()} == want
    after = store.manifest()
    bucket = F.pmod(F.xxhash64("id"), F.lit(4)).cast("int")
    touched = {r.b for r in spark.createDataFrame(second, SCHEMA).select(bucket.alias("b")).distinct().collect()}
    assert all((before[b] == after[b]) == (b not in touched) for b in before)


def test_a_round_that_fails_changes_nothing(spark, store):
    store.upsert(spark.createDataFrame([("a", 1, "x"), ("b", 1, "x")], SCHEMA))
    kept = rows(store.read())
    broken = spark.createDataFrame([("a", 5, "y")], SCHEMA).withColumn("payload", F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(Exception, match="stop"):
        store.upsert(broken)
    # A manifest whose round did not end: no marker.
    left = spark.createDataFrame([(0, "nowhere")], "bucket int, folder string")
    left.coalesce(1).write.json(f"{store.path}/manifests/2")
    fs, path = store._fs()
    fs.delete(path(f"{store.path}/manifests/2/_SUCCESS"), False)
    assert rows(store.read()) == kept and store.rounds() == [1]
    assert store.upsert(spark.createDataFrame([("a", 5, "y")], SCHEMA)) == 2
    assert rows(store.read()) == [("a", 5, "y"), ("b", 1, "x")]


def test_merged_counts_give_the_same_metrics(spark):
    scores = [None, float("nan"), -0.1, 0.0, 0.29, 0.3, 0.3, 0.5, 0.87, 1.0, 1.5]
    data = [(i, (0, 1, None)[i % 3], scores[i % len(scores)]) for i in range(60)]
    df = spark.createDataFrame(data, "id int, label int, predicted_score double")
    parts = [metrics.score_counts(df.where(F.col("id") % 3 == i)) for i in range(3)]
    merged = metrics.merge_counts(*parts)
    assert merged.agg(F.sum("n")).first()[0] == 60
    assert rows(metrics.alpha_sweep_from(merged)) == rows(metrics.alpha_sweep(df))
    assert rows(metrics.pr_curve_from(merged)) == rows(metrics.pr_curve(df))

"""Replies that are typed loosely, plug-ins that fail on single mails, ties and NaN."""

import pytest
from pyspark.sql import functions as F

from veilpost.operators import kb, metrics, score, semantic
from veilpost.session import ship_package

REPLIES = [
    ('{"is_phishing": "true", "risk_score": "0.95", "high_risk_tokens": "wire"}', (True, 0.95, ["wire"], None)),
    ('{"is_phishing": 1, "risk_score": 0.5, "high_risk_tokens": ["a", "b"]}', (True, 0.5, ["a", "b"], None)),
    ('{"is_phishing": "False", "risk_score": 3}', (False, 3.0, None, None)),
    ('{"is_phishing": false, "risk_score": 0.1, "high_risk_tokens": []}', (False, 0.1, [], None)),
    ('{"is_phishing": "maybe", "risk_score": 0.9}', (None, 0.0, [], "error")),
    ('{"is_phishing": true, "risk_score": "high"}', (None, 0.0, [], "error")),
]


def test_loose_replies(spark):
    rows = spark.createDataFrame([(i, r) for i, (r, _) in enumerate(REPLIES)], "i int, reply string")
    got = rows.select("i", score.parse_reply(F.col("reply")).alias("p")).orderBy("i").collect()
    for row, (_, (flag, risk, tokens, error)) in zip(got, REPLIES):
        verdict = row.p.verdict
        assert (verdict.is_phishing, verdict.risk_score, verdict.high_risk_tokens) == (flag, risk, tokens)
        assert (row.p.error is None) == (error is None)


def test_stray_list_elements(spark):
    texts = ['["stray", {"type":"NAME","value":"Bob"}]', '[1, {"type":"NAME","value":"Bob"}, null, [2]]']
    rows = spark.createDataFrame([(t,) for t in texts], "reply string")
    for row in rows.select(semantic.parse_item_list(F.col("reply")).alias("items")).collect():
        assert [(i.type, i.value) for i in row["items"]] == [("NAME", "Bob")]


@pytest.mark.parametrize("batch", ["1", "10000"])
def test_one_failing_mail(spark, batch):
    ship_package(spark)

    def detector(texts):
        if texts.str.contains("bad").any():
            raise RuntimeError("cannot read")
        return texts.map(lambda t: '[{"type": "NAME", "value": "Bob"}]')

    mails = spark.createDataFrame([(i, "bad" if i == 4 else "ok") for i in range(10)], "i int, t string").coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        found = semantic.detect_with_model(mails, detector, "t", error_out="failed").orderBy("i").collect()
        scored = score.score_with_model(mails, detector, "t").where("model.error is not null and model.error <> ''")
        assert [len(r.semantic_items) for r in found] == [1, 1, 1, 1, 0, 1, 1, 1, 1, 1]
        assert [r.failed for r in found if r.failed] == ["cannot read"]
        assert "cannot read" in [r.model.error for r in scored.collect()]
        plan = scored._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_incoming_row_wins_a_tie(spark):
    schema = "id string, version int, text string"
    current = spark.createDataFrame([("k", 1, "old"), ("m", 2, "old")], schema)
    incoming = spark.createDataFrame([("k", 1, "new"), ("m", 1, "new")], schema)
    got = {r.id: r.text for r in kb.upsert(current, incoming).collect()}
    assert got == {"k": "new", "m": "old"}


def test_nan_reaches_no_threshold(spark):
    rows = spark.createDataFrame([(1, 0.9), (1, float("nan")), (0, 0.2), (1, None)], "label int, predicted_score double")
    thresholds = [r.threshold for r in metrics.pr_curve(rows).collect()]
    assert sorted(t for t in thresholds if t is not None) == [0.2, 0.9]

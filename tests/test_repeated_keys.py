"""Repeated rows in a joined table leave the number of mails as it is."""

from veilpost.operators import datasets, score
from veilpost.operators.latest import latest
from veilpost.plans import screening as S

STORED = (
    "email_id int, email_body string, sender_domain string, is_phishing boolean, risk_score string, "
    "mitre_technique string, why_malicious_context string, high_risk_tokens array<string>, run int"
)


def test_latest_record(spark):
    rows = [(1, 2, "b"), (1, None, "z"), (1, 1, "c"), (2, None, "x"), (2, None, "y"), (None, 1, "n"), (None, 2, "m"), (3, 1, None), (3, 1, None)]
    df = spark.createDataFrame(rows, "k int, run int, v string").repartition(3)
    got = {r.k: (r.run, r.v) for r in latest(df, "k", "run").collect()}
    assert got[1] == (2, "b") and got[None] == (2, "m") and got[3] == (1, None) and got[2][1] in ("x", "y")
    assert latest(df, "k", "run").columns == ["k", "run", "v"]
    assert latest(df.repartition(1), "k", "run").where("k = 2").first().v == got[2][1]
    assert latest(df.select("k"), "k").count() == 4 and latest(df.where("false"), "k").count() == 0


def test_stored_verdicts_of_one_mail(spark):
    mails = spark.createDataFrame([(1, "agenda"), (2, "minutes")], "email_id int, raw_email string")
    rows = [(1, "agenda", "corp", False, "0.1", "none", f"run {run}", [], run) for run in (1, 3, 2, 3)]
    got = S.screen_with_stored(mails, spark.createDataFrame(rows, STORED), version="run").collect()
    assert sorted(r.email_id for r in got) == [1, 2]
    assert [r.verdict.why_malicious_context for r in got if r.email_id == 1] == ["run 3"]
    assert len(S.screen_with_stored(mails, spark.createDataFrame(rows, STORED)).collect()) == 2


def test_scores_of_one_record(spark):
    records = spark.createDataFrame([(1,), (1,), (2,)], "id int")
    scores = spark.createDataFrame([(1, 0.2, 1), (1, 0.9, 2), (1, 0.9, 2), (1, 0.4, None)], "id int, risk_score double, run int")
    got = sorted((r.id, r.predicted_score) for r in score.attach_scores(records, scores, "id", version="run").collect())
    assert got == [(1, 0.9), (1, 0.9), (2, 0.0)]


def test_samples_of_repeated_keys(spark):
    p, b = "Phishing Email", "Safe Email"
    rows = [(1, "a", p), (1, "b", p), (2, "c", p), (3, "d", b), (3, "e", p), (4, "f", b), (4, "f", b)]
    df = spark.createDataFrame(rows, "email_id int, email_text string, email_type string")
    kinds = (p, b)
    whole = datasets.sample_per_class(df, 10, kinds).collect()
    assert sorted(r.email_id for r in whole) == [1, 2, 3, 4]
    assert {r.email_id: r.email_type for r in whole}[3] == max(p, b)
    for kind in kinds:
        ranks = sorted(r.sample_rank for r in whole if r.email_type == kind)
        assert ranks == list(range(1, len(ranks) + 1))
    assert len(datasets.sample_per_class(df, 1, kinds).collect()) == 2

import json

import pytest
from pyspark.sql import functions as F

from veilpost import fixed
from veilpost.operators import score
from veilpost.operators.audit import audit, perturb, token_spans
from veilpost.operators.semantic import mask_items, parse_item_list
from veilpost.plans.screening import screen

FULL = {"is_phishing": True, "risk_score": 0.9, "mitre_technique": "T1", "why_malicious_context": "w", "high_risk_tokens": ["a"]}


def plain_rule(text):
    low, total, tokens = text.lower(), 0.0, []
    for phrase, weight in fixed.SIGNALS:
        if phrase in low:
            total += weight
            tokens.append(phrase)
    total = min(max(total, 0.0), 0.96)
    return total, total >= 0.55, tokens[:8]


def test_every_phrase_subset_scores_alike(spark):
    """All 65,536 subsets: the double sum in table order decides the cut."""
    n = len(fixed.SIGNALS)
    phrases = F.array(*[F.when(F.col("id").bitwiseAND(1 << i) > 0, F.lit(p)) for i, (p, _) in enumerate(fixed.SIGNALS)])
    df = spark.range(1 << n).select("id", F.array_join(phrases, " | ").alias("text"))
    rows = score.rule_verdict(df, "text").select("id", "text", "rule.*").collect()
    for r in rows:
        assert (r.risk_score, r.is_phishing, r.high_risk_tokens) == plain_rule(r.text)


def test_normalize_score(spark):
    values = ["7", "0.9", "x", None, "-1", "15", "NaN", "Infinity"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(score.normalize_score(F.col("v"))).collect()]
    assert got == [0.7, 0.9, 0.0, 0.0, 0.0, 1.0, 0.0, 1.0]


REPLIES = [
    (json.dumps(FULL), True, None),
    ("```json\n" + json.dumps(FULL) + "\n```", True, None),
    ("Sure: " + json.dumps(FULL) + " done", True, None),
    ('{"is_phishing": false}', False, None),
    ("[1, 2]", None, "parse_failed"),
    ("no json", None, "parse_failed"),
    ("{broken", None, "parse_failed"),
    ("", None, "parse_failed"),
    (None, None, "parse_failed"),
]


@pytest.mark.parametrize("reply,phishing,error", REPLIES)
def test_parse_reply(spark, reply, phishing, error):
    row = spark.createDataFrame([(reply,)], "r string").select(score.parse_reply(F.col("r")).alias("p")).first().p
    assert (row.verdict.is_phishing, row.error) == (phishing, error)


LISTS = [
    ('[{"type": "NAME", "value": "Ann"}]', [("NAME", "Ann")]),
    ('text [{"type": "NAME", "value": "Ann"}] text', [("NAME", "Ann")]),
    ('{"a": 1}', []),
    ('{"a": [{"type": "NAME", "value": "Ann"}]}', []),
    ("] [", []),
    ("none", []),
    (None, []),
]


@pytest.mark.parametrize("reply,items", LISTS)
def test_parse_item_list(spark, reply, items):
    got = spark.createDataFrame([(reply,)], "r string").select(parse_item_list(F.col("r"))).first()[0]
    assert [(i.type, i.value) for i in got] == items


def test_semantic_mask(spark):
    text = "Project Falcon and Falcon by Ann, EMAIL [MASKED_EMAIL]"
    items = [("project", " Falcon "), ("PROJECT", "Project Falcon"), ("NAME", "Bob"), ("X", "EMAIL"), ("", "Ann"), ("NAME", "Ann"), ("NAME", "Ann")]
    df = spark.createDataFrame([(text, items, [])], "masked_email string, semantic_items array<struct<type:string,value:string>>, detected_pii array<struct<type:string,method:string,count:int,masked_as:string>>")
    row = mask_items(df).first()

    masked, found = text, []
    usable = [(t.upper().strip(), v.strip()) for t, v in items if t and v and v.strip() in text]
    for t, v in sorted(usable, key=lambda x: len(x[1]), reverse=True):
        found.append((t, masked.count(v)))
        masked = masked.replace(v, f"[MASKED_{t}]")
    assert row.masked_email == masked
    assert [(f.type, f["count"]) for f in row.detected_pii] == found


def audited(spark, phishing, risk, tokens, text):
    df = spark.createDataFrame(
        [((phishing, risk, tokens), text)],
        "verdict struct<is_phishing:boolean,risk_score:double,high_risk_tokens:array<string>>, analysis_text string",
    )
    return audit(df).first().audit


def test_audit_statuses(spark):
    assert audited(spark, False, 0.9, ["a"], "a").status == "skipped_benign"
    assert audited(spark, None, 0.9, ["a"], "a").status == "skipped_benign"
    assert audited(spark, True, 0.9, [" "], "a").status == "skipped_no_tokens"
    assert audited(spark, True, 0.9, ["zz"], "a").status == "skipped_tokens_absent"
    assert audited(spark, True, 0.9, ["a"], "a").status == "passed"
    assert audited(spark, True, 0.55, ["a"], "a").status == "failed"


def test_token_present_but_not_replaced(spark):
    row = audited(spark, True, 0.9, ["URGENT"], "urgent")
    assert row.tokens_in_text == ["URGENT"] and row.necessity.perturbed_text == "urgent"


def test_perturb_in_list_order(spark):
    df = spark.createDataFrame([("pay REMOVED pay", ["pay", "REMOVED"])], "t string, k array<string>")
    got = df.select(perturb(F.col("t"), F.col("k"))).first()[0]
    want = "pay REMOVED pay"
    for token in ["pay", "REMOVED"]:
        want = want.replace(token, "[REMOVED]")
    assert got == want


def test_spans(spark):
    df = spark.createDataFrame([(1, "Pay (now), PAY (Now)", ["pay", "(now)"])], "email_id int, t string, k array<string>")
    got = sorted((r.token, r.start, r["len"]) for r in token_spans(df, "t", "k").collect())
    assert got == [("(now)", 5, 5), ("(now)", 16, 5), ("pay", 1, 3), ("pay", 12, 3)]


def test_screen_sees_masked_text_only(spark):
    df = spark.createDataFrame([(1, "From: a@b.com\nSubject: hi\nwrite to c@d.org")], "email_id long, raw_email string")
    row = screen(df).first()
    assert "@" not in row.analysis_text and row.verdict.raw_email.startswith("From: a@b.com")
    assert row.verdict.sender_domain == "not_extracted"
    assert screen(df, keep_envelope_domain=True).first().verdict.sender_domain == "b.com"


def test_failing_plug_in_falls_back_to_rule(spark):
    def broken(prompts):
        raise RuntimeError("down")

    df = spark.createDataFrame([(1, "past due wire transfer, verify credentials, account will be disabled, click")], "email_id long, raw_email string")
    done = screen(df, score=lambda d: score.score_with_model(d.withColumn("prompt", F.col("masked_email")), broken)).first()
    assert done.verdict.verdict_source == "heuristic_fallback" and done.verdict.gemini_error == "down"
    assert done.verdict.is_phishing

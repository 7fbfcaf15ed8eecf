"""Lookups give one answer whatever the size of the table; no mail gets lost on the way."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from veilpost import fixed
from veilpost.operators import pii, retrieve, semantic
from veilpost.plans import screening as S

MAIL = "email_id bigint, vector array<float>"


@pytest.fixture(scope="module")
def vectors(spark):
    made = np.random.default_rng(3).normal(size=(60, 4)).astype("float32").tolist()
    rows = list(enumerate(made))
    rows += [(7, made[1]), (None, made[2]), (None, made[3]), (90, None), (91, [1.0, None, 2.0, 3.0]), (92, [1.0]), (93, [])]
    kb = [(i, v) for i, v in enumerate(made[:22])] + [(30, None), (31, [0.5]), (32, [1.0, None, 0.0, 0.0])]
    return spark.createDataFrame(rows, MAIL), spark.createDataFrame(kb, "id int, vector array<float>")


def test_nearest_does_not_depend_on_the_size(vectors):
    mails, kb = vectors

    def answers(max_rows):
        found = retrieve.nearest(mails, kb, 3, max_rows=max_rows).collect()
        return sorted(repr((r.email_id, r.vector, [tuple(n) for n in r.nearest])) for r in found)

    small, blocks = answers(2000), answers(1)
    assert small == blocks
    assert len(small) == mails.count()
    by_id = {r.email_id: r.nearest for r in retrieve.nearest(mails, kb, 3).where("email_id >= 8").collect()}
    assert by_id[8][0] == (0.0, 8)
    assert by_id[90] == by_id[91] == by_id[93] == []
    assert [n.id for n in by_id[92]] == [31]


def test_carried_columns_come_with_the_neighbour(vectors):
    mails, kb = vectors
    named = kb.withColumn("name", F.concat(F.lit("n"), F.col("id")))
    for max_rows in (2000, 1):
        rows = retrieve.nearest(mails, named, 2, max_rows=max_rows, carry=["name"]).collect()
        assert all(n.name == f"n{n.id}" for r in rows for n in r.nearest)


def test_gazetteer_rows_of_one_key_keep_their_own_items(spark):
    mails = spark.createDataFrame([(1, "Ann is here"), (1, "Bob is here"), (2, None), (3, "")], "email_id int, masked_email string")
    names = spark.createDataFrame([(1, "NAME", "Ann"), (2, "NAME", "Bob"), (3, "NAME", "Cy")], "item_no int, type string, value string")
    for max_rows in (2000, 1):
        rows = semantic.detect_with_gazetteer(mails, names, max_rows=max_rows).collect()
        got = sorted((r.email_id, r.masked_email or "", [i.value for i in r.semantic_items or []]) for r in rows)
        assert got == [(1, "Ann is here", ["Ann"]), (1, "Bob is here", ["Bob"]), (2, "", []), (3, "", [])]


def test_residual_check_with_and_without_what_masking_saw(spark):
    texts = [
        None, "", "plain words", "a@b.example", "call 0912-345-678 or write x@y.example", "GB82WEST12345698765432",
        "4111-1111-1111-1111 DEUTDEFF500", "id A123456789 host 10.0.0.1", "0x52908400098527886E0F7030069857D2E4169EE7",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "email_id int, raw_email string")
    masked = pii.mask_structured(df, scan="seen")
    # Later steps may put something back that an earlier type matches.
    changed = masked.withColumn(
        "masked_email", F.when(F.col("email_id") % 2 == 0, F.concat("masked_email", F.lit(" z@z.example"))).otherwise(F.col("masked_email"))
    )
    for frame in (masked, changed):
        plain = pii.residual_check(frame).select("email_id", "remaining_pii", "final_check_status").collect()
        saved = pii.residual_check(frame, scan="seen").select("email_id", "remaining_pii", "final_check_status").collect()
        assert plain == saved
    assert pii.residual_check(changed, scan="seen").where("final_check_status = 'FAIL'").count() == 4


def test_no_mail_is_lost_without_a_stored_result(spark):
    mails = spark.createDataFrame([(1, "urgent wire transfer"), (2, "agenda")], "email_id int, raw_email string")
    stored = spark.createDataFrame(
        [(2, "agenda", "corp", False, "0.1", "none", "fine", [])],
        "email_id int, email_body string, sender_domain string, is_phishing boolean, risk_score string, "
        "mitre_technique string, why_malicious_context string, high_risk_tokens array<string>",
    )
    rows = {r.email_id: r.verdict for r in S.screen_with_stored(mails, stored).collect()}
    assert rows[1].gemini_error == S.NO_STORED_VERDICT and rows[1].verdict_source == fixed.SOURCE_RULE
    assert rows[2].gemini_error is None and rows[2].risk_score == 0.1

    private = pii.normalize_privacy(S.redact(mails.where("email_id = 1")), "s").select("email_id", "privacy")
    judged = spark.createDataFrame([(2, ("agenda",))], "email_id int, verdict struct<email_body:string>")
    both = {r.email_id: r for r in S.integrate(private, judged).collect()}
    assert both[1].verdict is None and both[1].analysis_text == "urgent wire transfer"
    assert both[2].privacy.final_check_status == fixed.STATUS_FAIL and both[2].analysis_text == "agenda"

"""Masking against Python's `re` on the plain patterns: edge strings and random text."""

import random
import re

import pytest
from pyspark.sql import functions as F

from veilpost import fixed
from veilpost.operators import pii
from veilpost.plans.screening import redact, screen

EDGES = [
    "電話0912345678。",
    "身分證A123456789號",
    "0912 345 678",
    "https://a.b/c　x",
    "at 12:30:09",
    "SECURITY PASSWORD HELLO",
    "ABCDEFGHhttps://x",
    "a@b.com+x@y.com, é.bar@x.com éfoo@bar.com foo@b.c_d foo@b.com- é@x.com",
    "éabc@example.org ²abc@example.org ‿abc@example.org",
    "１２３４ １２３４ １２３４ １２３４ and ４111-1111-1111-1111",
    "IBAN GB82WEST12345698765432x GB82WEST12345698765432",
    "xA123456789 A123456789x _A123456789_ A1234567890",
    "1.2.3.4.5 999.1.1.1 x1.2.3.4 1.2.3.4x",
    "2001:0db8:85a3:0000:0000:8a2e:0370:7334:1 dead:beef:1:2 xab:cd:ef",
    "0x52908400098527886E0F7030069857D2E4169EE7 x0x52908400098527886E0F7030069857D2E4169EE7",
    "1BoatSLRHtKNngkdXEeobR76b53LETtpyT 11BoatSLRHtKNngkdXEeobR76b53LETtpyT",
    "DEUTDEFF DEUTDEFF500 DEUTDEFF5 ÄDEUTDEFF",
    "a\x1cb 0912\x1c345\x1c678",
    "",
]
ALPHABET = list("aZ09AB12 .-_@:/+()[]é²Ä́ \n\t") + [
    "09", "0x", "https://", "DEUTDEFF", "1.2", "@b.c", "4111", "A1", "GB82WEST1234", "ab:cd", "12345678",
]


def random_texts(n: int) -> list[str]:
    pick = random.Random(7)
    return ["".join(pick.choices(ALPHABET, k=pick.randint(5, 60))) for _ in range(n)]


def expected(text: str):
    found, masked = [], text
    for t in fixed.MASKING_ORDER:
        masked, n = re.subn(fixed.PII_PATTERNS[t], f"[MASKED_{t}]", masked)
        if n:
            found.append((t, n))
    left = [(t, len(list(re.finditer(p, masked)))) for t, p in fixed.PII_PATTERNS.items()]
    return masked, found, [r for r in left if r[1]]


def test_masking_agrees_with_plain_patterns(spark):
    texts = EDGES + random_texts(3000)
    df = spark.createDataFrame(list(enumerate(texts)), "email_id int, raw_email string").repartition(4)
    rows = {r.email_id: r for r in redact(df).collect()}
    for i, text in enumerate(texts):
        masked, found, left = expected(text)
        assert rows[i].masked_email == masked, text
        assert [(f.type, f["count"]) for f in rows[i].detected_pii] == found, text
        assert [(r.type, r["count"]) for r in rows[i].remaining_pii] == left, text
        assert rows[i].final_check_status == ("FAIL" if left else "PASS")


@pytest.mark.parametrize("pii_type", fixed.PII_PATTERNS)
def test_each_type_alone(spark, pii_type):
    texts = EDGES + random_texts(1500)
    df = spark.createDataFrame(list(enumerate(texts)), "email_id int, raw_email string")
    rows = pii.mask_type(df, pii_type, "raw_email", "masked", "n").collect()
    for row in rows:
        want = re.subn(fixed.PII_PATTERNS[pii_type], f"[MASKED_{pii_type}]", row.raw_email)
        assert (row.masked, row.n) == want, row.raw_email


def test_mask_may_create_a_match(spark):
    df = spark.createDataFrame([(1, "ABCDEFGHhttps://x")], "email_id int, raw_email string")
    row = redact(df).first()
    assert row.masked_email == "ABCDEFGH[MASKED_URL]"
    assert row.final_check_status == "FAIL"


def test_second_pass_changes_nothing_on_pass_rows(spark):
    df = spark.createDataFrame(list(enumerate(random_texts(500))), "email_id int, raw_email string")
    once = redact(df).where("final_check_status = 'PASS'").select("email_id", "masked_email")
    again = pii.mask_structured(once, "masked_email", "twice", "found")
    assert again.where(F.col("twice") != F.col("masked_email")).count() == 0


def copies(df, name: str) -> int:
    return df._jdf.queryExecution().optimizedPlan().toString().count(name + "(")


def test_filter_on_result_does_not_repeat_the_chain(spark):
    """Without a barrier the pushed filter would hold thousands of copies of the patterns."""
    df = spark.createDataFrame([(1, "x")], "email_id int, raw_email string")
    filtered = pii.mask_structured(df).where("size(detected_pii) > 0 and masked_email like '%a%'")
    assert copies(filtered, "regexp_replace") == copies(filtered, "regexp_extract_all") == len(fixed.MASKING_ORDER)


def test_filters_on_screening_results_evaluate_each_text_once(spark):
    df = spark.createDataFrame([(1, "x")], "email_id int, raw_email string")
    whole = screen(df)
    filtered = whole.where(
        "privacy.final_check_status = 'FAIL' and verdict.is_phishing and audit.status = 'failed' and email_id > 0"
    )
    assert copies(filtered, "regexp_extract_all") == copies(whole, "regexp_extract_all") == 2 * len(fixed.PII_PATTERNS)
    assert copies(filtered, "lower") == copies(whole, "lower")
    assert "Exchange" not in filtered._jdf.queryExecution().executedPlan().toString()


def test_null_text(spark):
    df = spark.createDataFrame([(1, None)], "email_id int, raw_email string")
    row = redact(df).first()
    assert row.masked_email is None and row.detected_pii == []


def test_coverage_of_nothing(spark):
    df = spark.createDataFrame([], "a string, b string")
    assert tuple(pii.coverage(df, "a", "b").first()) == (0, 0, 0, 0.0)

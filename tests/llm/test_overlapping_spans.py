"""Nothing of any span is left in a masked text, also where spans overlap."""

import random

from pyspark.sql import functions as F

from veilpost.llm import personal_data
from veilpost.operators.stage import computed_once

PARTS = [
    "1.2.3.4", "4111 1111 1111 1111", "+1 555 123 4567", "me@x.org", "@x.org", "10.0.0.1", "(555) 123-4567", "4567",
    "Mr. Ann Bell", 'token = "0123456789abcdef"', "word", "é", "日本",
]


def texts():
    r = random.Random(9)
    mixed = ["".join(r.choice(PARTS) + r.choice([" ", " ", "", "-", ".", "\n"]) for _ in range(r.randrange(1, 9))) for _ in range(400)]
    return ["host 1.2.3.4 111 1111 1111 1111 end", "call +1 555 123 4567@x.org", *mixed]


def test_no_part_of_a_span_is_left(spark):
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = computed_once(personal_data.with_candidates(docs), spans=personal_data.spans(personal_data.fit(personal_data.with_candidates(docs))))
    found = found.select("text", personal_data.masked(F.col("text"), F.col("spans")).alias("masked"), F.transform("spans", lambda s: F.struct(s["start"], s["end"], s["kind"])).alias("spans"))
    overlaps = 0
    for row in found.collect():
        want, at = [], 0
        for i, (start, end, kind) in enumerate(sorted(row["spans"], key=lambda s: s[0])):
            if start >= at:
                want += [row["text"][at:start], f"[{kind.upper()}]"]
            overlaps += start < at
            at = max(at, end)
        assert row["masked"] == "".join(want) + row["text"][at:]
    assert overlaps > 5


def test_the_known_leaks_are_closed(spark):
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = personal_data.fit(personal_data.with_candidates(docs))
    got = {r["doc_id"]: r["text"] for r in personal_data.mask_documents(docs, model).where("doc_id < 2").collect()}
    assert "1111" not in got[0] and "@x.org" not in got[1]

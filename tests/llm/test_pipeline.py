"""The pipeline end to end: stages keep the columns of documents, and their decisions take effect."""

import corpus_pipeline
from .conftest import OTHER
from veilpost.llm.queries import QUERIES


def test_names():
    assert sorted(n.split("_")[0] for n in QUERIES) == sorted(f"op{i}" for i in range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "repeated_passages", "personal_data", "packing"]


def test_stages(spark, sf_dir, table):
    docs = table.where("doc_id IS NULL OR doc_id < 30 OR doc_id > 9000")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, sf_dir)
        assert after.dtypes == docs.dtypes, name
        before, docs = docs, spark.createDataFrame(after.collect(), after.schema)
        if name == "near_duplicates":
            ids = [r.doc_id for r in docs.collect()]
            assert 9007 in ids and 9008 not in ids and 9009 not in ids and 9001 in ids
        if name == "repeated_passages":
            text = {r.doc_id: r.text for r in docs.collect()}
            assert text[9011] == "z" + OTHER and text[9010].startswith("x pass0")
        if name == "personal_data":
            assert "[EMAIL]" in docs.where("doc_id = 9013").first().text
        assert docs.count() <= before.count()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() >= docs.count()

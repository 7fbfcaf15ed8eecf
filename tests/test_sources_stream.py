import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from contract.queries import QUERIES
from veilpost.operators.datasets import pending
from veilpost.plans.screening import screen
from veilpost.sources import readers, writers
from veilpost.streaming.incremental import mail_stream, screen_available


def test_array_file_and_missing_file(spark, tmp_path):
    path = tmp_path / "mails.json"
    path.write_text(json.dumps([{"raw_email": "x\ny", "true_label": "phishing"}, {"raw_email": "緊急", "true_label": "benign"}]), "utf-8")
    assert sorted(r.raw_email for r in readers.read_labelled_mails(spark, str(path)).collect()) == ["x\ny", "緊急"]
    with pytest.raises(AnalysisException):
        readers.read_techniques(spark, str(tmp_path / "missing.json"))


def test_json_sink_keeps_text_and_nulls(spark, tmp_path):
    df = spark.createDataFrame([(1, "緊急\n\"q\"", None, ["a", "b"])], "id int, t string, n string, k array<string>")
    writers.write_json(df, str(tmp_path / "out"))
    text = "".join(p.read_text("utf-8") for p in (tmp_path / "out").glob("*.json"))
    assert "緊急" in text and '"n":null' in text
    assert spark.read.schema(df.schema).json(str(tmp_path / "out")).collect() == df.collect()


def test_csv_sink_survives_line_breaks(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b",\nc', [("x", 1)])], "id int, t string, k array<struct<n:string,v:int>>")
    writers.write_csv(df, str(tmp_path / "out"))
    back = spark.read.option("multiLine", True).csv(str(tmp_path / "out"), header=True, escape='"').first()
    assert back.t == 'a "b",\nc' and json.loads(back.k) == [{"n": "x", "v": 1}]


def test_report_sink(spark, tmp_path):
    df = spark.createDataFrame([(1, True, "benign"), (2, True, "phishing")], "email_id int, is_phishing boolean, true_label string")
    writers.write_report(df, str(tmp_path))
    assert spark.read.json(str(tmp_path / "report")).first().precision == 0.5
    assert spark.read.json(str(tmp_path / "errors")).first().type == "FP"


def test_bucketed_tables_join_without_a_shuffle(spark):
    mails = spark.range(200).select(F.col("id").alias("email_id"), F.lit("text").alias("raw_email"))
    writers.save_bucketed(mails, "mails_b", buckets=4)
    writers.save_bucketed(mails.where("email_id < 50").select("email_id"), "done_b", buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = pending(spark.table("mails_b"), spark.table("done_b"))
        assert "Exchange" not in left._jdf.queryExecution().executedPlan().toString()
        assert left.count() == 150
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_stream_takes_up_where_it_stopped(spark, sf_dir, tmp_path):
    """New files only on the second run; both runs together equal the batch result."""
    source = tmp_path / "in"
    mails = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").alias("email_id"), F.col("text").alias("raw_email"))
    first, second = mails.where("email_id % 2 = 0"), mails.where("email_id % 2 = 1")

    def run():
        stream = mail_stream(spark, str(source), mails.schema)
        screen_available(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
        return spark.read.parquet(str(tmp_path / "out"))

    first.write.mode("append").parquet(str(source))
    assert run().count() == first.count()
    assert run().count() == first.count()
    second.write.mode("append").parquet(str(source))
    pick = ["email_id", "privacy.masked_email", "verdict.risk_score", "audit.status"]
    assert sorted(run().select(*pick).collect()) == sorted(screen(mails).select(*pick).collect())


def test_screen_stream_reads_a_table_of_part_files(spark, tmp_path):
    rows = [(i, f"Subject: a{i}\n\nwrite to a{i}@b.example", "en", "web", 9) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(str(tmp_path / "parts" / "documents.parquet"))
    docs.coalesce(1).write.parquet(str(tmp_path / "one"))
    (tmp_path / "file").mkdir()
    next((tmp_path / "one").glob("part-*.parquet")).rename(tmp_path / "file" / "documents.parquet")
    got = [sorted(QUERIES["screen_stream"](spark, str(tmp_path / d)).select("email_id", "masked_email").collect()) for d in ("parts", "file")]
    assert got[0] == got[1] and [r.email_id for r in got[0]] == list(range(6))

"""Array files read in several tasks per file give what the plain parser gives."""

import json
import random

import pytest

from contract import queries
from veilpost import schemas
from veilpost.sources import readers
from veilpost.sources.json_array import read_json_arrays, write_json_arrays

SCHEMA = "k long, t string, nested struct<a:string, b:array<struct<c:string>>>, note string"


def records(n=300):
    r = random.Random(6)
    parts = ["{", "}", '"', "\\", "},{", "é日", "\n", "x" * 50, "[", "]", '\\"', "\\\\", ","]

    def text():
        return "".join(r.choice(parts) for _ in range(r.randrange(12)))

    return [{"k": i, "t": text(), "nested": {"a": text(), "b": [{"c": text()} for _ in range(r.randrange(3))]}, "note": None if i % 3 else "y" * r.randrange(2_000)} for i in range(n)]


def flat(rows):
    return sorted((r["k"], r["t"], r["nested"]["a"], tuple(c["c"] for c in r["nested"]["b"]), r["note"]) for r in rows)


@pytest.fixture()
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield spark
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("indent,ascii_only", [(None, True), (2, False), (4, True)])
def test_every_record_once(small_splits, tmp_path, indent, ascii_only):
    rows = records()
    (tmp_path / "a.json").write_text(json.dumps(rows[:250], indent=indent, ensure_ascii=ascii_only))
    (tmp_path / "b.json").write_text(json.dumps(rows[250:], indent=indent, ensure_ascii=ascii_only) + "\n")
    (tmp_path / "c.json").write_text("[]")
    assert small_splits.read.option("lineSep", "}").text(str(tmp_path)).rdd.getNumPartitions() > 20
    got = read_json_arrays(small_splits, str(tmp_path), small_splits.createDataFrame([], SCHEMA).schema)
    assert flat(got.collect()) == flat(rows)


def test_written_and_read_back(small_splits, tmp_path):
    rows = records(120)
    df = small_splits.createDataFrame([(r["k"], r["t"], (r["nested"]["a"], [(c["c"],) for c in r["nested"]["b"]]), r["note"]) for r in rows], SCHEMA)
    write_json_arrays(df.repartition(2), str(tmp_path / "out"))
    files = list((tmp_path / "out").glob("part-*"))
    assert sorted(r["k"] for f in files for r in json.loads(f.read_text())) == sorted(r["k"] for r in rows)
    assert flat(read_json_arrays(small_splits, str(tmp_path / "out"), df.schema).collect()) == flat(rows)


def test_readers_of_array_files(spark, tmp_path):
    (tmp_path / "mails.json").write_text(json.dumps([{"raw_email": "a } b", "true_label": "benign"}, {"raw_email": "c", "other": 1}]))
    got = readers.read_labelled_mails(spark, str(tmp_path / "mails.json"))
    assert got.schema.names == schemas.LABELLED_MAIL.names
    assert sorted((r.raw_email, r.true_label) for r in got.collect()) == [("a } b", "benign"), ("c", None)]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.read_techniques(spark, str(tmp_path / "none.json"))


@pytest.mark.parametrize("name", ["scan_labelled", "scan_techniques"])
def test_array_files_are_written_by_as_many_tasks_as_read_the_mails(spark, sf_dir, monkeypatch, name):
    tasks = []
    monkeypatch.setattr(queries, "write_json_arrays", lambda rows, path: (tasks.append(rows.rdd.getNumPartitions()), write_json_arrays(rows, path)))
    assert queries.QUERIES[name](spark, sf_dir).count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert tasks == [4]

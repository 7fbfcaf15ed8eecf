import pandas as pd
import pytest

from veilpost.session import ship_package

LONG = " ".join(f"w{i % 97}x{i % 89}" for i in range(20_000))
PASSAGE = " ".join(f"pass{i}" for i in range(60))
OTHER = "".join(f" other{i}" for i in range(80))
#: Edge rows: null, empty and white texts, few words, signs, very long, copies, near copies, repeated rows, null number.
EDGES = [
    (9001, None), (9002, ""), (9003, " \t\n "), (9004, "one two"), (9005, "One  two"), (9006, "#$%&|<> ***"),
    (9007, LONG), (9008, LONG), (9009, LONG + " tail"), (9010, "x " + PASSAGE + " y"), (9011, "z " + PASSAGE + OTHER),
    (9012, "A b c d e f g h i j k l m n"), (9012, "A b c d e f g h i j k l m n"), (None, "a b c d e f g h i j k l m n"),
    (9013, "mail me@x.org or +1 (555) 123-4567, card 4111 1111 1111 1111 at 10.0.0.1 and 999.1.1.1"),
    (9014, "é" * 40 + " a@b.cc_x@d.ee 日本 token = \"0123456789abcdef\""), (9015, "same line\nsame line\n\nsame line"),
    (9016, "tab\tnew\x0bline\x0cfeed\r\n end"),
]


@pytest.fixture(scope="session")
def rows(sf_dir):
    docs = pd.read_parquet(f"{sf_dir}/documents.parquet")[["doc_id", "text"]]
    found = [(int(i), t) for i, t in zip(docs.doc_id, docs.text)] + EDGES
    return found


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key long, block int, component string, spans string, score string"


@pytest.fixture(scope="session")
def table(spark, rows, tmp_path_factory):
    """The rows with further columns, some of them named as results or helpers are."""
    ship_package(spark)
    path = str(tmp_path_factory.mktemp("llm") / "documents")
    full = [(i, t, "en" if k % 3 else None, f"s{k % 2}", len(t) if t else None, k, k, "c", "s", None) for k, (i, t) in enumerate(rows)]
    spark.createDataFrame(full, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def nothing(spark, table):
    return spark.createDataFrame([], SCHEMA)

"""The corpus pipeline: each stage is one operator of veilpost.llm, fed with what the one before kept.

A row's identity is its doc_id; a row without one cannot be judged against others and is kept by the
filtering stages unless its own text fails.  Every stage but the last returns the columns it got.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilpost.llm import near_duplicates, packing, personal_data, substrings, toxicity
from veilpost.llm.exchange import save
from veilpost.llm.queries import not_held_out
from veilpost.llm.tables import documents, labels, ranks_file
from veilpost.session import ship_package

#: Documents scored at least this are rejected.
TOXIC = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose score from the nearest labelled examples is below the limit."""
    ship_package(spark)
    scorer = toxicity.fit(docs, labels(spark, sf_dir), not_held_out())
    scored = toxicity.score_documents(docs, scorer, score="__score", evidence="__evidence")
    return scored.where(F.col("__score") < TOXIC).drop("__score", "__evidence")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of smallest number of every group of near-duplicates."""
    ship_package(spark)
    found = near_duplicates.near_duplicates(docs)
    gone = found.where("NOT kept").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["__gone"], "left_anti")


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut words out that windows of documents of smaller number cover; a text that loses nothing stays as it is.

    A text of which nothing is left goes.  n_chars follows the text.
    """
    ship_package(spark)
    return substrings.cut_repeats(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every span of personal data by its kind; the model is fitted on these documents."""
    ship_package(spark)
    model = personal_data.fit(save(personal_data.with_candidates(docs.select("text")).select("candidates"), "candidates"))
    return personal_data.mask_documents(docs, model)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boundary records of the packed sequences."""
    ship_package(spark)
    return packing.pack_documents(docs, *ranks_file())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", drop_repeated_passages),
    ("personal_data", mask_personal_data),
    ("packing", pack),
]

#: Fitted models, hashing and tokens are outside of SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each result is written and read back before the next stage."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), f"stage-{name}", "snappy")
    return STAGES[-1][1](spark, docs, sf_dir)

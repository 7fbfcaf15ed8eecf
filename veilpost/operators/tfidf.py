"""Exact TF-IDF retrieval: the knowledge base as an inverted index of sparse vectors, met on terms.

Terms are maximal runs of letters and digits of the lower-cased text.  A term of a text that holds it t times weighs
t x idf, idf being 100 (1 + ln((1 + n) / (1 + df))), rounded, over the n texts of the knowledge base; terms that
it does not know weigh nothing.  Weights are whole numbers, so dot products are exact and do not depend on the order of
adding; the score is the cosine.

Occurrences meet the terms of an index of up to LOCAL_ROWS rows where the texts lie: only terms that it knows are shuffled, once to be
counted and once to come together by text, where dot products, norms and ranks follow.  Occurrences that meet a larger index
are counted per text first.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import fresh_dir

BORDER = r"[^\p{L}\p{N}]+"
_WHOLE = "decimal(19,0)"
#: Rows of terms, and of postings, up to which an index goes to the tasks that read the texts.
LOCAL_ROWS = 100_000


@dataclass
class Index:
    """`terms` (term, idf) and `postings` (term, id, weight, norm), saved."""

    terms: DataFrame
    postings: DataFrame


def _saved(df: DataFrame, purpose: str) -> DataFrame:
    path = fresh_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def term_counts(df: DataFrame, key: str, text: str, known: DataFrame | None = None) -> DataFrame:
    """(key, term, n) of the terms of every text; of those in `known`, a small table, if it is given."""
    words = df.select(key, F.explode(F.split(F.lower(text), BORDER)).alias("term")).where("term <> ''")
    if known is not None:
        words = words.join(F.broadcast(known), "term")
    return words.groupBy(key, "term").agg(F.count(F.lit(1)).alias("n"))


def _square(column: str) -> Column:
    return F.sum(F.col(column).cast(_WHOLE) * F.col(column).cast(_WHOLE))


def build_index(kb: DataFrame, key: str = "id", text: str = "text") -> Index:
    """Index a knowledge base; rows with one key are one text, and rows without a key are left out."""
    kb = kb.where(F.col(key).isNotNull())
    counted = _saved(term_counts(kb, key, text), "kb-terms")
    total = kb.select(key).distinct().count()
    idf = F.round(F.lit(100.0) * (F.log(F.lit(1.0 + total) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0))).cast("long")
    terms = counted.groupBy("term").agg(F.count(F.lit(1)).alias("df")).select("term", idf.alias("idf"))
    terms = _saved(terms, "terms")
    weighed = counted.join(terms, "term").select("term", F.col(key).alias("id"), (F.col("n") * F.col("idf")).alias("weight"))
    norms = weighed.groupBy("id").agg(_square("weight").alias("norm"))
    return Index(terms, _saved(weighed.join(norms, "id"), "postings"))


def nearest_texts(df: DataFrame, index: Index, k: int, key: str = "email_id", text: str = "raw_email") -> DataFrame:
    """(key, rank, id, score): the k texts of the index with the greatest cosine, from rank 0; ids break ties.

    Texts that share no term with a row are not listed for it.  `key` is unique in `df`.
    """
    own = F.col("n") * F.col("idf")
    dot = F.sum(F.col("__own").cast(_WHOLE) * F.col("weight").cast(_WHOLE)).alias("__dot")
    if max(table.limit(LOCAL_ROWS + 1).count() for table in (index.terms, index.postings)) <= LOCAL_ROWS:
        counted = term_counts(df.where(F.col(key).isNotNull()), key, text, index.terms.select("term"))
        weighed = counted.join(F.broadcast(index.terms), "term").select(F.col(key).alias("__key"), "term", own.alias("__own"))
        # One row per text, so what follows stays in its task.
        texts = weighed.groupBy("__key").agg(_square("__own").alias("__norm"), F.collect_list(F.struct("term", "__own")).alias("__terms"))
        met = texts.select("__key", "__norm", F.inline("__terms")).join(F.broadcast(index.postings), "term")
        dots = met.groupBy("__key", "id").agg(dot, F.first("norm").alias("norm"), F.first("__norm").alias("__norm"))
    else:
        weighed = term_counts(df, key, text).join(index.terms, "term").select(F.col(key).alias("__key"), "term", own.alias("__own"))
        weighed = _saved(weighed, "query-terms")
        norms = weighed.groupBy("__key").agg(_square("__own").alias("__norm"))
        dots = weighed.join(index.postings, "term").groupBy("__key", "id").agg(dot, F.first("norm").alias("norm")).join(norms, "__key")
    length = F.sqrt(F.col("__norm").cast("double")) * F.sqrt(F.col("norm").cast("double"))
    scored = dots.select("__key", "id", (F.col("__dot").cast("double") / length).alias("score"))
    rank = F.row_number().over(W.partitionBy("__key").orderBy(F.desc("score"), "id"))
    ranked = scored.withColumn("rank", rank).where(F.col("rank") <= k)
    return ranked.select(F.col("__key").alias(key), (F.col("rank") - 1).cast("int").alias("rank"), "id", "score")

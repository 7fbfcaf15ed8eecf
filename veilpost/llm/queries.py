"""The registered queries of this subpackage and the SQL some of them are checked with."""

from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilpost.operators.stage import computed_once
from veilpost.session import ship_package

from . import (
    fingerprint, jaccard_join, language_model, near_duplicates, outliers, packing, periodic, personal_data, phrases, pieces, sharding,
    substrings, toxicity,
)
from .exchange import save
from .oracles import ORACLES  # noqa: F401
from .tables import documents, labels, pieces_file, ranks_file


def op1_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.judge(documents(spark, sf_dir))


def op2_backoff_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 2
    scored = language_model.score_documents(documents(spark, sf_dir), ~F.coalesce(held_out, F.lit(False)))
    return scored.select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def not_held_out(column: str = "doc_id") -> Column:
    """Rows whose labels may be learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(5)) != 0, F.lit(True))


def op3_nearest_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    scorer = toxicity.fit(docs, labels(spark, sf_dir), not_held_out())
    scored = toxicity.score_documents(docs, scorer)
    predicted = (F.col("score") >= 0.5).cast("int")
    return scored.select("doc_id", (~not_held_out()).alias("held_out"), "score", predicted.alias("predicted"), "evidence")


def op4_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + F.lit(1)).alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        sharding.text_key("doc_id", "text").alias("sort_key"),
    )
    placed = sharding.shard_rows(docs, "sort_key", "size", shards=8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_suffix_array_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    encoded = pieces.encode_documents(docs, pieces_file(), decoded="decoded")
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_ids"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


def op6_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeats(documents(spark, sf_dir))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op7_voted_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    # Candidates hold no text, so the second pass reads them instead of finding them again.
    candidates = save(personal_data.with_candidates(docs).drop("text"), "candidates")
    model = personal_data.fit(candidates)
    found = computed_once(candidates, spans=personal_data.spans(model))
    strict = F.filter("spans", lambda s: s["strict"])
    return found.select(
        "doc_id",
        *[personal_data.strict_count(kind).alias(f"n_{kind}") for kind in personal_data.STRICT],
        F.sha2(personal_data.spans_text(strict), 256).alias("base_sha256"),
        personal_data.spans_text(F.col("spans")).alias("spans"),
    )


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(documents(spark, sf_dir))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_with_next(documents(spark, sf_dir))


def op10_pack_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), *ranks_file())


def op11_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join_documents(documents(spark, sf_dir))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(documents(spark, sf_dir))


def planted_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text): every tenth text, by the checksum of its number, made periodic from a place on."""
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    drawn = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    split = computed_once(
        docs.select("doc_id", "text", drawn.alias("h")),
        words=F.when(F.col("h") % 10 == 0, words).otherwise(F.array().cast("array<string>")),
    )
    n, g = F.size("words"), F.floor(F.col("h") / 10)
    placed = computed_once(
        split,
        a=F.when(n > 0, g % n).cast("int"),
        p=F.when(n > 0, 1 + F.floor((n - g % n) / (3 + g % 8))).cast("int"),
    )
    repeated = F.transform("words", lambda w, i: F.get("words", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))))
    return placed.select("doc_id", F.when(n > 0, F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.collapse_runs(planted_periods(documents(spark, sf_dir)))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = computed_once(found, longest=periodic.longest(F.col("runs")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "longest.start",
        "longest.length",
        "longest.period",
        F.floor(1000 * F.col("longest.length") / F.col("longest.period")).alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def _shipped(query):
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


_OPERATORS = {
    "op1_robust_outliers": op1_robust_outliers,
    "op2_backoff_automaton": op2_backoff_automaton,
    "op3_nearest_examples": op3_nearest_examples,
    "op4_histogram_shards": op4_histogram_shards,
    "op5_suffix_array_pieces": op5_suffix_array_pieces,
    "op6_repeated_passages": op6_repeated_passages,
    "op7_voted_spans": op7_voted_spans,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_fingerprints": op9_fingerprints,
    "op10_pack_windows": op10_pack_windows,
    "op11_ngram_jaccard": op11_ngram_jaccard,
    "op12_collocations": op12_collocations,
    "op13_periodic_runs": op13_periodic_runs,
}

QUERIES = {name: _shipped(query) for name, query in _OPERATORS.items()}

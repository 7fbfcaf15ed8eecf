"""Knowledge bases: build, upsert, and the texts made from their rows."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import fixed


def custom_indicators(spark: SparkSession) -> DataFrame:
    """The hand-tuned indicator lists as a table (20 rows)."""
    return spark.createDataFrame(list(fixed.CUSTOM_INDICATORS.items()), "id string, custom string")


def extract_indicators(description: Column) -> Column:
    """Indicator words found in a description, whatever the case; a default where there is none."""
    lowered = F.lower(description)
    found = F.array_compact(
        F.array(*[F.when(F.contains(lowered, F.lit(w.lower())), F.lit(w)) for w in fixed.INDICATOR_WORDS])
    )
    return F.when(F.size(found) > 0, F.array_join(found, ", ")).otherwise(F.lit(fixed.INDICATOR_DEFAULT))


def build_kb(techniques: DataFrame, custom: DataFrame, targets: list[str] | None = None) -> DataFrame:
    """Technique knowledge base from a table (id, name, description, revoked).

    Keeps live rows whose id is a target, cuts the description, and prefers hand-tuned indicators.
    The filter reaches the scan; `custom` has one row per id.
    """
    wanted = techniques.where(F.col("id").isin(targets or fixed.TARGET_TECHNIQUES) & ~F.col("revoked"))
    return wanted.join(custom.select("id", "custom"), "id", "left").select(
        "id",
        "name",
        F.substring("description", 1, fixed.DESCRIPTION_CHARS).alias("description"),
        F.coalesce("custom", extract_indicators(F.col("description"))).alias("indicators"),
    )


def kb_text(name: Column, description: Column, indicators: Column) -> Column:
    return F.format_string(fixed.KB_TEXT, name, description, indicators)


def upsert(current: DataFrame, incoming: DataFrame, key: str = "id", version: str = "version") -> DataFrame:
    """Union in which the highest version per key wins, and of equal versions the incoming row.

    `row_number() = 1` makes Spark keep one row per key and task before the shuffle, so a key that
    was written very often does not pile up in one task.
    """
    newest_first = W.partitionBy(key).orderBy(F.desc(version), F.desc("__side"))
    return (
        current.withColumn("__side", F.lit(0))
        .unionByName(incoming.withColumn("__side", F.lit(1)))
        .withColumn("__rank", F.row_number().over(newest_first))
        .where(F.col("__rank") == 1)
        .drop("__rank", "__side")
    )


def indicator_phrases(kb: DataFrame) -> DataFrame:
    """(id, phrases): the comma list split into lower-case phrases."""
    phrases = F.transform(F.split("indicators", ","), lambda p: F.lower(F.trim(p)))
    return kb.select("id", F.filter(phrases, lambda p: p != "").alias("phrases"))

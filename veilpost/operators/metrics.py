"""Classification quality: counts, rates, threshold sweep and precision-recall curve.

Every metric starts from an aggregate with partial sums, so what is shuffled depends on the number
of thresholds or distinct scores, not on the number of mails.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import fixed
from ..session import fresh_dir


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def _rates(tp: str, fp: str, fn: str) -> list[Column]:
    """precision and recall from counts, 0 where the denominator is 0."""
    return [
        _ratio(F.col(tp), F.col(tp) + F.col(fp)).alias("precision"),
        _ratio(F.col(tp), F.col(tp) + F.col(fn)).alias("recall"),
    ]


def _f1() -> Column:
    return _ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))


def confusion(df: DataFrame, predicted: str = "is_phishing", actual: str = "true_label") -> DataFrame:
    """total, TP, TN, FP, FN in one pass; NULL predictions and unknown labels count in total only."""
    said, real = F.col(predicted), F.col(actual)
    phishing, benign = real == fixed.LABEL_PHISHING, real == fixed.LABEL_BENIGN
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(said & phishing).alias("TP"),
        F.count_if(~said & benign).alias("TN"),
        F.count_if(said & benign).alias("FP"),
        F.count_if(~said & phishing).alias("FN"),
    )


def quality(df: DataFrame, predicted: str = "is_phishing", actual: str = "true_label") -> DataFrame:
    """Counts with precision, recall, F1 and accuracy; accuracy divides by every record."""
    return (
        confusion(df, predicted, actual)
        .select("*", *_rates("TP", "FP", "FN"))
        .withColumn("f1_score", _f1())
        .withColumn("accuracy", _ratio(F.col("TP") + F.col("TN"), F.col("total")))
    )


def rounded_report(report: DataFrame, digits: int = 3) -> DataFrame:
    """Rates cut to `digits`; a tie goes to the even digit."""
    rates = ("precision", "recall", "f1_score", "accuracy")
    return report.select(*[F.bround(c, digits).alias(c) if c in rates else F.col(c) for c in report.columns])


def error_rows(df: DataFrame, predicted: str = "is_phishing", actual: str = "true_label") -> DataFrame:
    """The misclassified rows, tagged FP or FN."""
    said, real = F.col(predicted), F.col(actual)
    kind = F.when(said & (real == fixed.LABEL_BENIGN), F.lit("FP")).when(
        ~said & (real == fixed.LABEL_PHISHING), F.lit("FN")
    )
    return df.withColumn("type", kind).where(F.col("type").isNotNull())


def label_counts(df: DataFrame, label: str = "true_label") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc_nulls_last(label))


def class_balance(df: DataFrame, expected: dict, label: str = "label") -> DataFrame:
    """One row per check: expected and actual size of each class and of the whole set."""
    checks = [F.struct(F.lit("total").alias("check"), F.lit(sum(expected.values())).cast("bigint").alias("expected"), F.col("__total").alias("actual"))]
    counts = [F.count(F.lit(1)).alias("__total")]
    for i, (value, size) in enumerate(expected.items()):
        counts.append(F.count_if(F.col(label) == value).alias(f"__class_{i}"))
        checks.append(
            F.struct(
                F.lit(f"label_{value}").alias("check"),
                F.lit(size).cast("bigint").alias("expected"),
                F.col(f"__class_{i}").alias("actual"),
            )
        )
    return (
        df.agg(*counts)
        .select(F.inline(F.array(*checks)))
        .withColumn("ok", F.col("expected") == F.col("actual"))
    )


def predict_at(score: Column, alpha: float) -> Column:
    """1 where the score reaches the threshold; NULL and NaN never do."""
    return F.when((score >= alpha) & ~F.isnan(score), F.lit(1)).otherwise(F.lit(0))


def confusion_cells(df: DataFrame, label: str = "label", predicted: str = "predicted") -> DataFrame:
    """Four rows (label, predicted, n); empty cells are there with 0."""
    cells = [(a, p) for a in (0, 1) for p in (0, 1)]
    counted = df.agg(
        *[F.count_if((F.col(label) == a) & (F.col(predicted) == p)).alias(f"n_{a}{p}") for a, p in cells]
    )
    rows = [
        F.struct(F.lit(a).alias("label"), F.lit(p).alias("predicted"), F.col(f"n_{a}{p}").alias("n"))
        for a, p in cells
    ]
    return counted.select(F.inline(F.array(*rows)))


def metrics_at(df: DataFrame, alpha: float, label: str = "label", score: str = "predicted_score") -> DataFrame:
    said, real = predict_at(F.col(score), alpha), F.col(label)
    return (
        df.agg(
            F.count_if((real == 1) & (said == 1)).alias("TP"),
            F.count_if((real == 0) & (said == 1)).alias("FP"),
            F.count_if((real == 1) & (said == 0)).alias("FN"),
            F.count_if((real == 0) & (said == 0)).alias("TN"),
        )
        .select(F.lit(float(alpha)).alias("alpha"), "*", *_rates("TP", "FP", "FN"))
        .withColumn("f1", _f1())
    )


def threshold_step(score: Column, steps: int = fixed.ALPHA_STEPS) -> Column:
    """Highest i with score >= i/steps, at most `steps`; -1 where no threshold is reached."""
    guess = F.floor(score * steps)
    exact = (
        F.when(score >= (guess + 1) / steps, guess + 1)
        .when(score < guess / steps, guess - 1)
        .otherwise(guess)
    )
    unusable = score.isNull() | F.isnan(score) | (score < 0)
    return F.when(unusable, F.lit(-1)).when(score >= 1.0, F.lit(steps)).otherwise(exact).cast("bigint")


def alpha_sweep(
    df: DataFrame, label: str = "label", score: str = "predicted_score", steps: int = fixed.ALPHA_STEPS
) -> DataFrame:
    """Metrics at every threshold 0, 1/steps, .., 1.

    Each mail is counted once, at the highest threshold it reaches; the counts at a threshold are
    then the running totals from above over at most steps + 2 rows.
    """
    per_step = df.groupBy(threshold_step(F.col(score), steps).alias("step")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    return _sweep(per_step, steps)


def _sweep(per_step: DataFrame, steps: int) -> DataFrame:
    every_step = per_step.sparkSession.range(-1, steps + 1).withColumnRenamed("id", "step")
    from_above = W.orderBy(F.desc("step"))
    overall = W.orderBy(F.desc("step")).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    counted = (
        every_step.join(per_step, "step", "left")
        .fillna(0, ["pos", "neg"])
        .select(
            "step",
            F.sum("pos").over(from_above).alias("TP"),
            F.sum("neg").over(from_above).alias("FP"),
            F.sum("pos").over(overall).alias("__pos"),
            F.sum("neg").over(overall).alias("__neg"),
        )
    )
    return (
        counted.where(F.col("step") >= 0)
        .select(
            (F.col("step") / steps).alias("alpha"),
            "TP",
            "FP",
            (F.col("__pos") - F.col("TP")).alias("FN"),
            (F.col("__neg") - F.col("FP")).alias("TN"),
        )
        .select("*", *_rates("TP", "FP", "FN"))
        .withColumn("f1", _f1())
    )


def score_counts(df: DataFrame, label: str = "label", score: str = "predicted_score") -> DataFrame:
    """(score, pos, neg, n): how many mails have each score.  All that thresholds need to know; see `merge_counts`."""
    return df.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"), F.count(F.lit(1)).alias("n")
    )


def merge_counts(*states: DataFrame) -> DataFrame:
    """Counts of all mails from the stored counts of parts that have no mail in common; no mail is read again."""
    both = reduce(DataFrame.unionByName, states)
    return both.groupBy("score").agg(*[F.sum(c).alias(c) for c in ("pos", "neg", "n")])


def alpha_sweep_from(counts: DataFrame, steps: int = fixed.ALPHA_STEPS) -> DataFrame:
    """`alpha_sweep` of the mails behind `score_counts`."""
    per_step = counts.groupBy(threshold_step(F.col("score"), steps).alias("step")).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    return _sweep(per_step, steps)


def pr_curve(
    df: DataFrame, label: str = "label", score: str = "predicted_score", ranges: int = 64
) -> DataFrame:
    """Precision and recall at every distinct score, then the end point (1, 0) without a threshold.

    Missing and NaN scores reach no threshold, as in the other metrics.

    Mails are first counted per distinct score, and the counts are written to the shared folder: three
    later steps read them, and the mails are scored once.  The running totals over the scores are made of two
    parts: totals of whole score ranges (at most `ranges` + 1 rows in one task) and running totals
    inside a range.  The ranges hold equal shares of the distinct scores.
    """
    reached = F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double"))
    per_score = df.where(reached).groupBy(F.col(score).alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count(F.lit(1)).alias("n")
    )
    return _curve(per_score, ranges)


def pr_curve_from(counts: DataFrame, ranges: int = 64) -> DataFrame:
    """`pr_curve` of the mails behind `score_counts`."""
    reached = F.col("score").isNotNull() & ~F.isnan("score")
    return _curve(counts.where(reached).select(F.col("score").alias("threshold"), "pos", "n"), ranges)


def _curve(per_score: DataFrame, ranges: int) -> DataFrame:
    spark = per_score.sparkSession
    counts = fresh_dir(spark, "scores")
    per_score.write.parquet(counts)
    per_score = spark.read.parquet(counts)
    shares = F.array(*[F.lit(i / ranges) for i in range(1, ranges + 1)])
    cuts = per_score.agg(F.percentile_approx("threshold", shares).alias("cuts")).scalar()
    # The place a score takes among the sorted cuts is its range; equal scores take equal places.
    place = F.array_position(F.sort_array(F.array_append(cuts, F.col("threshold"))), F.col("threshold"))
    in_range = per_score.withColumn("__range", place)
    from_above = W.orderBy(F.desc("__range"))
    ahead = from_above.rowsBetween(W.unboundedPreceding, -1)
    everything = from_above.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    totals = (
        in_range.groupBy("__range")
        .agg(F.sum("pos").alias("__p"), F.sum("n").alias("__n"))
        .select(
            "__range",
            F.coalesce(F.sum("__p").over(ahead), F.lit(0)).alias("__pos_ahead"),
            F.coalesce(F.sum("__n").over(ahead), F.lit(0)).alias("__n_ahead"),
            F.sum("__p").over(everything).alias("__all_pos"),
        )
    )
    inside = W.partitionBy("__range").orderBy(F.desc("threshold"))
    # `totals` has at most `ranges` + 1 rows by construction.
    points = (
        in_range.join(F.broadcast(totals), "__range")
        .withColumn("tp", F.col("__pos_ahead") + F.sum("pos").over(inside))
        .withColumn("predicted", F.col("__n_ahead") + F.sum("n").over(inside))
        .select(
            "threshold",
            (F.col("tp") / F.col("predicted")).alias("precision"),
            F.when(F.col("__all_pos") > 0, F.col("tp") / F.col("__all_pos")).otherwise(F.lit(1.0)).alias("recall"),
        )
    )
    end = spark.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return points.unionByName(end)

"""The screening flow: mask, check, parse the masked text, score, audit.

Up to its last column the flow is row work on one scan: no shuffle, no Python worker unless a
plug-in is given.  Only the masked text reaches scoring.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..operators.audit import audit
from ..operators.latest import latest
from ..operators.parse import analysis_text, parse_mail
from ..operators.pii import mask_structured, normalize_privacy, residual_check
from ..operators.retrieve import example_context, judge_prompt, nearest, technique_context
from ..operators.score import (
    fallback_score,
    normalize_score,
    normalize_verdict,
    parse_reply,
    route_failures,
    score_with_model,
    used_fallback,
)
from ..operators.semantic import mask_items, no_items

NO_MODEL = "no_model_configured"
NO_STORED_VERDICT = "no_stored_verdict"


def redact(
    df: DataFrame, raw: str = "raw_email", detect: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Add masked_email, detected_pii, semantic_items, remaining_pii and final_check_status.

    `detect` adds `semantic_items` from `masked_email`; without it only structured PII is masked.
    """
    masked = mask_structured(df, raw, scan="__scan")
    masked = mask_items(detect(masked)) if detect else no_items(masked)
    return residual_check(masked, scan="__scan").drop("__scan")


def without_model(df: DataFrame, error: Column | str = NO_MODEL) -> DataFrame:
    """A `model` column that reports an error on every row, so that the rule decides."""
    error = F.lit(error) if isinstance(error, str) else error
    return df.withColumn("model", F.struct(parse_reply(F.lit(None).cast("string"))["verdict"].alias("verdict"), error.alias("error")))


def screen(
    df: DataFrame,
    raw: str = "raw_email",
    detect: Callable[[DataFrame], DataFrame] | None = None,
    score: Callable[[DataFrame], DataFrame] = without_model,
    keep_envelope_domain: bool = False,
    rescore: bool = False,
) -> DataFrame:
    """Add the structs `privacy`, `verdict` and `audit` and the column `analysis_text`.

    `score` adds `model` (verdict, error) and may read `parsed` and `masked_email`.  Masking hides
    the sender address, so the domain reads `not_extracted` unless `keep_envelope_domain` is set.
    """
    kept = [F.col(c) for c in df.columns]
    private = normalize_privacy(redact(df, raw, detect), fixed.SOURCE_PRIVACY_LIVE, raw)
    parsed = parse_mail(private, "masked_email", domain_from=raw if keep_envelope_domain else None)
    routed = route_failures(score(parsed), "masked_email")
    verdict = normalize_verdict(
        F.col("routed"), F.col("masked_email"), F.col("parsed.email_body"), F.col("parsed.sender_domain")
    )
    judged = (
        routed.withColumn("verdict", verdict)
        .withColumn("analysis_text", analysis_text(F.col("verdict.email_body"), F.col("masked_email")))
        .withColumn("verdict", F.col("verdict").withField("raw_email", F.col(raw)))
    )
    return audit(judged, rescore=rescore).select(*kept, "privacy", "verdict", "analysis_text", "audit")


def score_in_context(
    techniques: DataFrame,
    examples: DataFrame,
    reply_of: Callable,
    vector: str = "vector",
    key: str = "email_id",
    **prompt_options,
) -> Callable[[DataFrame], DataFrame]:
    """A `score` for `screen`: asks a plug-in with the nearest techniques and examples in the prompt.

    `techniques` has (id, description, vector), `examples` (id, email, label, reason, vector); mails carry
    one `vector` each, which serves both searches.  Small knowledge bases move no mail.
    """
    lines = {
        "__techniques": (techniques, fixed.TOP_TECHNIQUES, ["description"]),
        "__examples": (examples, fixed.TOP_EXAMPLES, ["email", "label", "reason"]),
    }

    def score(df: DataFrame) -> DataFrame:
        for out, (kb, k, texts) in lines.items():
            df = nearest(df, kb, k, key=key, vector=vector, out=out, carry=texts)
        named = F.transform(
            "__techniques", lambda t: F.struct(t["id"].alias("technique"), t["description"].alias("description"))
        )
        prompt = judge_prompt(
            F.col("parsed"), technique_context(named), example_context(F.col("__examples")), **prompt_options
        )
        return score_with_model(df.withColumn("prompt", prompt), reply_of).drop(*lines, "prompt")

    return score


def integrate(privacy: DataFrame, verdict: DataFrame, key: str = "email_id") -> DataFrame:
    """Both results of one mail in one row, for steps that were stored apart.

    No mail is lost: without a verdict that struct is NULL, and without a privacy record the mail has
    one whose status is FAIL.
    """
    fields = privacy.schema["privacy"].dataType.fields
    unchecked = F.struct(
        *[
            F.lit(fixed.STATUS_FAIL if f.name == "final_check_status" else None).cast(f.dataType).alias(f.name)
            for f in fields
        ]
    )
    return (
        privacy.join(verdict, key, "full")
        .withColumn("privacy", F.coalesce("privacy", unchecked))
        .withColumn("analysis_text", analysis_text(F.col("verdict.email_body"), F.col("privacy.masked_email")))
    )


def screen_with_stored(
    df: DataFrame, stored: DataFrame, raw: str = "raw_email", key: str = "email_id", version: str | None = None
) -> DataFrame:
    """Masking now, verdicts from an earlier run.  A stored body wins over the masked text.

    Of several stored verdicts of one mail the one of greatest `version` counts (of greatest digest, if
    that leaves a choice).  Mails without a stored verdict are judged by the rule, with an error that says so.
    """
    verdict = F.struct(
        "is_phishing",
        normalize_score(F.col("risk_score")).alias("risk_score"),
        "mitre_technique",
        "why_malicious_context",
        "high_risk_tokens",
    )
    order = F.col(version) if version else F.lit(0)
    saved = latest(
        stored.select(key, F.struct("email_body", "sender_domain").alias("__saved"), verdict.alias("__verdict"), order.alias("__version")),
        key, "__version",
    ).drop("__version")
    private = normalize_privacy(redact(df, raw), fixed.SOURCE_PRIVACY_CACHED, raw)
    missing = F.when(F.col("__verdict").isNull(), F.lit(NO_STORED_VERDICT))
    joined = private.join(saved, key, "left").withColumn(
        "model", F.struct(F.col("__verdict").alias("verdict"), missing.alias("error"))
    )
    return (
        route_failures(joined, "masked_email", parsed="__saved")
        .withColumn("verdict", normalize_verdict(F.col("routed"), F.col("masked_email")))
        .withColumn("analysis_text", analysis_text(F.col("verdict.email_body"), F.col("masked_email")))
        .withColumn("verdict", F.col("verdict").withField("raw_email", F.col(raw)))
        .select(key, "privacy", "verdict", "analysis_text")
    )


def hand_over(batch: DataFrame, detect: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Stored verdicts with their body masked: one flat record per mail.

    A missing body is not masked and gets its own status.
    """
    with_body = batch.withColumn("raw_email", F.coalesce("email_body", F.lit("")))
    done = redact(with_body, "raw_email", detect)
    empty = F.col("raw_email") == ""
    return done.select(
        F.col("email_id").alias("id"),
        "sender_domain",
        "raw_email",
        *fixed.VERDICT_FIELDS,
        "true_label",
        "masked_email",
        "detected_pii",
        F.col("semantic_items"),
        F.when(empty, F.lit(fixed.STATUS_NO_BODY)).otherwise(F.col("final_check_status")).alias("final_check_status"),
        "remaining_pii",
        F.lit(fixed.METHOD_BOTH).alias("redaction_method"),
        (F.col("raw_email") != F.col("masked_email")).alias("changed"),
    )


def mask_beside_reference(sample: DataFrame, key: str) -> DataFrame:
    """Our masking next to the masking a public set came with; the two are not scored."""
    return redact(sample, "unmasked_text").select(
        key,
        F.col("unmasked_text").alias("original_email"),
        F.col("masked_text").alias("reference_masked_text"),
        "masked_email",
        "detected_pii",
        "semantic_items",
        "final_check_status",
        "remaining_pii",
        (F.col("unmasked_text") != F.col("masked_email")).alias("changed"),
    )


def benchmark_scores(
    corpus: DataFrame,
    text: str = "snippet",
    score: Callable[[DataFrame], DataFrame] = without_model,
) -> DataFrame:
    """One risk score per corpus row: mask, score, and the keyword preset where scoring failed."""
    kept = [F.col(c) for c in corpus.columns if c != "predicted_score"]
    masked = redact(corpus, text)
    routed = route_failures(score(parse_mail(masked, "masked_email")), "masked_email")
    verdict = normalize_verdict(
        F.col("routed"), F.col("masked_email"), F.col("parsed.email_body"), F.col("parsed.sender_domain")
    )
    judged = fallback_score(routed.withColumn("verdict", verdict), "masked_email")
    chosen = F.when(used_fallback(F.col("verdict")), F.col("fallback_score")).otherwise(F.col("verdict.risk_score"))
    return judged.select(*kept, chosen.alias("predicted_score"))

"""Verdicts: the phrase-weight rule, model replies, normalization and routing between them."""

from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions import patterns as P
from ..functions.text import clean_tokens, contains_any, first_filled, once, phrase_hits, strip
from ..schemas import VERDICT
from .latest import latest
from .stage import computed_once

_PHRASES = [phrase for phrase, _ in fixed.SIGNALS]


def _technique_route(lowered: Column) -> Column:
    *routes, (_, default) = fixed.TECHNIQUE_ROUTES
    chain = reduce(
        lambda c, route: c.when(contains_any(lowered, route[0]), F.lit(route[1])),
        routes[1:],
        F.when(contains_any(lowered, routes[0][0]), F.lit(routes[0][1])),
    )
    return chain.otherwise(F.lit(default))


def rule_expression(text: Column) -> Column:
    """The verdict of the phrase-weight rule as one struct.

    The text is lowered once and every phrase looked up once; score and tokens both read the list
    of hits.  Weights are added as doubles in table order, since the sum decides a strict cut.
    """

    def verdict(low: Column, score: Column, tokens: Column) -> Column:
        return F.struct(
            (score >= fixed.PHISHING_CUT).alias("is_phishing"),
            score.alias("risk_score"),
            _technique_route(low).alias("mitre_technique"),
            F.format_string(fixed.WHY_RULE, F.size(tokens)).alias("why_malicious_context"),
            F.slice(tokens, 1, fixed.MAX_TOKENS).alias("high_risk_tokens"),
        )

    def from_hits(low: Column, hits: Column) -> Column:
        total = reduce(
            lambda acc, i: acc + F.when(F.get(hits, F.lit(i)), F.lit(fixed.SIGNALS[i][1])).otherwise(F.lit(0.0)),
            range(len(_PHRASES)),
            F.lit(0.0),
        )
        capped = F.least(F.greatest(total, F.lit(0.0)), F.lit(fixed.SCORE_CAP))
        tokens = F.filter(
            F.array(*[F.when(F.get(hits, F.lit(i)), F.lit(p)) for i, p in enumerate(_PHRASES)]),
            lambda t: t.isNotNull(),
        )
        return once(capped, lambda score: once(tokens, lambda found: verdict(low, score, found)))

    return once(
        F.lower(text),
        lambda low: once(phrase_hits(low, _PHRASES), lambda hits: from_hits(low, hits)),
    )


def rule_verdict(df: DataFrame, text: str, out: str = "rule") -> DataFrame:
    """Add the rule's verdict on `text`."""
    return computed_once(df, **{out: rule_expression(F.col(text))})


def fallback_score(df: DataFrame, text: str, out: str = "fallback_score") -> DataFrame:
    """Keyword preset score of the benchmark; the rule score where no preset word occurs."""
    def preset(low: Column) -> Column:
        return (
            F.when(contains_any(low, fixed.FALLBACK_PHISHING_WORDS), F.lit(fixed.FALLBACK_PHISHING_SCORE))
            .when(contains_any(low, fixed.FALLBACK_BENIGN_WORDS), F.lit(fixed.FALLBACK_BENIGN_SCORE))
            .otherwise(rule_expression(F.col(text))["risk_score"])
        )

    return computed_once(df, **{out: once(F.lower(text), preset)})


def normalize_score(score: Column) -> Column:
    """Risk score in [0, 1]; a 0-10 scale is divided by ten, anything unreadable is 0.

    NaN becomes 0 as well: in Spark it would compare greater than every number.
    """
    value = score.try_cast("double")
    scaled = F.when(value > 1.0, value / 10.0).otherwise(value)
    clamped = F.least(F.greatest(scaled, F.lit(0.0)), F.lit(1.0))
    return F.when(value.isNull() | F.isnan(value), F.lit(0.0)).otherwise(clamped)


def technique_id(technique: Column) -> Column:
    """First technique id inside a free text, else UNKNOWN."""
    found = F.nullif(F.regexp_extract(technique, P.TECHNIQUE_ID, 0), F.lit(""))
    return F.coalesce(found, F.lit(fixed.TECHNIQUE_UNKNOWN))


def parse_reply(reply: Column) -> Column:
    """Verdict struct of a model reply, plus an error text where the reply cannot be read.

    Code fences are dropped.  The whole reply counts when it is an object with all five fields;
    otherwise the slice from the first { to the last } counts, whatever fields it has.

    Models type loosely: flags and scores may come as text or numbers, and a single token as a text.  A
    field that is there but cannot be read makes the reply an error, never a benign verdict.
    """
    clean = strip(F.replace(F.replace(reply, F.lit("```json"), F.lit("")), F.lit("```"), F.lit("")))
    wanted = F.array(*[F.lit(f) for f in fixed.VERDICT_FIELDS])
    complete = F.size(F.array_except(wanted, F.json_object_keys(clean))) == 0
    sliced = F.nullif(F.regexp_extract(clean, P.OBJECT_SLICE, 0), F.lit(""))
    readable = F.json_object_keys(sliced).isNotNull()
    source = F.when(complete, clean).when(readable, sliced)
    loose = F.from_json(source, "struct<" + ",".join(f"{f}:string" for f in fixed.VERDICT_FIELDS) + ">")
    flag = F.lower(F.trim(loose["is_phishing"]))
    is_phishing = F.when(flag.isin("true", "1", "1.0"), True).when(flag.isin("false", "0", "0.0"), False)
    risk_score = loose["risk_score"].try_cast("double")
    unread = (loose["is_phishing"].isNotNull() & is_phishing.isNull()) | (
        loose["risk_score"].isNotNull() & risk_score.isNull()
    )
    tokens = F.when(
        F.json_array_length(loose["high_risk_tokens"]).isNotNull(),
        F.from_json(loose["high_risk_tokens"], "array<string>"),
    ).when(loose["high_risk_tokens"].isNotNull(), F.array(loose["high_risk_tokens"]))
    parsed = F.when(
        source.isNotNull() & ~unread,
        F.struct(
            is_phishing.alias("is_phishing"),
            risk_score.alias("risk_score"),
            loose["mitre_technique"].alias("mitre_technique"),
            loose["why_malicious_context"].alias("why_malicious_context"),
            tokens.alias("high_risk_tokens"),
        ).cast(VERDICT),
    )
    failed = F.struct(
        F.lit(None).cast("boolean").alias("is_phishing"),
        F.lit(0.0).alias("risk_score"),
        F.lit(fixed.PARSE_FAILED_TECHNIQUE).alias("mitre_technique"),
        F.lit(fixed.PARSE_FAILED_WHY).alias("why_malicious_context"),
        F.array().cast("array<string>").alias("high_risk_tokens"),
    )
    verdict = F.when(parsed.isNotNull(), parsed).otherwise(failed)
    error = F.when(parsed.isNull(), F.lit(fixed.PARSE_ERROR))
    return F.struct(verdict.alias("verdict"), error.alias("error"))


def replies_or_errors(
    reply_of: Callable[[pd.Series], pd.Series], batch: pd.Series, error_chars: int | None = 100
) -> tuple[list, list]:
    """The replies of a plug-in, and for each row that it fails on its error (cut to `error_chars`)."""
    try:
        return list(reply_of(batch)), [None] * len(batch)
    except Exception as failure:  # one mail must not decide about others
        if len(batch) == 1:
            return [None], [str(failure)[:error_chars]]
    rows = [replies_or_errors(reply_of, batch.iloc[i : i + 1], error_chars) for i in range(len(batch))]
    return [r[0] for r, _ in rows], [e[0] for _, e in rows]


def score_with_model(
    df: DataFrame, reply_of: Callable[[pd.Series], pd.Series], prompt: str = "prompt", out: str = "model"
) -> DataFrame:
    """Ask a plug-in scorer for one reply text per prompt and parse it.

    A batch that raises is asked again row by row, so only the mails that raise are marked with their
    error and go to the rule, whatever the size of batches.
    """

    @F.pandas_udf("reply string, error string")
    def ask(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            replies, errors = replies_or_errors(reply_of, batch)
            yield pd.DataFrame({"reply": pd.Series(replies, dtype=object), "error": pd.Series(errors, dtype=object)})

    # Not deterministic: no filter may copy the call.
    ask = ask.asNondeterministic()
    asked = df.withColumn("__asked", ask(prompt)).withColumn("__parsed", parse_reply(F.col("__asked.reply")))
    return asked.withColumn(
        out,
        F.struct(
            F.col("__parsed.verdict").alias("verdict"),
            F.coalesce("__asked.error", "__parsed.error").alias("error"),
        ),
    ).drop("__asked", "__parsed")


def route_failures(
    df: DataFrame, text: str, parsed: str = "parsed", model: str = "model", out: str = "routed"
) -> DataFrame:
    """The model's verdict, or the rule's where the model reported an error.

    On the rule path the body is the whole text and the reason names the error.
    """
    ruled = rule_verdict(df, text, "__rule")
    failed = F.coalesce(F.col(f"{model}.error"), F.lit("")) != ""

    def pick(name: str) -> Column:
        return F.when(failed, F.col(f"__rule.{name}")).otherwise(F.col(f"{model}.verdict.{name}"))

    why = F.when(
        failed,
        F.format_string(fixed.WHY_FALLBACK, F.col(f"{model}.error"), F.col("__rule.why_malicious_context")),
    ).otherwise(F.col(f"{model}.verdict.why_malicious_context"))
    routed = F.struct(
        F.when(failed, F.col(text)).otherwise(F.col(f"{parsed}.email_body")).alias("email_body"),
        F.col(f"{parsed}.sender_domain").alias("sender_domain"),
        pick("is_phishing").alias("is_phishing"),
        pick("risk_score").alias("risk_score"),
        pick("mitre_technique").alias("mitre_technique"),
        why.alias("why_malicious_context"),
        pick("high_risk_tokens").alias("high_risk_tokens"),
        F.when(failed, F.lit(fixed.SOURCE_RULE)).otherwise(F.lit(fixed.SOURCE_MODEL)).alias("verdict_source"),
        F.when(failed, F.col(f"{model}.error")).alias("gemini_error"),
    )
    return ruled.withColumn(out, routed).drop("__rule")


def normalize_verdict(
    routed: Column, raw_email: Column, parsed_body: Column | None = None, parsed_domain: Column | None = None
) -> Column:
    """Verdict struct with every default filled in.  NULL technique reads UNKNOWN."""
    none = F.lit(None).cast("string")
    body = first_filled(routed["email_body"], none if parsed_body is None else parsed_body, raw_email)
    domain = first_filled(
        routed["sender_domain"], none if parsed_domain is None else parsed_domain, F.lit(fixed.DOMAIN_DEFAULT)
    )
    return F.struct(
        raw_email.alias("raw_email"),
        body.alias("email_body"),
        domain.alias("sender_domain"),
        F.coalesce(routed["is_phishing"], F.lit(False)).alias("is_phishing"),
        normalize_score(routed["risk_score"]).alias("risk_score"),
        F.coalesce(routed["mitre_technique"], F.lit(fixed.TECHNIQUE_UNKNOWN)).alias("mitre_technique"),
        F.coalesce(routed["why_malicious_context"], F.lit(fixed.WHY_DEFAULT)).alias("why_malicious_context"),
        clean_tokens(routed["high_risk_tokens"]).alias("high_risk_tokens"),
        F.coalesce(routed["verdict_source"], F.lit(fixed.SOURCE_MODEL)).alias("verdict_source"),
        routed["gemini_error"].alias("gemini_error"),
    )


def used_fallback(verdict: Column) -> Column:
    return (verdict["verdict_source"] == fixed.SOURCE_RULE) | (
        F.coalesce(verdict["gemini_error"], F.lit("")) != ""
    )


def attach_scores(
    records: DataFrame, scores: DataFrame, key: str, score: str = "risk_score", version: str | None = None
) -> DataFrame:
    """Scores back to their records by key; a record without a score gets 0.

    Of several scores of one key the one of greatest `version` counts (of greatest digest, if that leaves a choice).
    """
    order = F.col(version) if version else F.lit(0)
    found = latest(scores.select(key, F.col(score).alias("__score"), order.alias("__version")), key, "__version").drop("__version")
    return records.join(found, key, "left").withColumn(
        "predicted_score", F.coalesce("__score", F.lit(0.0))
    ).drop("__score")


def apply_overrides(df: DataFrame, overrides: DataFrame, key: str = "email_id", verdict: str = "verdict") -> DataFrame:
    """Officer approvals by mail: an approved alert is suppressed, other phishing stays an alert.

    Only the approvals are joined, which are few enough on most days for Spark to broadcast them.
    """
    approvals = overrides.where("approved").select(key).distinct().withColumn("__approved", F.lit(True))
    phishing = F.col(f"{verdict}.is_phishing")
    action = (
        F.when(phishing & F.coalesce("__approved", F.lit(False)), F.lit("SUPPRESSED"))
        .when(phishing, F.lit("ALERT"))
        .otherwise(F.lit("NONE"))
    )
    return df.join(approvals, key, "left").withColumn("action", action).drop("__approved")

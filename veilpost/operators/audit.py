"""Explanation audit: does the verdict fall when the phrases behind it are removed?"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions.text import clean_tokens, longest_first, once, tokens_in_text
from .score import rule_expression, technique_id
from .stage import computed_once


def perturb(text: Column, tokens: Column) -> Column:
    """Replace each token in list order, with case (unlike the search for present tokens)."""
    return F.aggregate(tokens, text, lambda acc, t: F.replace(acc, t, F.lit(fixed.REMOVED)))


def audit(
    df: DataFrame,
    verdict: str = "verdict",
    text: str = "analysis_text",
    out: str = "audit",
    rescore: bool = False,
) -> DataFrame:
    """Add the audit struct.

    The perturbed score is a constant; with `rescore` it is the rule's score of the perturbed text.
    The first status that applies counts: benign, no tokens, no token in the text, passed/failed.
    """
    said = F.col(verdict)
    is_phishing = F.coalesce(said["is_phishing"], F.lit(False))
    score = F.coalesce(said["risk_score"], F.lit(0.0))

    def result(tokens: Column, present: Column, necessity: Column) -> Column:
        status = (
            F.when(~is_phishing, F.lit("skipped_benign"))
            .when(F.size(tokens) == 0, F.lit("skipped_no_tokens"))
            .when(necessity.isNull(), F.lit("skipped_tokens_absent"))
            .when(necessity["is_trustworthy"], F.lit("passed"))
            .otherwise(F.lit("failed"))
        )
        messages = F.create_map(*[F.lit(x) for pair in fixed.AUDIT_MESSAGES.items() for x in pair])
        return once(
            status,
            lambda s: F.struct(
                tokens.alias("high_risk_tokens"),
                present.alias("tokens_in_text"),
                necessity.alias("necessity"),
                score.alias("risk_score"),
                s.alias("status"),
                F.element_at(messages, s).alias("message"),
            ),
        )

    def necessity_of(perturbed: Column) -> Column:
        again = rule_expression(perturbed)["risk_score"] if rescore else F.lit(fixed.PERTURBED_SCORE)
        return once(
            again,
            lambda lowered: F.struct(
                perturbed.alias("perturbed_text"),
                lowered.alias("perturbed_score"),
                (score - lowered).alias("score_drop"),
                (score - lowered > fixed.TRUST_DROP).alias("is_trustworthy"),
            ),
        )

    def with_present(tokens: Column, present: Column) -> Column:
        tested = F.when(F.size(present) > 0, once(perturb(F.col(text), present), necessity_of))
        return once(tested, lambda necessity: result(tokens, present, necessity))

    def with_tokens(tokens: Column) -> Column:
        none = F.array().cast("array<string>")
        present = F.when(is_phishing, tokens_in_text(F.col(text), tokens)).otherwise(none)
        return once(present, lambda found: with_present(tokens, found))

    return computed_once(df, **{out: once(clean_tokens(said["high_risk_tokens"]), with_tokens)})


# The wording of this template is our own; any other with the same seven slots can be passed in.
FEEDBACK_TEMPLATE = """The audit of this verdict FAILED: removing the phrases it names lowered the risk score by no more than %.2f.

Technique: %s (as given: %s)
Phrases under review: %s

The mail was called phishing, yet the named phrases do not carry the score. They may be incidental, or
may not be what the verdict rests on. Masked mail:

%s

Name the phrases again for: %s
Check them against technique %s, and answer with JSON holding revised_tokens, revised_score,
causal_confidence and mitre_validation."""


def feedback_prompt(
    tokens: Column, technique: Column, mail: Column, template: str = FEEDBACK_TEMPLATE
) -> Column:
    """Prompt asking a detection model to revise a verdict that failed its audit."""
    token_list = F.when(F.size(tokens) > 0, F.array_join(tokens, ", ")).otherwise(F.lit("N/A"))
    excerpt = F.when(F.char_length(mail) <= fixed.EXCERPT_CHARS, mail).otherwise(
        F.concat(F.substring(mail, 1, fixed.EXCERPT_CHARS), F.lit("..."))
    )
    found = technique_id(technique)
    return F.format_string(
        template, F.lit(fixed.TRUST_DROP), found, technique, token_list, excerpt, token_list, found
    )


def failed_feedback(df: DataFrame, mail: str, key: str = "email_id") -> DataFrame:
    """One feedback prompt per mail whose audit failed."""
    return df.where(F.col("audit.status") == "failed").select(
        key,
        feedback_prompt(F.col("audit.tokens_in_text"), F.col("verdict.mitre_technique"), F.col(mail)).alias("prompt"),
    )


def _quoted(token: Column) -> Column:
    safe = F.replace(token, F.lit("\\E"), F.lit("\\E\\\\E\\Q"))
    return F.concat(F.lit("\\Q"), safe, F.lit("\\E"))


def token_spans(df: DataFrame, text: str, tokens: str, key: str = "email_id") -> DataFrame:
    """(key, token, start, len): every occurrence of every token, any letter case, start from 1.

    Splitting at the token gives the pieces between its occurrences; their running length gives the
    starts.
    """
    one = df.select(key, F.col(text).alias("__text"), F.explode(F.array_distinct(tokens)).alias("token"))
    pieces = F.call_function(
        "split", F.col("__text"), F.concat(F.lit("(?iu)"), _quoted(F.col("token"))), F.lit(-1)
    )
    width = F.char_length("token")
    lengths = F.transform(F.slice("__pieces", 1, F.size("__pieces") - 1), lambda p: F.char_length(p))
    starts = F.aggregate(
        lengths,
        F.struct(F.lit(1).alias("at"), F.array().cast("array<int>").alias("starts")),
        lambda s, n: F.struct(
            (s["at"] + n + width).alias("at"), F.array_append(s["starts"], s["at"] + n).alias("starts")
        ),
        lambda s: s["starts"],
    )
    return (
        one.withColumn("__pieces", pieces)
        .where(F.size("__pieces") > 1)
        .select(key, "token", F.explode(starts).alias("start"), width.alias("len"))
    )


def highlighted(text: Column, tokens: Column, open_tag: str = "<mark>", close_tag: str = "</mark>") -> Column:
    """HTML-escaped text with every token wrapped, longest token first at each place."""

    def escape(value: Column) -> Column:
        for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
            value = F.replace(value, F.lit(plain), F.lit(entity))
        return value

    quoted = F.transform(longest_first(tokens, F.char_length), lambda t: _quoted(escape(t)))
    pattern = F.concat(F.lit("(?iu)"), F.array_join(quoted, "|"))
    wrapped = F.regexp_replace(escape(text), pattern, F.lit(f"{open_tag}$0{close_tag}"))
    return F.when(F.size(tokens) > 0, wrapped).otherwise(escape(text))

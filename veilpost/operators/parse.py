"""Header and body fields of a raw mail as column expressions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions import patterns as P
from ..functions.text import contains_any, first_filled, first_group, once, strip


def sender(raw) -> Column:
    return F.coalesce(strip(first_group(raw, P.FROM_LINE)), F.lit(fixed.SENDER_DEFAULT))


def domain_of(address: Column) -> Column:
    return F.coalesce(first_group(address, P.DOMAIN), F.lit(fixed.DOMAIN_DEFAULT))


def subject(raw) -> Column:
    return F.coalesce(strip(first_group(raw, P.SUBJECT_LINE)), F.lit(""))


def body(raw) -> Column:
    """Text behind the last subject line, stripped; the untouched mail where there is none."""
    raw = F.col(raw) if isinstance(raw, str) else raw

    def behind_last(pieces: Column) -> Column:
        return F.when(F.size(pieces) > 1, strip(F.element_at(pieces, -1))).otherwise(raw)

    return once(F.split(raw, P.SUBJECT_CUT, -1), behind_last)


def parse_mail(
    df: DataFrame, raw: str = "raw_email", out: str = "parsed", domain_from: str | None = None
) -> DataFrame:
    """Add one struct with the parsed fields.

    `domain_from` names another column to read the sender domain from.  Masked mails have lost
    their address, so their domain reads `not_extracted` unless the raw mail is named here.
    """
    text = F.col(raw)
    with_sender = df.withColumn("__sender", sender(domain_from or raw))
    parsed = F.struct(
        text.alias("raw_email"),
        domain_of(F.col("__sender")).alias("sender_domain"),
        subject(raw).alias("subject"),
        body(raw).alias("email_body"),
        F.struct(
            contains_any(text, fixed.URGENCY_WORDS).alias("has_urgency_keywords"),
            contains_any(text, fixed.MONEY_WORDS).alias("has_money_request"),
            F.char_length(text).alias("char_count"),
        ).alias("metadata"),
    )
    return with_sender.withColumn(out, parsed).drop("__sender")


def analysis_text(email_body: Column, raw_email: Column) -> Column:
    """Body, else the raw mail, else ''; an empty string counts as missing."""
    return first_filled(email_body, raw_email)


def context_record(df: DataFrame, with_label: bool = False) -> DataFrame:
    """The seven-field record (eight with the label) handed from scoring to later steps."""
    fields = [F.col("parsed.sender_domain"), F.col("parsed.email_body")]
    fields += [F.col(f"verdict.{name}") for name in fixed.VERDICT_FIELDS]
    if with_label:
        fields.append(F.coalesce("true_label", F.lit(fixed.LABEL_DEFAULT)).alias("true_label"))
    return df.select("email_id", *fields)

"""Verdicts and officer approvals that arrive one after the other, in any order."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState

from ..operators.latest import latest

#: Mails share state by the hash of their key: a call per mail costs some ten milliseconds.  A checkpoint holds for one number of groups.
GROUPS = 1024


def _action(phishing, approved: bool) -> str:
    return "NONE" if not phishing else "SUPPRESSED" if approved else "ALERT"


def override_changes(verdicts: DataFrame, approvals: DataFrame, key: str = "email_id", keep: str = "30 days", keep_ms: int = 30 * 86_400_000) -> DataFrame:
    """(key, is_phishing, action, change_no): one row for every change of what is to be done about a mail.

    `verdicts` is (key, at, is_phishing) and `approvals` (key, at, approved), `at` being when it happened.  Of several verdicts of a
    mail the latest counts; one approval is enough, and may come before the verdict.  What is known about a mail is
    kept until event time is `keep` (`keep_ms` milliseconds) past its last event; later approvals do not reach it, and events that are late by
    more than `keep` may be left out.  What is known is kept by GROUPS groups of keys, one array per field.  Rows without a key, or without a time, are left out.
    """
    missing = F.lit(None).cast("boolean")
    both = verdicts.select(key, "at", "is_phishing", missing.alias("approved")).unionByName(
        approvals.select(key, "at", missing.alias("is_phishing"), F.col("approved").cast("boolean").alias("approved"))
    )
    events = (
        both.where(F.col(key).isNotNull() & F.col("at").isNotNull())
        .withColumn("verdict", F.col("approved").isNull()).withColumn("us", F.unix_micros("at"))
        .withColumn("__group", F.pmod(F.xxhash64(key), F.lit(GROUPS))).withWatermark("at", keep)
    )

    def update(_, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        # By key: moment of the verdict, phishing, approved, number of changes, action, last moment.
        known = {k: list(fields) for k, *fields in zip(*state.get)} if state.exists else {}
        before: dict = {}
        for frame in [] if state.hasTimedOut else frames:
            columns = (frame[c].tolist() for c in (key, "us", "verdict", "is_phishing", "approved"))
            for name, us, verdict, phishing, approved in zip(*columns):
                mail = known.setdefault(name, [None, None, False, 0, None, us])
                mail[5] = max(us, mail[5]) if name in before else us
                before.setdefault(name, mail[4])
                if not verdict:
                    mail[2] = mail[2] or approved is True
                # Of verdicts of one moment, phishing counts.
                elif mail[0] is None or us > mail[0] or us == mail[0] and phishing is True:
                    mail[0], mail[1] = us, phishing is True
        changed = []
        for name, action in before.items():
            mail = known[name]
            mail[4] = None if mail[0] is None else _action(mail[1], mail[2])
            if mail[4] is not None and mail[4] != action:
                mail[3] += 1
                changed.append((name, mail[1], mail[4], mail[3]))
        now = state.getCurrentWatermarkMs()
        kept = {name: mail for name, mail in known.items() if name in before or mail[5] // 1000 + keep_ms >= now}
        if kept:
            state.update(tuple(map(list, zip(*[(name, *mail) for name, mail in kept.items()]))))
            state.setTimeoutTimestamp(max(min(mail[5] for mail in kept.values()) // 1000 + keep_ms, now + 1))
        elif state.exists:
            state.remove()
        if changed:
            yield pd.DataFrame(changed, columns=[key, "is_phishing", "action", "change_no"])

    kind = verdicts.schema[key].dataType.simpleString()
    fields = f"keys array<{kind}>, at array<long>, phishing array<boolean>, approved array<boolean>, change_no array<long>, action array<string>, last array<long>"
    return events.groupBy("__group").applyInPandasWithState(
        update, f"{key} {kind}, is_phishing boolean, action string, change_no long", fields, "append", "EventTimeTimeout"
    )


def write_changes(changes: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append the changes of all that has arrived since the last run, and stop."""
    return (
        changes.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )


def current_actions(changes: DataFrame, key: str = "email_id") -> DataFrame:
    """(key, is_phishing, action): the last change of every mail."""
    return latest(changes, key, "change_no").drop("change_no")

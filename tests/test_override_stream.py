"""Approvals reach verdicts in any order of arrival, also after a restart."""

import datetime as dt
import itertools
import random

from veilpost.streaming import overrides
from veilpost.streaming.overrides import current_actions, override_changes, write_changes

T0 = dt.datetime(2024, 1, 1)
JUDGED = "email_id int, at timestamp, is_phishing boolean"
APPROVED = "email_id int, at timestamp, approved boolean"


def at(hours):
    return T0 + dt.timedelta(hours=hours)


def run(spark, folder, batches):
    """Files of both streams, batch by batch, each in a query of its own (a restart)."""
    for number, (judged, approved) in enumerate(batches):
        for name, rows, schema in (("judged", judged, JUDGED), ("approved", approved, APPROVED)):
            spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}/{number}")
        streams = [spark.readStream.schema(schema).parquet(f"{folder}/{name}/*") for name, schema in (("judged", JUDGED), ("approved", APPROVED))]
        write_changes(override_changes(*streams), f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/out")


def test_any_order_of_arrival(spark, tmp_path):
    judged = [(1, at(1), True), (2, at(1), True), (3, at(1), False), (None, at(1), True), (5, at(3), False), (5, at(2), True), (6, None, True)]
    approved = [(1, at(5), True), (3, at(0), True), (2, at(4), False), (9, at(1), True), (None, at(1), True)]
    want = {1: (True, "SUPPRESSED"), 2: (True, "ALERT"), 3: (False, "NONE"), 5: (False, "NONE")}
    parts = [(judged, []), ([], approved)]
    for number, order in enumerate(itertools.permutations(parts)):
        changes = run(spark, str(tmp_path / str(number)), order)
        assert {r.email_id: (r.is_phishing, r.action) for r in current_actions(changes).collect()} == want
        assert changes.where("email_id = 1").count() == 2 - number


def test_what_is_known_is_dropped_in_time(spark, tmp_path):
    late = at(24 * 90)
    batches = [([(1, at(0), True)], []), ([(2, late, True)], []), ([(3, late, False)], []), ([], [(1, late, True)])]
    got = {r.email_id: r.action for r in current_actions(run(spark, str(tmp_path), batches)).collect()}
    assert got == {1: "ALERT", 2: "ALERT", 3: "NONE"}


def test_mails_share_groups_of_state(spark, tmp_path, monkeypatch):
    """Many mails in three groups, so that one call has many of them; every mail has its own last action."""
    monkeypatch.setattr(overrides, "GROUPS", 3)
    r = random.Random(3)
    batches, verdicts, approvals = [], {}, set()
    for _ in range(2):
        judged = [(r.randrange(40), at(r.randrange(5)), r.choice([True, False, None])) for _ in range(60)]
        approved = [(r.randrange(40), at(r.randrange(5)), r.choice([True, False])) for _ in range(20)]
        for mail, when, says in judged:
            verdicts[mail] = max(verdicts.get(mail, (when, False)), (when, says is True))
        approvals |= {mail for mail, _, says in approved if says}
        batches.append((judged, approved))
    want = {m: (p, "NONE" if not p else "SUPPRESSED" if m in approvals else "ALERT") for m, (_, p) in verdicts.items()}
    changes = run(spark, str(tmp_path), batches)
    assert {x.email_id: (x.is_phishing, x.action) for x in current_actions(changes).collect()} == want
    assert changes.groupBy("email_id", "change_no").count().where("count > 1").count() == 0

"""Inputs derived from the given tables.

Each input is one SQL text that Spark and DuckDB both run, so both sides start from the same rows.
Every document becomes one mail: its whole text behind headers, a phrase line and a line with one
kind of personal data, all picked by the document's number.
"""

from pyspark.sql import DataFrame, SparkSession

from veilpost.sources.readers import read_spread

TABLE_KEYS = {"documents": "doc_id", "labels": "doc_id", "pages": "page_id", "embeddings": "vec_id"}

_SUBJECTS = [
    "Weekly sync agenda", "URGENT: verify your account", "Invoice overdue", "Quarterly report",
    "Wire transfer request", "Password reset", "Team lunch", "Payment reminder", "Your parcel",
    "Security notice", "Meeting minutes", "Past due balance", "Holiday plans", "Credit card declined",
]

_BODIES = [
    "Please find the agenda for the weekly meeting attached.",
    "Your payment is past due. Settle the outstanding balance by wire transfer immediately or your account will be disabled and the invoice declined.",
    "Click the secure portal to verify your credentials immediately, your account will be deleted.",
    "The minutes of the last session are on the share drive.",
    "Dear customer, your credit card was declined. Verify the invoice and the outstanding balance, a bank wire is past due, credentials needed immediately.",
    "Click here for the newsletter of this month.",
    "The training starts on Monday, bring your laptop.",
    "URGENT! ASAP! Act urgent: the CEO asks for a wire transfer, do not inform anyone, strictly confidential, account number follows.",
    "Lunch is at noon in the canteen.",
    "Please open attached file, the invoice attachment is a password protected zip, password in email body.",
    "We will visit Project Falcon with Wang Xiao-Ming at Taipei City, Xinyi District on Friday.",
    "A past due payment: bank wire and wire transfer accepted, click the secure portal, verify credentials, credit card declined.",
    "The build is green again, thank you all.",
    "Account will be disabled, past due invoice, outstanding balance, click to verify credentials for Acme Trading now.",
    "Court summons and legal threat: pay the regulatory penalty, enter your credentials on the fake login page.",
    "See you at the review of the maintenance window.",
]

_PII = [
    "wallet 0x52908400098527886E0F7030069857D2E4169EE7 on file",
    "coins to 1BoatSLRHtKNngkdXEeobR76b53LETtpyT please",
    "account GB82WEST12345698765432 and DE89370400440532013000",
    "bank code DEUTDEFF500 or DEUTDEFF",
    "write to jane.doe+news@mail.example.org or bob_x@site.co.uk.",
    "see https://portal.example.com/login?id=7&mail=a@b.example (today) and http://x.example/a",
    "host 2001:0db8:85a3:0000:0000:8a2e:0370:7334 at 12:30:09",
    "servers 192.168.10.1, 10.0.0.255 and 999.1.1.1",
    "card 4111-1111-1111-1111 or 4111 1111 1111 1111",
    "call 0912-345-678, 0987654321 or 0922 333 444",
    "id A123456789, not B323456789 nor xA123456789",
    "nothing of that kind here",
]


def _pick(number: str, values: list[str]) -> str:
    whens = " ".join(
        "WHEN {} THEN '{}'".format(i, v.replace("'", "''")) for i, v in enumerate(values)
    )
    return f"CASE {number} % {len(values)} {whens} END"


EMAIL_VIEW = f"""
SELECT d.doc_id AS email_id,
  CASE WHEN d.doc_id % 11 = 0 THEN '' ELSE 'From: user' || CAST(d.doc_id AS STRING) || '@corp'
    || CAST(d.doc_id % 7 AS STRING) || '.example.com' || chr(10) END
  || CASE WHEN d.doc_id % 13 = 0 THEN '' ELSE 'Subject: ' || {_pick("d.doc_id", _SUBJECTS)} || chr(10) || chr(10) END
  || {_pick("d.doc_id", _BODIES)} || chr(10) || {_pick("d.doc_id", _PII)} || chr(10) || d.text AS raw_email,
  CASE WHEN l.toxic = 1 THEN 'phishing' WHEN l.toxic = 0 THEN 'benign' END AS true_label
FROM {{documents}} d LEFT JOIN {{labels}} l ON d.doc_id = l.doc_id
"""

# Stored verdicts: what an earlier run with a model might have left, with its failures.
VERDICT_VIEW = f"""
SELECT e.email_id, e.raw_email, e.true_label,
  CASE WHEN e.email_id % 5 = 0 THEN 'corp.example.com' WHEN e.email_id % 5 = 1 THEN '' END AS sender_domain,
  CASE WHEN e.email_id % 6 = 0 THEN '' WHEN e.email_id % 6 = 1 THEN NULL ELSE e.raw_email END AS email_body,
  CASE WHEN e.email_id % 9 = 0 THEN NULL WHEN e.email_id % 4 IN (0, 1) THEN true ELSE false END AS is_phishing,
  CASE e.email_id % 8 WHEN 0 THEN '0.9' WHEN 1 THEN '7' WHEN 2 THEN 'x' WHEN 3 THEN '-1' WHEN 4 THEN '15'
    WHEN 5 THEN '0.55' WHEN 6 THEN NULL ELSE '0.875' END AS score_text,
  CASE e.email_id % 5 WHEN 0 THEN 'T1684.001 (BEC / Wire Transfer)' WHEN 1 THEN 'see T1566' WHEN 2 THEN 'none'
    WHEN 3 THEN NULL ELSE 'T1598.003' END AS mitre_technique,
  CASE WHEN e.email_id % 7 = 0 THEN NULL ELSE 'stored reason ' || CAST(e.email_id % 7 AS STRING) END AS why_malicious_context,
  CASE e.email_id % 6 WHEN 0 THEN 'Wire Transfer| past due |URGENT' WHEN 1 THEN '' WHEN 2 THEN 'verify|credentials|click'
    WHEN 3 THEN '  |no such phrase' WHEN 4 THEN 'agenda|meeting' ELSE 'the|invoice' END AS tokens_text,
  CASE WHEN e.email_id % 9 = 0 THEN 'rate_limit_exceeded' END AS error
FROM ({EMAIL_VIEW}) e
"""

# Model replies: good, fenced, with prose around, a field short, a list, garbage.
REPLY_VIEW = """
SELECT d.doc_id AS email_id,
  CASE d.doc_id % 6
    WHEN 0 THEN '{{"is_phishing": true, "risk_score": 0.9' || CAST(d.doc_id % 10 AS STRING) || ', "mitre_technique": "T1566.002", "why_malicious_context": "asks for credentials", "high_risk_tokens": ["verify", "click"]}}'
    WHEN 1 THEN '```json' || chr(10) || '{{"is_phishing": false, "risk_score": 0.1, "mitre_technique": "none", "why_malicious_context": "routine", "high_risk_tokens": []}}' || chr(10) || '```'
    WHEN 2 THEN 'My answer: {{"is_phishing": true, "risk_score": 8, "mitre_technique": "T1534", "why_malicious_context": "internal", "high_risk_tokens": ["wire"]}} Regards'
    WHEN 3 THEN '{{"is_phishing": true, "risk_score": 0.7}}'
    WHEN 4 THEN '["is_phishing", "risk_score"]'
    ELSE 'no verdict today (' || CAST(length(d.text) AS STRING) || ' characters read)' END AS reply,
  CASE d.doc_id % 6
    WHEN 0 THEN '[{{"type": "NAME", "value": "Person ' || CAST(d.doc_id AS STRING) || '"}}, {{"type": "COMPANY", "value": "Acme"}}]'
    WHEN 1 THEN 'Found: [{{"type": "PROJECT", "value": "Falcon"}}] as asked'
    WHEN 2 THEN '{{"type": "NAME", "value": "Ann"}}'
    WHEN 3 THEN '[]'
    WHEN 4 THEN 'nothing ] here ['
    ELSE '{{"items": [{{"type": "NAME", "value": "Bob"}}]}}' END AS list_reply
FROM {documents} d
"""

GAZETTEER = """
SELECT * FROM (VALUES
  (1, 'NAME', 'Wang Xiao-Ming'), (2, 'ADDRESS', 'Taipei City'), (3, 'ADDRESS', 'Taipei City, Xinyi District'),
  (4, 'PROJECT', 'Project Falcon'), (5, 'PROJECT', 'Falcon'), (6, 'JOB_TITLE', 'CEO'),
  (7, 'COMPANY', 'Acme Trading'), (8, 'NAME', 'Jane Doe'), (9, 'COMPANY', 'EMAIL')
) AS g(item_no, type, value)
"""


# Some ten thousands of entries: all words of ten characters or more that all documents have, and a passage of each document.
_LARGE_VALUES = """
SELECT md5(type || ':' || value) AS item_no, type, value FROM (
  SELECT DISTINCT 'WORD' AS type, word AS value FROM ({words}) AS w WHERE length(word) >= 10
  UNION ALL
  SELECT DISTINCT 'PASSAGE', substring(text, 31, 80) FROM {documents} WHERE length(text) >= 110
) AS v
"""
LARGE_GAZETTEER = _LARGE_VALUES.replace("{words}", "SELECT explode(split(text, ' ')) AS word FROM {documents}")
LARGE_GAZETTEER_DUCK = _LARGE_VALUES.replace("{words}", "SELECT unnest(string_split(text, ' ')) AS word FROM documents").replace("{documents}", "documents")


# Documents in the shape of a technique list: three of ten rows carry a wanted id.
_TECHNIQUE_IDS = [
    "T1566", "T1566.001", "T1598", "T1684", "T1684.001", "T1534", "T1585", "T1204.001", "T1078",
    "T1003", "T1059", "T1021", "T1110", "T1105", "T1486", "T1490", "T1027", "T1055", "T1082", "T1083",
    "T1057", "T1047", "T1012", "T1018", "T1033", "T1049", "T1069", "T1087", "T1135", "T1201",
]

TECHNIQUE_VIEW = f"""
SELECT {_pick("d.doc_id", _TECHNIQUE_IDS)} AS id, 'Technique ' || CAST(d.doc_id AS STRING) AS name,
  CASE WHEN d.doc_id % 4 = 0 THEN 'Spoofed EMAIL with a link. ' ELSE '' END || d.text AS description,
  d.doc_id % 10 = 3 AS revoked
FROM {{documents}} d
"""

STAGE_LOG_VIEW = f"""
SELECT d.doc_id AS event_id, {_pick("d.doc_id", ["B", "A", "C", "D"])} AS stage,
  {_pick("d.doc_id", ["running", "complete", "skipped", "failed", "complete", "running", "skipped"])} AS status
FROM {{documents}} d
"""


def email_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_shared(spark, sf_dir, EMAIL_VIEW)


def run_shared(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run a shared SQL text in Spark, its tables bound to the parquet files it names."""
    tables = {n: read_table(spark, sf_dir, n) for n in TABLE_KEYS if "{" + n + "}" in sql}
    return spark.sql(sql, **tables)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_spread(spark, f"{sf_dir}/{name}.parquet", TABLE_KEYS[name])


def duck(sql: str) -> str:
    """The same text for DuckDB, where the tables are views of their own name."""
    return sql.format(**{n: n for n in TABLE_KEYS})

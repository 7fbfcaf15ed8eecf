"""The registered queries: each runs an operator over whole tables and returns flat columns."""

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilpost import fixed
from veilpost.functions.text import clean_tokens, tokens_in_text
from veilpost.operators import audit as A
from veilpost.operators import datasets as D
from veilpost.operators import embed as E
from veilpost.operators import kb as K
from veilpost.operators import metrics as M
from veilpost.operators import parse as P
from veilpost.operators import pii, retrieve, score, semantic, tfidf
from veilpost.operators.kb_store import KbStore
from veilpost.plans import screening as S
from veilpost.session import fresh_dir
from veilpost.sources import readers, writers
from veilpost.sources.json_array import write_json_arrays
from veilpost.streaming.incremental import mail_stream, screen_available, table_files
from veilpost.streaming.overrides import current_actions, override_changes, write_changes

from . import inputs

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def joined(column, sep: str = "|") -> Column:
    return F.array_join(column, sep)


def mails(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.email_view(spark, sf_dir)


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored verdicts with their tokens as an array and the score parsed."""
    return inputs.run_shared(spark, sf_dir, inputs.VERDICT_VIEW).withColumn(
        "high_risk_tokens", F.split("tokens_text", r"\|")
    )


def gazetteer(spark: SparkSession) -> DataFrame:
    return spark.sql(inputs.GAZETTEER)


def ruled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every mail with the rule's verdict spread into columns."""
    return score.rule_verdict(mails(spark, sf_dir), "raw_email").select("email_id", "raw_email", "true_label", "rule.*")


def labelled_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(label 0/1, predicted_score) of the labelled mails."""
    label = F.when(F.col("true_label") == fixed.LABEL_PHISHING, 1).when(
        F.col("true_label") == fixed.LABEL_BENIGN, 0
    )
    return ruled(spark, sf_dir).select(
        "email_id", label.alias("label"), F.col("risk_score").alias("predicted_score")
    ).where(F.col("label").isNotNull())


def typed_mails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mails in the shape of a public phishing set: (email_id, email_text, email_type)."""
    kind = F.when(F.col("true_label") == fixed.LABEL_PHISHING, F.lit(fixed.CLASS_PHISHING)).when(
        F.col("true_label") == fixed.LABEL_BENIGN, F.lit(fixed.CLASS_BENIGN)
    )
    return mails(spark, sf_dir).select("email_id", F.col("raw_email").alias("email_text"), kind.alias("email_type"))


# --- masking -----------------------------------------------------------------------------------


@query
def pii_mask(spark, sf_dir):
    return S.redact(mails(spark, sf_dir)).select("email_id", "masked_email", "final_check_status")


@query
def pii_findings(spark, sf_dir):
    return (
        pii.mask_structured(mails(spark, sf_dir))
        .select("email_id", F.explode("detected_pii").alias("f"))
        .select("email_id", "f.type", "f.method", "f.count", "f.masked_as")
    )


@query
def pii_residual(spark, sf_dir):
    """The residual check on unmasked mails, where there is something to find."""
    checked = pii.residual_check(mails(spark, sf_dir), "raw_email")
    return checked.select("email_id", F.explode("remaining_pii").alias("r")).select("email_id", "r.type", "r.count")


def _one_type(pii_type: str):
    def run(spark, sf_dir):
        masked = pii.mask_type(mails(spark, sf_dir), pii_type, "raw_email", "masked", "n")
        return masked.select("email_id", "n", "masked")

    return run


for _type in fixed.PII_PATTERNS:
    QUERIES[f"pii_{_type.lower()}"] = _one_type(_type)


@query
def pii_pages(spark, sf_dir):
    """Masking of whole web pages: markup, scripts and non-Latin text."""
    pages = inputs.read_table(spark, sf_dir, "pages")
    return S.redact(pages, "html").select("page_id", "masked_email", "final_check_status")


@query
def pii_finding_totals(spark, sf_dir):
    return pii.finding_totals(pii.mask_structured(mails(spark, sf_dir)))


@query
def pii_coverage(spark, sf_dir):
    documents = inputs.read_table(spark, sf_dir, "documents").select("text")
    return pii.coverage(pii.mask_structured(documents, "text"), "text", "masked_email")


@query
def privacy_record(spark, sf_dir):
    record = pii.normalize_privacy(S.redact(mails(spark, sf_dir)), fixed.SOURCE_PRIVACY_LIVE)
    return record.select(
        "email_id",
        joined("privacy.detected_pii").alias("detected_pii"),
        "privacy.pii_type",
        "privacy.redaction_method",
        "privacy.final_check_status",
        joined("privacy.remaining_pii").alias("remaining_pii"),
        "privacy.source",
    )


@query
def semantic_dictionary(spark, sf_dir):
    masked = pii.mask_structured(mails(spark, sf_dir))
    found = semantic.detect_with_gazetteer(masked, gazetteer(spark))
    return found.select("email_id", F.posexplode("semantic_items").alias("item_pos", "i")).select(
        "email_id", "item_pos", "i.type", "i.value"
    )


@query
def semantic_large(spark, sf_dir):
    """Long words and text passages of all documents as a gazetteer, looked for in every mail."""
    found = semantic.detect_with_gazetteer(mails(spark, sf_dir), spark.sql(inputs.LARGE_GAZETTEER, documents=inputs.read_table(spark, sf_dir, "documents")), text="raw_email")
    values = F.transform("semantic_items", lambda i: F.concat_ws(":", i["type"], i["value"]))
    return found.select("email_id", F.size("semantic_items").cast("long").alias("n_items"), F.md5(F.array_join(values, "|")).alias("items_md5"))


def _redacted_with_dictionary(spark, sf_dir):
    return S.redact(
        mails(spark, sf_dir), detect=lambda df: semantic.detect_with_gazetteer(df, gazetteer(spark))
    )


@query
def semantic_mask(spark, sf_dir):
    done = _redacted_with_dictionary(spark, sf_dir)
    return done.select(
        "email_id",
        "masked_email",
        joined(pii.finding_texts(F.col("detected_pii"))).alias("detected_pii"),
        "final_check_status",
    )


@query
def parse_model_list(spark, sf_dir):
    replies = inputs.run_shared(spark, sf_dir, inputs.REPLY_VIEW)
    items = semantic.parse_item_list(F.col("list_reply"))
    return replies.select("email_id", F.posexplode_outer(items).alias("item_pos", "i")).select(
        "email_id", "item_pos", "i.type", "i.value"
    )


@query
def pluggable_detector(spark, sf_dir):
    """A plug-in detector that answers with a JSON list; its replies go through the same parser."""

    def reply_of(texts):
        return ['[{"type": "project", "value": "Falcon"}]' if "Falcon" in t else "none" for t in texts]

    done = S.redact(mails(spark, sf_dir), detect=lambda df: semantic.detect_with_model(df, reply_of))
    return done.select("email_id", F.size("semantic_items").alias("n_items"), "masked_email")


@query
def mask_vs_reference(spark, sf_dir):
    """First 100 rows by key of a masked-text set (the limit is the operator)."""
    documents = inputs.read_table(spark, sf_dir, "documents")
    masked_set = documents.select(
        "doc_id", F.col("text").alias("unmasked_text"), F.replace("text", F.lit("@"), F.lit("[AT]")).alias("masked_text")
    )
    sample = D.first_rows(masked_set, "doc_id", fixed.SAMPLE_ROWS)
    return S.mask_beside_reference(sample, "doc_id").select(
        "doc_id", "original_email", "reference_masked_text", "masked_email", "final_check_status", "changed"
    )


@query
def hand_over_record(spark, sf_dir):
    batch = stored(spark, sf_dir).withColumn("risk_score", score.normalize_score(F.col("score_text")))
    return S.hand_over(batch).select(
        "id",
        "sender_domain",
        "raw_email",
        "is_phishing",
        "risk_score",
        "mitre_technique",
        "why_malicious_context",
        joined("high_risk_tokens").alias("high_risk_tokens"),
        "true_label",
        "masked_email",
        joined(pii.finding_texts(F.col("detected_pii"))).alias("detected_pii"),
        "final_check_status",
        "redaction_method",
        "changed",
    )


# --- parsing -----------------------------------------------------------------------------------


@query
def parse_headers(spark, sf_dir):
    sender = P.sender("raw_email")
    return mails(spark, sf_dir).select(
        "email_id", sender.alias("sender"), P.domain_of(sender).alias("sender_domain"), P.subject("raw_email").alias("subject")
    )


@query
def parse_body(spark, sf_dir):
    return mails(spark, sf_dir).select("email_id", P.body("raw_email").alias("email_body"))


@query
def parse_flags(spark, sf_dir):
    return P.parse_mail(mails(spark, sf_dir)).select("email_id", "parsed.metadata.*")


@query
def parse_mail(spark, sf_dir):
    return P.parse_mail(mails(spark, sf_dir)).select(
        "email_id", "parsed.sender_domain", "parsed.subject", "parsed.email_body", "parsed.metadata.*"
    )


@query
def context_record(spark, sf_dir):
    parsed = P.parse_mail(mails(spark, sf_dir))
    judged = score.rule_verdict(parsed, "raw_email", "verdict")
    return P.context_record(judged, with_label=True).withColumn("high_risk_tokens", joined("high_risk_tokens"))


@query
def analysis_text(spark, sf_dir):
    return stored(spark, sf_dir).select(
        "email_id", P.analysis_text(F.col("email_body"), F.col("raw_email")).alias("analysis_text")
    )


# --- scoring -----------------------------------------------------------------------------------


@query
def heuristic_verdict(spark, sf_dir):
    return ruled(spark, sf_dir).select(
        "email_id",
        "is_phishing",
        "risk_score",
        "mitre_technique",
        "why_malicious_context",
        joined("high_risk_tokens").alias("high_risk_tokens"),
    )


@query
def mitre_route(spark, sf_dir):
    return ruled(spark, sf_dir).groupBy("mitre_technique").agg(F.count(F.lit(1)).alias("n"))


@query
def benchmark_fallback_score(spark, sf_dir):
    return score.fallback_score(mails(spark, sf_dir), "raw_email").select("email_id", "fallback_score")


@query
def normalize_risk(spark, sf_dir):
    return stored(spark, sf_dir).select("email_id", score.normalize_score(F.col("score_text")).alias("risk_score"))


@query
def extract_mitre(spark, sf_dir):
    return stored(spark, sf_dir).select("email_id", score.technique_id(F.col("mitre_technique")).alias("technique_id"))


@query
def token_cleanup(spark, sf_dir):
    return stored(spark, sf_dir).select(
        "email_id", F.posexplode(clean_tokens(F.col("high_risk_tokens"))).alias("token_pos", "token")
    )


@query
def parse_model_verdict(spark, sf_dir):
    replies = inputs.run_shared(spark, sf_dir, inputs.REPLY_VIEW)
    return replies.withColumn("p", score.parse_reply(F.col("reply"))).select(
        "email_id",
        "p.verdict.is_phishing",
        "p.verdict.risk_score",
        "p.verdict.mitre_technique",
        "p.verdict.why_malicious_context",
        joined("p.verdict.high_risk_tokens").alias("high_risk_tokens"),
        "p.error",
    )


def _stored_model(df: DataFrame) -> DataFrame:
    """The stored fields as the model's answer."""
    fields = [F.col(f) for f in fixed.VERDICT_FIELDS if f != "risk_score"]
    verdict = F.struct(score.normalize_score(F.col("score_text")).alias("risk_score"), *fields)
    return df.withColumn("model", F.struct(verdict.alias("verdict"), F.col("error").alias("error")))


def _flat_verdict(column: str) -> list:
    names = [
        "email_body", "sender_domain", "is_phishing", "risk_score", "mitre_technique",
        "why_malicious_context", "verdict_source", "gemini_error",
    ]
    return [F.col(f"{column}.{n}").alias(n) for n in names] + [
        joined(f"{column}.high_risk_tokens").alias("high_risk_tokens")
    ]


def _routed(spark, sf_dir) -> DataFrame:
    answered = _stored_model(stored(spark, sf_dir).drop("sender_domain", "email_body"))
    return score.route_failures(P.parse_mail(answered), "raw_email")


@query
def failure_routing(spark, sf_dir):
    return _routed(spark, sf_dir).select("email_id", *_flat_verdict("routed"))


@query
def fallback_flag(spark, sf_dir):
    return _routed(spark, sf_dir).select("email_id", score.used_fallback(F.col("routed")).alias("used_fallback"))


@query
def normalize_verdict(spark, sf_dir):
    routed = stored(spark, sf_dir).withColumn(
        "routed",
        F.struct(
            "email_body",
            "sender_domain",
            "is_phishing",
            F.col("score_text").alias("risk_score"),
            "mitre_technique",
            "why_malicious_context",
            "high_risk_tokens",
            F.lit(None).cast("string").alias("verdict_source"),
            F.col("error").alias("gemini_error"),
        ),
    )
    return routed.withColumn("v", score.normalize_verdict(F.col("routed"), F.col("raw_email"))).select(
        "email_id", *_flat_verdict("v")
    )


@query
def pluggable_scorer(spark, sf_dir):
    """A plug-in scorer that reads the prompt; it fails on none, the rule takes over for garbage."""

    def reply_of(prompts):
        good = '{"is_phishing": true, "risk_score": 9, "mitre_technique": "T1534", "why_malicious_context": "urgent", "high_risk_tokens": ["urgent"]}'
        return [good if "urgent" in p else "cannot tell" for p in prompts]

    parsed = P.parse_mail(mails(spark, sf_dir)).withColumn("prompt", F.col("parsed.email_body"))
    return score.route_failures(score.score_with_model(parsed, reply_of), "raw_email").select(
        "email_id", *_flat_verdict("routed")
    )


def _flat_screen(df: DataFrame) -> DataFrame:
    return df.select(
        "email_id",
        "privacy.masked_email",
        joined("privacy.detected_pii").alias("detected_pii"),
        "privacy.pii_type",
        "privacy.final_check_status",
        "verdict.sender_domain",
        "verdict.is_phishing",
        "verdict.risk_score",
        "verdict.mitre_technique",
        "verdict.why_malicious_context",
        joined("verdict.high_risk_tokens").alias("high_risk_tokens"),
        "verdict.verdict_source",
        "verdict.gemini_error",
        "analysis_text",
        F.col("audit.status").alias("audit_status"),
        joined("audit.tokens_in_text").alias("tokens_in_text"),
        F.col("audit.necessity.perturbed_text").alias("perturbed_text"),
        F.col("audit.necessity.score_drop").alias("score_drop"),
        F.col("audit.necessity.is_trustworthy").alias("is_trustworthy"),
    )


@query
def screen_mail(spark, sf_dir):
    return _flat_screen(S.screen(mails(spark, sf_dir)))


@query
def screen_keep_domain(spark, sf_dir):
    """Senders by domain, read from the raw header although scoring sees masked text only."""
    screened = S.screen(mails(spark, sf_dir), keep_envelope_domain=True)
    return screened.groupBy(F.col("verdict.sender_domain").alias("sender_domain")).agg(
        F.count(F.lit(1)).alias("mails"), F.count_if("verdict.is_phishing").alias("phishing")
    )


@query
def screen_stream(spark, sf_dir):
    """The same screening as a file stream that stops when all files are done."""
    path = f"{sf_dir}/documents.parquet"
    stream = mail_stream(spark, table_files(path), spark.read.parquet(path).schema)
    arriving = stream.select(F.col("doc_id").alias("email_id"), F.col("text").alias("raw_email"))
    out = fresh_dir(spark, "stream")
    screen_available(arriving, f"{out}/data", f"{out}/checkpoint", lambda arrived: _flat_screen(S.screen(arrived))).awaitTermination()
    return spark.read.parquet(f"{out}/data")


@query
def cached_verdict(spark, sf_dir):
    saved = stored(spark, sf_dir).where(F.col("error").isNull()).withColumn(
        "risk_score", F.col("score_text")
    )
    # Two older verdicts of every second mail, one of them twice, do not count.
    older = saved.where("email_id % 2 = 0").withColumn("why_malicious_context", F.lit("outdated"))
    older = older.withColumn("run", F.explode(F.array(F.lit(None).cast("int"), F.lit(1), F.lit(1))))
    runs = older.unionByName(saved.withColumn("run", F.lit(2)))
    done = S.screen_with_stored(mails(spark, sf_dir), runs, version="run")
    return done.select("email_id", "privacy.final_check_status", "analysis_text", *_flat_verdict("verdict"))


@query
def integrated_context(spark, sf_dir):
    base = mails(spark, sf_dir)
    private = pii.normalize_privacy(S.redact(base), fixed.SOURCE_PRIVACY_LIVE).select("email_id", "privacy")
    judged = score.rule_verdict(P.parse_mail(base), "raw_email", "rule").select(
        "email_id", F.struct("rule.*", F.col("parsed.email_body").alias("email_body")).alias("verdict")
    )
    return S.integrate(private, judged).select(
        "email_id", "privacy.pii_type", "verdict.is_phishing", "verdict.risk_score", "analysis_text"
    )


@query
def benchmark_batch(spark, sf_dir):
    """Golden rows and mails side by side, each masked and scored."""
    own = mails(spark, sf_dir).select(
        (F.col("email_id") + 1 + len(fixed.GOLDEN_BENIGN) + len(fixed.GOLDEN_PHISHING)).alias("id"),
        P.subject("raw_email").alias("subject"),
        F.col("raw_email").alias("snippet"),
        F.when(F.col("true_label") == fixed.LABEL_PHISHING, 1)
        .when(F.col("true_label") == fixed.LABEL_BENIGN, 0)
        .alias("label"),
    )
    golden = D.golden_set(spark).select(F.col("id").cast("bigint").alias("id"), "subject", "snippet", "label")
    return S.benchmark_scores(golden.unionByName(own)).select("id", "subject", "label", "predicted_score")


@query
def attach_scores(spark, sf_dir):
    scored = ruled(spark, sf_dir).where(F.col("is_phishing")).select("email_id", "risk_score", F.lit(3).alias("run"))
    older = scored.select("email_id", F.lit(9.0).alias("risk_score"), F.explode(F.array(F.lit(1), F.lit(2))).alias("run"))
    records = mails(spark, sf_dir).select("email_id", "true_label")
    return score.attach_scores(records, scored.union(older), "email_id", version="run")


@query
def apply_overrides(spark, sf_dir):
    judged = mails(spark, sf_dir)
    overrides = judged.select("email_id", (F.col("email_id") % 17 == 0).alias("approved"))
    verdicts = score.rule_verdict(judged, "raw_email", "verdict")
    return score.apply_overrides(verdicts, overrides).select("email_id", "verdict.is_phishing", "action")


@query
def override_stream(spark, sf_dir):
    """Verdicts and approvals as two streams that arrive in turns, over two runs, one of them after a restart."""
    judged = ruled(spark, sf_dir).select("email_id", (F.lit(1_700_000_000) + F.col("email_id")).cast("timestamp").alias("at"), "is_phishing")
    approvals = judged.select("email_id", "at", (F.col("email_id") % 17 == 0).alias("approved"))
    folders = {name: fresh_dir(spark, name) for name in ("judged", "approvals", "changes", "changes-checkpoint")}
    streams = [
        spark.readStream.schema(df.schema).parquet(f"{folders[name]}/*") for name, df in (("judged", judged), ("approvals", approvals))
    ]
    changes = override_changes(*streams)
    # Half of the mails are judged before they are approved, the others after.
    for turn in (0, 1):
        judged.where(F.col("email_id") % 2 == turn).write.parquet(f"{folders['judged']}/{turn}")
        approvals.where(F.col("email_id") % 2 == 1 - turn).write.parquet(f"{folders['approvals']}/{turn}")
        write_changes(changes, folders["changes"], folders["changes-checkpoint"]).awaitTermination()
    return current_actions(spark.read.parquet(folders["changes"]))


# --- audit -------------------------------------------------------------------------------------


def _audited(spark, sf_dir, rescore: bool = False) -> DataFrame:
    judged = stored(spark, sf_dir).select(
        "email_id",
        "raw_email",
        P.analysis_text(F.col("email_body"), F.col("raw_email")).alias("analysis_text"),
        F.struct(
            "is_phishing",
            score.normalize_score(F.col("score_text")).alias("risk_score"),
            "mitre_technique",
            "high_risk_tokens",
        ).alias("verdict"),
    )
    return A.audit(judged, rescore=rescore)


@query
def text_tokens(spark, sf_dir):
    present = tokens_in_text(F.col("raw_email"), clean_tokens(F.col("high_risk_tokens")))
    return stored(spark, sf_dir).select("email_id", F.posexplode(present).alias("token_pos", "token"))


@query
def perturb(spark, sf_dir):
    tokens = clean_tokens(F.col("high_risk_tokens"))
    return stored(spark, sf_dir).select("email_id", A.perturb(F.col("raw_email"), tokens).alias("perturbed_text"))


def _flat_audit(df: DataFrame) -> DataFrame:
    return df.select(
        "email_id",
        "audit.status",
        "audit.message",
        "audit.risk_score",
        joined("audit.high_risk_tokens").alias("high_risk_tokens"),
        joined("audit.tokens_in_text").alias("tokens_in_text"),
        "audit.necessity.perturbed_text",
        "audit.necessity.perturbed_score",
        "audit.necessity.score_drop",
        "audit.necessity.is_trustworthy",
    )


@query
def audit_status(spark, sf_dir):
    return _flat_audit(_audited(spark, sf_dir))


@query
def audit_rescored(spark, sf_dir):
    return _flat_audit(_audited(spark, sf_dir, rescore=True))


@query
def token_spans(spark, sf_dir):
    return A.token_spans(ruled(spark, sf_dir), "raw_email", "high_risk_tokens")


@query
def adversarial_prompt(spark, sf_dir):
    return A.failed_feedback(_audited(spark, sf_dir), "analysis_text")


@query
def highlight_tokens(spark, sf_dir):
    return ruled(spark, sf_dir).select(
        "email_id", A.highlighted(F.col("raw_email"), F.col("high_risk_tokens")).alias("marked")
    )


# --- metrics -----------------------------------------------------------------------------------


@query
def confusion(spark, sf_dir):
    return M.confusion(ruled(spark, sf_dir))


@query
def quality_metrics(spark, sf_dir):
    """On stored verdicts, where a failed model leaves no prediction."""
    return M.quality(stored(spark, sf_dir))


@query
def quality_report(spark, sf_dir):
    return M.rounded_report(M.quality(stored(spark, sf_dir)))


@query
def error_rows(spark, sf_dir):
    return M.error_rows(stored(spark, sf_dir)).select("email_id", "type", "is_phishing", "true_label")


@query
def label_counts(spark, sf_dir):
    return M.label_counts(mails(spark, sf_dir))


@query
def class_balance(spark, sf_dir):
    sample = D.sample_per_class(typed_mails(spark, sf_dir))
    n = fixed.SAMPLE_PER_CLASS
    return M.class_balance(sample, {fixed.CLASS_PHISHING: n, fixed.CLASS_BENIGN: n}, "email_type")


@query
def threshold_predictions(spark, sf_dir):
    return labelled_scores(spark, sf_dir).select(
        "email_id", M.predict_at(F.col("predicted_score"), fixed.PHISHING_CUT).alias("predicted")
    )


@query
def confusion_cells(spark, sf_dir):
    said = M.predict_at(F.col("predicted_score"), fixed.ALPHA_DEFAULT)
    return M.confusion_cells(labelled_scores(spark, sf_dir).withColumn("predicted", said))


@query
def threshold_metrics(spark, sf_dir):
    return M.metrics_at(labelled_scores(spark, sf_dir), 0.3)


@query
def alpha_sweep(spark, sf_dir):
    return M.alpha_sweep(labelled_scores(spark, sf_dir))


@query
def pr_curve(spark, sf_dir):
    return M.pr_curve(labelled_scores(spark, sf_dir))


def _merged_counts(spark, sf_dir):
    """Counts of two halves of the mails, each stored by a run of its own, then merged."""
    states = []
    for half in (0, 1):
        path = fresh_dir(spark, "score-counts")
        part = labelled_scores(spark, sf_dir).where(F.col("email_id") % 2 == half)
        M.score_counts(part).write.parquet(path)
        states.append(spark.read.parquet(path))
    return M.merge_counts(*states)


@query
def alpha_sweep_merged(spark, sf_dir):
    return M.alpha_sweep_from(_merged_counts(spark, sf_dir))


@query
def pr_curve_merged(spark, sf_dir):
    return M.pr_curve_from(_merged_counts(spark, sf_dir))


@query
def operating_point(spark, sf_dir):
    return M.metrics_at(labelled_scores(spark, sf_dir), fixed.ALPHA_DEFAULT).select("alpha", "precision", "recall")


# --- retrieval and knowledge bases ----------------------------------------------------------------


def _centroids(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """All embeddings, and one mean vector per label as their knowledge base (ten rows)."""
    vectors = inputs.read_table(spark, sf_dir, "embeddings")
    dims = vectors.select(F.size("embedding")).first()[0]
    means = F.array(*[F.avg(F.get("embedding", F.lit(i))) for i in range(dims)])
    return vectors, vectors.groupBy("label").agg(means.alias("center"))


def _knn(spark, sf_dir, k):
    vectors, centers = _centroids(spark, sf_dir)
    near = retrieve.nearest(
        vectors, centers, k, key="vec_id", vector="embedding", kb_id="label", kb_vector="center"
    )
    return near.select("vec_id", F.posexplode("nearest").alias("rank", "n")).select(
        "vec_id", "rank", F.col("n.id").alias("kb_id"), F.round("n.distance", 6).alias("distance")
    )


@query
def knn_top2(spark, sf_dir):
    return _knn(spark, sf_dir, fixed.TOP_TECHNIQUES)


@query
def knn_top3(spark, sf_dir):
    return _knn(spark, sf_dir, fixed.TOP_EXAMPLES)


@query
def knn_large_kb(spark, sf_dir):
    """All embeddings as a knowledge base that is visited by balls, each asked for its neighbours."""
    vectors = inputs.read_table(spark, sf_dir, "embeddings")
    near = retrieve.nearest(vectors, vectors, fixed.TOP_EXAMPLES, key="vec_id", vector="embedding", kb_id="vec_id", kb_vector="embedding", max_rows=1)
    return near.select("vec_id", F.posexplode("nearest").alias("rank", "n")).select(
        "vec_id", "rank", F.col("n.id").alias("kb_id"), F.round("n.distance", 6).alias("distance")
    )


@query
def tfidf_retrieval(spark, sf_dir):
    """Every mail against the few-shot examples drawn from the labelled mails."""
    examples = D.build_fewshot(D.sample_per_class(typed_mails(spark, sf_dir)))
    near = tfidf.nearest_texts(mails(spark, sf_dir), tfidf.build_index(examples, "email_id", "email"), fixed.TOP_EXAMPLES)
    return near.select("email_id", "rank", F.col("id").alias("kb_id"), F.round("score", 6).alias("score"))


@query
def embed_plugin(spark, sf_dir):
    """Every mail through a plug-in model: here its length, its digits and its lines."""
    counts = E.embed_with_model(
        mails(spark, sf_dir), "raw_email", lambda texts: [[len(t), sum("0" <= c <= "9" for c in t), t.count("\n")] for t in texts]
    )
    names = ("n_chars", "n_digits", "n_breaks")
    return counts.select("email_id", *[F.get("vector", F.lit(i)).cast("long").alias(n) for i, n in enumerate(names)])


def technique_table(spark, sf_dir) -> DataFrame:
    """Documents in the shape of a technique list, most of them with an id outside the targets."""
    return inputs.run_shared(spark, sf_dir, inputs.TECHNIQUE_VIEW)


@query
def kb_build(spark, sf_dir):
    return K.build_kb(technique_table(spark, sf_dir), K.custom_indicators(spark))


@query
def kb_texts(spark, sf_dir):
    kb = K.build_kb(technique_table(spark, sf_dir), K.custom_indicators(spark))
    return kb.select("id", K.kb_text(F.col("name"), F.col("description"), F.col("indicators")).alias("kb_text"))


@query
def extracted_indicators(spark, sf_dir):
    return mails(spark, sf_dir).select("email_id", K.extract_indicators(F.col("raw_email")).alias("indicators"))


@query
def kb_upsert(spark, sf_dir):
    documents = inputs.read_table(spark, sf_dir, "documents")
    pages = inputs.read_table(spark, sf_dir, "pages")
    current = documents.select(
        F.col("source").alias("id"), (F.col("doc_id") * 2).alias("version"), F.md5("text").alias("payload")
    )
    incoming = pages.select(
        F.concat(F.lit("src"), (F.col("page_id") % 25).cast("string")).alias("id"),
        (F.col("page_id") * 14 + 1).alias("version"),
        F.col("url").alias("payload"),
    )
    return K.upsert(current, incoming)


@query
def kb_upsert_stored(spark, sf_dir):
    """The same upsert into a stored knowledge base, in three rounds, read back from its buckets."""
    documents = inputs.read_table(spark, sf_dir, "documents")
    pages = inputs.read_table(spark, sf_dir, "pages")
    rounds = [
        documents.select(F.col("source").alias("id"), (F.col("doc_id") * 2).alias("version"), F.md5("text").alias("payload")),
        *[
            pages.where(F.col("page_id") % 2 == half).select(
                F.concat(F.lit("src"), (F.col("page_id") % 25).cast("string")).alias("id"),
                (F.col("page_id") * 14 + 1).alias("version"),
                F.col("url").alias("payload"),
            )
            for half in (0, 1)
        ],
    ]
    store = KbStore(spark, fresh_dir(spark, "kb"), rounds[0].schema, buckets=8)
    for rows in rounds:
        store.upsert(rows)
    return store.read()


def _with_techniques(spark, sf_dir, k=fixed.TOP_TECHNIQUES) -> DataFrame:
    kb = K.custom_indicators(spark).withColumnRenamed("custom", "indicators")
    return retrieve.rank_by_indicators(
        mails(spark, sf_dir), K.indicator_phrases(kb), k, text="raw_email"
    )


@query
def indicator_match(spark, sf_dir):
    return _with_techniques(spark, sf_dir).select("email_id", F.posexplode("techniques").alias("rank", "t")).select(
        "email_id", "rank", F.col("t.id").alias("technique"), F.col("t.hits").cast("bigint").alias("hits")
    )


def _contexts(spark, sf_dir) -> DataFrame:
    """Each mail's technique lines (matched by indicator) and its own line as an example."""
    custom = F.create_map(*[F.lit(x) for pair in fixed.CUSTOM_INDICATORS.items() for x in pair])
    described = F.transform(
        "techniques",
        lambda t: F.struct(t["id"].alias("technique"), F.element_at(custom, t["id"]).alias("description")),
    )
    example = F.array(
        F.struct(
            F.col("raw_email").alias("email"),
            F.coalesce("true_label", F.lit(fixed.LABEL_DEFAULT)).alias("label"),
            F.lit("own text").alias("reason"),
        )
    )
    return _with_techniques(spark, sf_dir).select(
        "email_id",
        "raw_email",
        retrieve.technique_context(described).alias("technique_lines"),
        retrieve.example_context(example).alias("example_lines"),
    )


@query
def context_strings(spark, sf_dir):
    return _contexts(spark, sf_dir).select("email_id", "technique_lines", "example_lines")


@query
def judge_prompt(spark, sf_dir):
    parsed = P.parse_mail(_contexts(spark, sf_dir))
    return parsed.select(
        "email_id",
        retrieve.judge_prompt(F.col("parsed"), F.col("technique_lines"), F.col("example_lines")).alias("prompt"),
    )


def _answer_from_context(prompts):
    """Names the techniques and labels that the prompt lists, or answers nothing of use."""
    replies = []
    for prompt in prompts:
        context = prompt.rsplit("Known techniques close to this mail:", 1)[1]
        ids = re.findall(r"^- (\S+): ", context, re.MULTILINE)
        labels = re.findall(r"^Label: (\w+), Reason: ", context, re.MULTILINE)
        verdict = {"is_phishing": True, "risk_score": 0.9, "mitre_technique": (ids or ["none"])[0]}
        verdict |= {"why_malicious_context": f"{','.join(ids)}|{','.join(labels)}", "high_risk_tokens": ["click"]}
        replies.append(json.dumps(verdict) if any("T1566" in i for i in ids) else "cannot tell")
    return replies


@query
def screen_with_context(spark, sf_dir):
    """The whole flow with retrieval: given vectors, nearest techniques and examples, prompt, plug-in, rule."""

    def placed(number: Column) -> Column:
        return F.array((number % 7).cast("float"), (number % 5).cast("float")).alias("vector")

    numbered = [(i, k, v) for i, (k, v) in enumerate(fixed.CUSTOM_INDICATORS.items())]
    techniques = spark.createDataFrame(numbered, "n int, id string, description string")
    examples = D.build_fewshot(D.sample_per_class(typed_mails(spark, sf_dir)))
    scorer = S.score_in_context(
        techniques.select("id", "description", placed(F.col("n"))),
        examples.select(F.col("email_id").alias("id"), "email", "label", "reason", placed(F.col("email_id"))),
        _answer_from_context,
    )
    screened = S.screen(mails(spark, sf_dir).select("*", placed(F.col("email_id"))), score=scorer)
    fields = ["is_phishing", "risk_score", "mitre_technique", "why_malicious_context", "verdict_source", "gemini_error"]
    return screened.select("email_id", *[f"verdict.{f}" for f in fields])


# --- data sets, resume, order, sinks ----------------------------------------------------------------


@query
def class_filter(spark, sf_dir):
    return typed_mails(spark, sf_dir).where(F.col("email_type") == fixed.CLASS_PHISHING).select("email_id", "email_type")


@query
def stratified_split(spark, sf_dir):
    sample = D.split_sample(D.sample_per_class(typed_mails(spark, sf_dir)))
    return sample.select("email_id", "email_type", F.col("sample_rank").cast("bigint").alias("sample_rank"), "part")


@query
def fewshot_build(spark, sf_dir):
    return D.build_fewshot(D.sample_per_class(typed_mails(spark, sf_dir)))


@query
def test_set_build(spark, sf_dir):
    return D.build_test_set(D.sample_per_class(typed_mails(spark, sf_dir)))


@query
def resume_pending(spark, sf_dir):
    done = stored(spark, sf_dir).where(F.col("error").isNull()).select("email_id")
    return D.pending(mails(spark, sf_dir), done).select("email_id", "true_label")


@query
def stage_log_order(spark, sf_dir):
    return D.order_stage_log(inputs.run_shared(spark, sf_dir, inputs.STAGE_LOG_VIEW), key="event_id")


@query
def sink_roundtrip_json(spark, sf_dir):
    path = fresh_dir(spark, "json")
    writers.write_json(stored(spark, sf_dir).drop("score_text", "tokens_text"), path)
    schema = "email_id bigint, raw_email string, true_label string, is_phishing boolean, mitre_technique string, high_risk_tokens array<string>"
    back = spark.read.schema(schema).json(path)
    return back.withColumn("high_risk_tokens", joined("high_risk_tokens"))


def _array_files(spark, rows: DataFrame) -> str:
    path = fresh_dir(spark, "arrays")
    write_json_arrays(rows, path)
    return path


@query
def scan_labelled(spark, sf_dir):
    """Labelled mails as array files, read back in several tasks a file."""
    path = _array_files(spark, mails(spark, sf_dir).select("raw_email", "true_label"))
    back = readers.read_labelled_mails(spark, path)
    return back.select(F.md5("raw_email").alias("mail_md5"), F.length("raw_email").cast("long").alias("n_chars"), "true_label")


@query
def scan_techniques(spark, sf_dir):
    rows = technique_table(spark, sf_dir).select("id", "name", "description", F.lit(None).cast("string").alias("indicators"))
    back = readers.read_techniques(spark, _array_files(spark, rows))
    return back.select("id", "name", F.md5("description").alias("description_md5"), "indicators")


@query
def scan_examples(spark, sf_dir):
    examples = D.build_fewshot(D.sample_per_class(typed_mails(spark, sf_dir)))
    return readers.read_examples(spark, _array_files(spark, examples.drop("email_id")))


@query
def sink_roundtrip_csv(spark, sf_dir):
    path = fresh_dir(spark, "csv")
    rows = stored(spark, sf_dir).select("email_id", "true_label", "is_phishing", "high_risk_tokens")
    writers.write_csv(rows, path)
    return spark.read.schema("email_id bigint, true_label string, is_phishing boolean, high_risk_tokens string").csv(
        path, header=True, escape='"'
    )


@query
def sink_report(spark, sf_dir):
    path = fresh_dir(spark, "report")
    writers.write_report(stored(spark, sf_dir), path)
    schema = (
        "total bigint, TP bigint, TN bigint, FP bigint, FN bigint, "
        "precision double, recall double, f1_score double, accuracy double"
    )
    return spark.read.schema(schema).json(f"{path}/report")


@query
def stored_verdict_scan(spark, sf_dir):
    """Stored verdicts written once as JSON lines and read back through the typed reader."""
    path = fresh_dir(spark, "verdicts")
    batch = stored(spark, sf_dir).withColumn("risk_score", score.normalize_score(F.col("score_text")))
    fields = ["sender_domain", "email_body", *fixed.VERDICT_FIELDS, "true_label"]
    writers.write_json(batch.select(*fields), path)
    back = readers.read_verdicts(spark, path, array_file=False)
    return (
        back.groupBy("true_label", "is_phishing", "mitre_technique")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("high_risk_tokens")).alias("tokens"))
    )

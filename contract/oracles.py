"""SQL for DuckDB, one text per checked query.

DuckDB's regex engine has no look-around, and its word boundary knows ASCII only.  So word
boundaries are made visible first: every run of word characters (letters, numbers, underscore) is
wrapped in two marker characters on each side, the patterns name the markers, and the markers are
taken out again.  Two markers per side let two matches touch.
"""

from veilpost import fixed

from veilpost.operators.audit import FEEDBACK_TEMPLATE
from veilpost.operators.retrieve import JUDGE_TEMPLATE

from . import inputs
from .inputs import duck

M = r"\x01"
DG = r"\p{Nd}"
SPACES = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"

ORACLES = {}


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


EMAILS = f"({duck(inputs.EMAIL_VIEW)})"
STORED = f"(SELECT *, string_split(tokens_text, '|') AS high_risk_tokens FROM ({duck(inputs.VERDICT_VIEW)}))"
REPLIES = f"({duck(inputs.REPLY_VIEW)})"
TECHNIQUES = f"({duck(inputs.TECHNIQUE_VIEW)})"


# --- masking -----------------------------------------------------------------------------------

_SEP = f"(?:{M}{M}[-{SPACES}]{M}{M})?"
_PAIR = f"{M}{M}"
MARKED = {
    "EMAIL": f"{M}[a-zA-Z0-9_.+-](?:[a-zA-Z0-9_.+-]|{_PAIR})*@(?:[a-zA-Z0-9-]|{_PAIR})+\\.(?:[a-zA-Z0-9.-]|{_PAIR})+{M}",
    "PHONE": f"{M}09{DG}{{2}}{_SEP}{DG}{{3}}{_SEP}{DG}{{3}}{M}",
    "TW_ID": f"{M}[A-Z][12]{DG}{{8}}{M}",
    "CARD": f"{M}(?:{DG}{{4}}{_SEP}){{3}}{DG}{{4}}{M}",
    "IPV4": f"{M}(?:{DG}{{1,3}}{_PAIR}\\.{_PAIR}){{3}}{DG}{{1,3}}{M}",
    "IPV6": f"{M}(?:[0-9a-fA-F]{{1,4}}{_PAIR}:{_PAIR}){{2,7}}[0-9a-fA-F]{{1,4}}{M}",
    "URL": f"https?://[^{SPACES})]+",
    "IBAN": f"{M}[A-Z]{{2}}{DG}{{2}}[A-Z0-9]{{10,30}}{M}",
    "BIC": f"{M}[A-Z]{{6}}[A-Z0-9]{{2}}(?:[A-Z0-9]{{3}})?{M}",
    "ETH_ADDRESS": f"{M}0x[a-fA-F0-9]{{40}}{M}",
    "BTC_ADDRESS": f"{M}[13][a-km-zA-HJ-NP-Z1-9]{{25,34}}{M}",
}


def marked(pii_type: str, text: str) -> str:
    runs = {"URL": None, "TW_ID": "([A-Za-z0-9]+)"}.get(pii_type, r"([\p{L}\p{N}_]+)")
    if runs is None:
        return text
    return f"regexp_replace({text}, '{runs}', chr(1) || chr(1) || '\\1' || chr(1) || chr(1), 'g')"


def count_sql(pii_type: str, text: str) -> str:
    return f"len(regexp_extract_all({marked(pii_type, text)}, '{MARKED[pii_type]}'))"


def mask_sql(pii_type: str, text: str) -> str:
    return f"replace(regexp_replace({marked(pii_type, text)}, '{MARKED[pii_type]}', '[MASKED_{pii_type}]', 'g'), chr(1), '')"


def masked_sql(source: str, text: str) -> str:
    """`source` plus masked_email, detected (list of structs) and remaining (list of structs)."""
    # Every step is materialized: inlined, the steps would be evaluated over and over.
    steps = [f"WITH s_0 AS MATERIALIZED (SELECT *, {text} AS t_0 FROM {source})"]
    for i, t in enumerate(fixed.MASKING_ORDER):
        steps.append(
            f"s_{i + 1} AS MATERIALIZED (SELECT * EXCLUDE (t_{i}), {count_sql(t, f't_{i}')} AS n_{t}, "
            f"{mask_sql(t, f't_{i}')} AS t_{i + 1} FROM s_{i})"
        )
    found = ", ".join(
        f"{{'type': '{t}', 'method': 'Regex', 'count': n_{t}, 'masked_as': '[MASKED_{t}]'}}" for t in fixed.MASKING_ORDER
    )
    last = len(fixed.MASKING_ORDER)
    drop = ", ".join([f"t_{last}"] + [f"n_{t}" for t in fixed.MASKING_ORDER])
    return (
        f"({', '.join(steps)} SELECT * EXCLUDE ({drop}), t_{last} AS masked_email, "
        f"list_filter([{found}], lambda f: f.count > 0) AS detected FROM s_{last})"
    )


def checked_sql(source: str, text: str = "masked_email") -> str:
    left = ", ".join(f"{{'type': '{t}', 'count': {count_sql(t, text)}}}" for t in fixed.PII_PATTERNS)
    return (
        f"(WITH c_0 AS MATERIALIZED (SELECT * FROM {source}), "
        f"c_1 AS MATERIALIZED (SELECT *, list_filter([{left}], lambda r: r.count > 0) AS remaining FROM c_0) "
        f"SELECT *, CASE WHEN len(remaining) > 0 THEN 'FAIL' ELSE 'PASS' END AS final_check_status FROM c_1)"
    )


def finding_text(lst: str) -> str:
    return (
        f"array_to_string(list_transform({lst}, lambda f: f.masked_as || ' x' || CAST(f.count AS VARCHAR)"
        f" || ' (' || f.type || ' via ' || f.method || ')'), '|')"
    )


REDACTED = checked_sql(masked_sql(EMAILS, "raw_email"))

ORACLES["pii_mask"] = f"SELECT email_id, masked_email, final_check_status FROM {REDACTED}"
ORACLES["pii_findings"] = (
    f"SELECT email_id, f.type AS type, f.method AS method, f.count AS count, f.masked_as AS masked_as "
    f"FROM (SELECT email_id, unnest(detected) AS f FROM {masked_sql(EMAILS, 'raw_email')})"
)
ORACLES["pii_residual"] = (
    f"SELECT email_id, r.type AS type, r.count AS count "
    f"FROM (SELECT email_id, unnest(remaining) AS r FROM {checked_sql(EMAILS, 'raw_email')})"
)
for _t in fixed.PII_PATTERNS:
    ORACLES[f"pii_{_t.lower()}"] = (
        f"SELECT email_id, {count_sql(_t, 'raw_email')} AS n, {mask_sql(_t, 'raw_email')} AS masked FROM {EMAILS}"
    )
ORACLES["pii_pages"] = (
    f"SELECT page_id, masked_email, final_check_status FROM {checked_sql(masked_sql('pages', 'html'))}"
)
ORACLES["pii_finding_totals"] = (
    f"SELECT f.type AS type, count(*) AS mails, CAST(sum(f.count) AS BIGINT) AS matches "
    f"FROM (SELECT unnest(detected) AS f FROM {masked_sql(EMAILS, 'raw_email')}) GROUP BY 1"
)
ORACLES["pii_coverage"] = (
    f"SELECT total, changed, total - changed AS unchanged, changed / total AS coverage_rate FROM "
    f"(SELECT count(*) AS total, count(*) FILTER (WHERE text <> masked_email) AS changed FROM {masked_sql('documents', 'text')})"
)
_TYPES = "list_sort(list_distinct(list_transform(detected, lambda f: f.type)))"
_PRIVACY = (
    f"{finding_text('detected')} AS detected_pii, "
    f"CASE WHEN len(detected) = 0 THEN 'NONE' ELSE array_to_string({_TYPES}, ', ') END AS pii_type"
)
ORACLES["privacy_record"] = (
    f"SELECT email_id, {_PRIVACY}, 'Regex' AS redaction_method, final_check_status, "
    f"array_to_string(list_transform(remaining, lambda r: r.type || ' x' || CAST(r.count AS VARCHAR)), '|') AS remaining_pii, "
    f"'{fixed.SOURCE_PRIVACY_LIVE}' AS source FROM {REDACTED}"
)


def with_gazetteer(source: str) -> str:
    return (
        f"(SELECT m.*, (SELECT list({{'type': g.type, 'value': g.value}} ORDER BY g.item_no) FROM ({inputs.GAZETTEER}) g "
        f"WHERE contains(m.masked_email, g.value)) AS items FROM {source} m)"
    )


ORACLES["semantic_dictionary"] = (
    f"SELECT email_id, g.type AS type, g.value AS value, "
    f"CAST(row_number() OVER (PARTITION BY email_id ORDER BY g.item_no) - 1 AS INTEGER) AS item_pos "
    f"FROM {masked_sql(EMAILS, 'raw_email')} m, ({inputs.GAZETTEER}) g WHERE contains(m.masked_email, g.value)"
)


def semantic_masked_sql(source: str) -> str:
    """Longest value first, item order on ties; the fold carries text and findings along."""
    ordered = (
        "list_transform(list_sort(list_transform(coalesce(items, []), lambda i, p: "
        "{'k': -length(i.value), 'p': p, 'type': i.type, 'value': i.value})), "
        "lambda s: {'t': '', 'found': [{'type': s.type, 'method': s.value, 'count': 0::BIGINT, 'masked_as': ''}]})"
    )
    value, kind = "x.found[1].method", "x.found[1].type"
    step = (
        f"lambda acc, x: {{'t': replace(acc.t, {value}, '[MASKED_' || {kind} || ']'), "
        f"'found': list_append(acc.found, {{'type': {kind}, 'method': 'Ollama LLM', "
        f"'count': CAST((length(acc.t) - length(replace(acc.t, {value}, ''))) / length({value}) AS BIGINT), "
        f"'masked_as': '[MASKED_' || {kind} || ']'}})}}"
    )
    return (
        f"(SELECT * EXCLUDE (masked_email, detected, s), s.t AS masked_email, s.found AS detected FROM "
        f"(SELECT *, list_reduce({ordered}, {step}, {{'t': masked_email, 'found': detected}}) AS s FROM {source}))"
    )


ORACLES["semantic_mask"] = (
    f"SELECT email_id, masked_email, {finding_text('detected')} AS detected_pii, final_check_status FROM "
    f"{checked_sql(semantic_masked_sql(with_gazetteer(masked_sql(EMAILS, 'raw_email'))))}"
)
_FALCON = "CASE WHEN contains(masked_email, 'Falcon') THEN [{'type': 'PROJECT', 'value': 'Falcon'}] END AS items"
ORACLES["pluggable_detector"] = (
    f"SELECT email_id, masked_email, CAST(len(coalesce(items, [])) AS INTEGER) AS n_items FROM "
    f"{semantic_masked_sql(f'(SELECT *, {_FALCON} FROM ' + masked_sql(EMAILS, 'raw_email') + ')')}"
)
ORACLES["mask_vs_reference"] = (
    f"SELECT doc_id, text AS original_email, replace(text, '@', '[AT]') AS reference_masked_text, masked_email, final_check_status, "
    f"text <> masked_email AS changed FROM "
    f"{checked_sql(masked_sql('(SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 100)', 'text'))}"
)


def norm_score(text: str) -> str:
    v = f"TRY_CAST({text} AS DOUBLE)"
    return (
        f"CASE WHEN {v} IS NULL OR isnan({v}) THEN 0.0::DOUBLE "
        f"ELSE least(greatest(CASE WHEN {v} > 1 THEN {v} / 10 ELSE {v} END, 0.0::DOUBLE), 1.0::DOUBLE) END"
    )


_BATCH = f"(SELECT * EXCLUDE (raw_email), coalesce(email_body, '') AS raw_email FROM {STORED})"
ORACLES["hand_over_record"] = (
    f"SELECT email_id AS id, sender_domain, raw_email, is_phishing, {norm_score('score_text')} AS risk_score, mitre_technique, "
    f"why_malicious_context, tokens_text AS high_risk_tokens, true_label, masked_email, {finding_text('detected')} AS detected_pii, "
    f"CASE WHEN raw_email = '' THEN 'NO_EMAIL_BODY' ELSE final_check_status END AS final_check_status, "
    f"'Regex + Ollama LLM' AS redaction_method, raw_email <> masked_email AS changed "
    f"FROM {checked_sql(masked_sql(_BATCH, 'raw_email'))}"
)

# --- parsing -----------------------------------------------------------------------------------


def strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^[{SPACES}]+', ''), '[{SPACES}]+$', '')"


def sender(raw: str) -> str:
    line = f"regexp_extract({raw}, '(?i)From:[{SPACES}]*([^\\n]+)', 1)"
    return f"CASE WHEN {line} = '' THEN 'unknown@unknown.com' ELSE {strip(line)} END"


def domain(raw: str) -> str:
    found = f"regexp_extract({sender(raw)}, '@([\\p{{L}}\\p{{N}}_.-]+)', 1)"
    return f"CASE WHEN {found} = '' THEN 'not_extracted' ELSE {found} END"


def subject(raw: str) -> str:
    return strip(f"regexp_extract({raw}, '(?i)Subject:[{SPACES}]*([^\\n]+)', 1)")


def body(raw: str) -> str:
    pieces = f"string_split_regex({raw}, '(?i)Subject:[^\\n]+\\n')"
    return f"CASE WHEN len({pieces}) > 1 THEN {strip(f'{pieces}[-1]')} ELSE {raw} END"


def any_of(text: str, words: list) -> str:
    return "(" + " OR ".join(f"contains({text}, {q(w)})" for w in words) + ")"


FLAGS = (
    f"{any_of('raw_email', fixed.URGENCY_WORDS)} AS has_urgency_keywords, "
    f"{any_of('raw_email', fixed.MONEY_WORDS)} AS has_money_request, length(raw_email) AS char_count"
)
ORACLES["parse_headers"] = (
    f"SELECT email_id, {sender('raw_email')} AS sender, {domain('raw_email')} AS sender_domain, {subject('raw_email')} AS subject FROM {EMAILS}"
)
ORACLES["parse_body"] = f"SELECT email_id, {body('raw_email')} AS email_body FROM {EMAILS}"
ORACLES["parse_flags"] = f"SELECT email_id, {FLAGS} FROM {EMAILS}"
ORACLES["parse_mail"] = (
    f"SELECT email_id, {domain('raw_email')} AS sender_domain, {subject('raw_email')} AS subject, "
    f"{body('raw_email')} AS email_body, {FLAGS} FROM {EMAILS}"
)
_ANALYSIS = "coalesce(nullif(email_body, ''), nullif(raw_email, ''), '')"
ORACLES["analysis_text"] = f"SELECT email_id, {_ANALYSIS} AS analysis_text FROM {STORED}"

# --- scoring -----------------------------------------------------------------------------------


def rule_sql(source: str, text: str, prefix: str = "") -> str:
    """`source` plus the rule's five verdict fields; weights are added as doubles in table order."""
    low = f"lower({text})"
    score = " + ".join(
        ["0.0::DOUBLE"] + [f"(CASE WHEN contains(low, {q(p)}) THEN {w}::DOUBLE ELSE 0.0::DOUBLE END)" for p, w in fixed.SIGNALS]
    )
    tokens = ", ".join(f"CASE WHEN contains(low, {q(p)}) THEN {q(p)} END" for p, _ in fixed.SIGNALS)
    p = prefix
    return (
        f"(SELECT * EXCLUDE (low, raw_score, all_tokens), raw_score >= 0.55::DOUBLE AS {p}is_phishing, raw_score AS {p}risk_score, "
        f"CASE WHEN contains(low, 'wire') OR contains(low, 'payment') THEN 'T1684.001 (BEC / Wire Transfer)' "
        f"WHEN contains(low, 'click') OR contains(low, 'portal') THEN 'T1566.002 (Phishing Link)' "
        f"ELSE 'T1566.001 (Phishing Attachment / Lure)' END AS {p}mitre_technique, "
        f"'Heuristic pre-screen on sanitized text — ' || CAST(len(all_tokens) AS VARCHAR) || ' urgency/payment signals' AS {p}why_malicious_context, "
        f"all_tokens[1:8] AS {p}high_risk_tokens "
        f"FROM (SELECT *, least(greatest({score}, 0.0::DOUBLE), 0.96::DOUBLE) AS raw_score, "
        f"list_filter([{tokens}], lambda x: x IS NOT NULL) AS all_tokens FROM (SELECT *, {low} AS low FROM {source})))"
    )


def joined(lst: str) -> str:
    return f"array_to_string({lst}, '|')"


RULED = rule_sql(EMAILS, "raw_email")
ORACLES["heuristic_verdict"] = (
    f"SELECT email_id, is_phishing, risk_score, mitre_technique, why_malicious_context, "
    f"{joined('high_risk_tokens')} AS high_risk_tokens FROM {RULED}"
)
ORACLES["context_record"] = (
    f"SELECT email_id, {domain('raw_email')} AS sender_domain, {body('raw_email')} AS email_body, is_phishing, risk_score, "
    f"mitre_technique, why_malicious_context, {joined('high_risk_tokens')} AS high_risk_tokens, "
    f"coalesce(true_label, 'unknown') AS true_label FROM {RULED}"
)
ORACLES["mitre_route"] = f"SELECT mitre_technique, count(*) AS n FROM {RULED} GROUP BY 1"


def fallback_sql(source: str, text: str) -> str:
    low = f"lower({text})"
    return (
        f"(SELECT *, CASE WHEN {any_of(low, fixed.FALLBACK_PHISHING_WORDS)} THEN 0.85::DOUBLE "
        f"WHEN {any_of(low, fixed.FALLBACK_BENIGN_WORDS)} THEN 0.15::DOUBLE ELSE risk_score END AS fallback_score "
        f"FROM {rule_sql(source, text)})"
    )


ORACLES["benchmark_fallback_score"] = f"SELECT email_id, fallback_score FROM {fallback_sql(EMAILS, 'raw_email')}"
ORACLES["normalize_risk"] = f"SELECT email_id, {norm_score('score_text')} AS risk_score FROM {STORED}"
ORACLES["extract_mitre"] = (
    f"SELECT email_id, coalesce(nullif(regexp_extract(mitre_technique, 'T[0-9]{{4}}(?:\\.[0-9]{{3}})?'), ''), 'UNKNOWN') AS technique_id FROM {STORED}"
)


def clean(tokens: str) -> str:
    stripped = f"list_transform({tokens}, lambda t: {strip('t')})"
    return f"list_filter({stripped}, lambda t: t <> '')"


def present(text: str, tokens: str) -> str:
    return f"list_filter({tokens}, lambda t: contains(lower({text}), lower(t)))"


def unnested(lst: str, source: str) -> str:
    return (
        f"SELECT email_id, CAST(pos - 1 AS INTEGER) AS token_pos, token FROM "
        f"(SELECT email_id, unnest(lst) AS token, generate_subscripts(lst, 1) AS pos FROM (SELECT email_id, {lst} AS lst FROM {source}))"
    )


ORACLES["token_cleanup"] = unnested(clean("high_risk_tokens"), STORED)
ORACLES["text_tokens"] = unnested(present("raw_email", clean("high_risk_tokens")), STORED)


def parsed_replies() -> str:
    """Replies by kind: the text was built from the number, so the verdict follows from it too."""
    return (
        f"SELECT email_id, "
        f"CASE email_id % 6 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true WHEN 3 THEN true END AS is_phishing, "
        f"CASE email_id % 6 WHEN 0 THEN CAST('0.9' || CAST(email_id % 10 AS VARCHAR) AS DOUBLE) WHEN 1 THEN 0.1::DOUBLE WHEN 2 THEN 8.0::DOUBLE "
        f"WHEN 3 THEN 0.7::DOUBLE ELSE 0.0::DOUBLE END AS risk_score, "
        f"CASE email_id % 6 WHEN 0 THEN 'T1566.002' WHEN 1 THEN 'none' WHEN 2 THEN 'T1534' WHEN 3 THEN NULL ELSE 'unknown' END AS mitre_technique, "
        f"CASE email_id % 6 WHEN 0 THEN 'asks for credentials' WHEN 1 THEN 'routine' WHEN 2 THEN 'internal' WHEN 3 THEN NULL ELSE 'Parse failed' END AS why_malicious_context, "
        f"CASE email_id % 6 WHEN 0 THEN 'verify|click' WHEN 2 THEN 'wire' WHEN 3 THEN NULL ELSE '' END AS high_risk_tokens, "
        f"CASE WHEN email_id % 6 IN (4, 5) THEN 'parse_failed' END AS error FROM {REPLIES}"
    )


ORACLES["parse_model_verdict"] = parsed_replies()
ORACLES["parse_model_list"] = (
    f"SELECT email_id, 0 AS item_pos, 'NAME' AS type, 'Person ' || CAST(email_id AS VARCHAR) AS value FROM {REPLIES} WHERE email_id % 6 = 0 "
    f"UNION ALL SELECT email_id, 1, 'COMPANY', 'Acme' FROM {REPLIES} WHERE email_id % 6 = 0 "
    f"UNION ALL SELECT email_id, 0, 'PROJECT', 'Falcon' FROM {REPLIES} WHERE email_id % 6 = 1 "
    f"UNION ALL SELECT email_id, NULL, NULL, NULL FROM {REPLIES} WHERE email_id % 6 > 1"
)

_NO_COLUMNS = f"(SELECT * EXCLUDE (sender_domain, email_body) FROM {STORED})"
_ROUTED_RULE = rule_sql(_NO_COLUMNS, "raw_email", "r_")


def routed(names: dict) -> str:
    picks = ", ".join(f"CASE WHEN error IS NOT NULL THEN r_{n} ELSE {model} END AS {n}" for n, model in names.items())
    return (
        f"SELECT email_id, CASE WHEN error IS NOT NULL THEN raw_email ELSE {body('raw_email')} END AS email_body, "
        f"{domain('raw_email')} AS sender_domain, {picks}, "
        f"CASE WHEN error IS NOT NULL THEN 'Gemini unavailable (' || error || ') — ' || r_why_malicious_context ELSE why_malicious_context END AS why_malicious_context, "
        f"array_to_string(CASE WHEN error IS NOT NULL THEN r_high_risk_tokens ELSE high_risk_tokens END, '|') AS high_risk_tokens, "
        f"CASE WHEN error IS NOT NULL THEN 'heuristic_fallback' ELSE 'gemini' END AS verdict_source, error AS gemini_error "
    )


ORACLES["failure_routing"] = (
    routed({"is_phishing": "is_phishing", "risk_score": norm_score("score_text"), "mitre_technique": "mitre_technique"})
    + f"FROM {_ROUTED_RULE}"
)
_URGENT = f"contains({body('raw_email')}, 'urgent')"
ORACLES["pluggable_scorer"] = (
    f"SELECT email_id, CASE WHEN {_URGENT} THEN {body('raw_email')} ELSE raw_email END AS email_body, {domain('raw_email')} AS sender_domain, "
    f"CASE WHEN {_URGENT} THEN true ELSE is_phishing END AS is_phishing, CASE WHEN {_URGENT} THEN 9.0::DOUBLE ELSE risk_score END AS risk_score, "
    f"CASE WHEN {_URGENT} THEN 'T1534' ELSE mitre_technique END AS mitre_technique, "
    f"CASE WHEN {_URGENT} THEN 'urgent' ELSE 'Gemini unavailable (parse_failed) — ' || why_malicious_context END AS why_malicious_context, "
    f"CASE WHEN {_URGENT} THEN 'urgent' ELSE {joined('high_risk_tokens')} END AS high_risk_tokens, "
    f"CASE WHEN {_URGENT} THEN 'gemini' ELSE 'heuristic_fallback' END AS verdict_source, "
    f"CASE WHEN NOT {_URGENT} THEN 'parse_failed' END AS gemini_error FROM {RULED}"
)
ORACLES["fallback_flag"] = f"SELECT email_id, error IS NOT NULL AS used_fallback FROM {STORED}"


def normalized(raw: str) -> str:
    """Select list of a stored verdict with its defaults filled in."""
    return (
        f"coalesce(nullif(email_body, ''), {raw}, '') AS email_body, "
        f"coalesce(nullif(sender_domain, ''), 'not_extracted') AS sender_domain, coalesce(is_phishing, false) AS is_phishing, "
        f"{norm_score('score_text')} AS risk_score, coalesce(mitre_technique, 'UNKNOWN') AS mitre_technique, "
        f"coalesce(why_malicious_context, 'No forensic context returned.') AS why_malicious_context, "
        f"{joined(clean('high_risk_tokens'))} AS high_risk_tokens, 'gemini' AS verdict_source"
    )


ORACLES["normalize_verdict"] = f"SELECT email_id, {normalized('raw_email')}, error AS gemini_error FROM {STORED}"
# Mails whose stored verdict is missing are judged by the rule on their masked text.
_KEPT = {n: f"CASE WHEN error IS NULL THEN {n} END AS {n}" for n in ("email_body", "sender_domain")}
_RULED_MASKED = rule_sql(
    checked_sql(masked_sql(f"(SELECT * REPLACE ({', '.join(_KEPT.values())}) FROM {STORED})", "raw_email")), "masked_email", "r_"
)
ORACLES["cached_verdict"] = (
    f"SELECT email_id, final_check_status, coalesce(nullif(email_body, ''), masked_email) AS analysis_text, "
    f"coalesce(nullif(email_body, ''), masked_email, '') AS email_body, coalesce(nullif(sender_domain, ''), 'not_extracted') AS sender_domain, "
    f"CASE WHEN error IS NULL THEN coalesce(is_phishing, false) ELSE r_is_phishing END AS is_phishing, "
    f"CASE WHEN error IS NULL THEN {norm_score('score_text')} ELSE r_risk_score END AS risk_score, "
    f"CASE WHEN error IS NULL THEN coalesce(mitre_technique, 'UNKNOWN') ELSE r_mitre_technique END AS mitre_technique, "
    f"CASE WHEN error IS NULL THEN coalesce(why_malicious_context, 'No forensic context returned.') "
    f"ELSE 'Gemini unavailable (no_stored_verdict) — ' || r_why_malicious_context END AS why_malicious_context, "
    f"CASE WHEN error IS NULL THEN {joined(clean('high_risk_tokens'))} ELSE {joined('r_high_risk_tokens')} END AS high_risk_tokens, "
    f"CASE WHEN error IS NULL THEN 'gemini' ELSE 'heuristic_fallback' END AS verdict_source, "
    f"CASE WHEN error IS NOT NULL THEN 'no_stored_verdict' END AS gemini_error FROM {_RULED_MASKED}"
)

_ERR = "no_model_configured"


def audit_columns(text: str) -> str:
    """Select list of the audit over is_phishing, risk_score, cleaned tokens `toks` and `found`."""
    return (
        f"CASE WHEN NOT is_phishing THEN 'skipped_benign' WHEN len(toks) = 0 THEN 'skipped_no_tokens' "
        f"WHEN len(found) = 0 THEN 'skipped_tokens_absent' WHEN risk_score - {{p}} > 0.40::DOUBLE THEN 'passed' ELSE 'failed' END"
    )


def perturbed(text: str, tokens: str) -> str:
    return f"list_reduce({tokens}, lambda acc, x: replace(acc, x, '[REMOVED]'), {text})"


def screened(source: str, sender_from: str = "masked_email") -> str:
    """Every column of the screening record; the model is absent, so the rule decides on masked text."""
    base = rule_sql(checked_sql(masked_sql(source, "raw_email")), "masked_email")
    with_found = (
        f"(SELECT *, high_risk_tokens AS toks, CASE WHEN is_phishing THEN {present('masked_email', 'high_risk_tokens')} ELSE [] END AS found FROM {base})"
    )
    status = audit_columns("masked_email").format(p="0.15::DOUBLE")
    tested = "len(found) > 0"
    return (
        f"SELECT email_id, masked_email, {_PRIVACY}, final_check_status, {domain(sender_from)} AS sender_domain, is_phishing, risk_score, "
        f"mitre_technique, 'Gemini unavailable ({_ERR}) — ' || why_malicious_context AS why_malicious_context, "
        f"{joined('high_risk_tokens')} AS high_risk_tokens, 'heuristic_fallback' AS verdict_source, '{_ERR}' AS gemini_error, "
        f"masked_email AS analysis_text, {status} AS audit_status, {joined('found')} AS tokens_in_text, "
        f"CASE WHEN {tested} THEN {perturbed('masked_email', 'found')} END AS perturbed_text, "
        f"CASE WHEN {tested} THEN risk_score - 0.15::DOUBLE END AS score_drop, "
        f"CASE WHEN {tested} THEN risk_score - 0.15::DOUBLE > 0.40::DOUBLE END AS is_trustworthy FROM {with_found}"
    )


ORACLES["screen_mail"] = screened(EMAILS)
ORACLES["screen_stream"] = screened("(SELECT doc_id AS email_id, text AS raw_email FROM documents)")
ORACLES["screen_keep_domain"] = (
    f"SELECT sender_domain, count(*) AS mails, count(*) FILTER (WHERE is_phishing) AS phishing "
    f"FROM ({screened(EMAILS, 'raw_email')}) GROUP BY 1"
)
ORACLES["integrated_context"] = (
    f"SELECT email_id, CASE WHEN len(detected) = 0 THEN 'NONE' ELSE array_to_string({_TYPES}, ', ') END AS pii_type, "
    f"is_phishing, risk_score, coalesce(nullif({body('raw_email')}, ''), masked_email) AS analysis_text "
    f"FROM {rule_sql(masked_sql(EMAILS, 'raw_email'), 'raw_email')}"
)
_GOLDEN = ", ".join(
    f"({i}, {q(s)}, {q(t)}, {label})"
    for i, (label, (s, t, _)) in enumerate(
        [(0, r) for r in fixed.GOLDEN_BENIGN] + [(1, r) for r in fixed.GOLDEN_PHISHING], start=1
    )
)
_CORPUS = (
    f"(SELECT CAST(id AS BIGINT) AS id, subject, snippet, label FROM (VALUES {_GOLDEN}) g(id, subject, snippet, label) "
    f"UNION ALL SELECT email_id + 15, {subject('raw_email')}, raw_email, "
    f"CASE true_label WHEN 'phishing' THEN 1 WHEN 'benign' THEN 0 END FROM {EMAILS})"
)
ORACLES["benchmark_batch"] = (
    f"SELECT id, subject, label, fallback_score AS predicted_score FROM {fallback_sql(masked_sql(_CORPUS, 'snippet'), 'masked_email')}"
)
ORACLES["attach_scores"] = (
    f"SELECT email_id, true_label, CASE WHEN is_phishing THEN risk_score ELSE 0.0::DOUBLE END AS predicted_score FROM {RULED}"
)
ORACLES["apply_overrides"] = (
    f"SELECT email_id, is_phishing, CASE WHEN is_phishing AND email_id % 17 = 0 THEN 'SUPPRESSED' WHEN is_phishing THEN 'ALERT' ELSE 'NONE' END AS action FROM {RULED}"
)

ORACLES["override_stream"] = ORACLES["apply_overrides"]

# --- audit -------------------------------------------------------------------------------------

ORACLES["perturb"] = f"SELECT email_id, {perturbed('raw_email', clean('high_risk_tokens'))} AS perturbed_text FROM {STORED}"
_AUDIT_BASE = (
    f"(SELECT *, CASE WHEN is_phishing THEN {present('analysis_text', 'toks')} ELSE [] END AS found FROM "
    f"(SELECT email_id, {_ANALYSIS} AS analysis_text, coalesce(is_phishing, false) AS is_phishing, {norm_score('score_text')} AS risk_score, "
    f"{clean('high_risk_tokens')} AS toks, mitre_technique FROM {STORED}))"
)
_MESSAGES = (
    "CASE status "
    + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in fixed.AUDIT_MESSAGES.items())
    + " END"
)


def audit_sql(score: str, source: str) -> str:
    tested = "len(found) > 0"
    return (
        f"SELECT email_id, status, {_MESSAGES} AS message, risk_score, {joined('toks')} AS high_risk_tokens, {joined('found')} AS tokens_in_text, "
        f"CASE WHEN {tested} THEN ptext END AS perturbed_text, CASE WHEN {tested} THEN {score} END AS perturbed_score, "
        f"CASE WHEN {tested} THEN risk_score - {score} END AS score_drop, "
        f"CASE WHEN {tested} THEN risk_score - {score} > 0.40::DOUBLE END AS is_trustworthy "
        f"FROM (SELECT *, {audit_columns('').format(p=score)} AS status FROM {source})"
    )


_PERTURBED = f"(SELECT *, {perturbed('analysis_text', 'found')} AS ptext FROM {_AUDIT_BASE})"
ORACLES["audit_status"] = audit_sql("0.15::DOUBLE", _PERTURBED)
ORACLES["audit_rescored"] = audit_sql("s_risk_score", rule_sql(_PERTURBED, "ptext", "s_"))
_PIECES = "string_split(lower(raw_email), lower(token))"
ORACLES["token_spans"] = (
    f"SELECT email_id, token, CAST(unnest(starts) AS INTEGER) AS start, length(token) AS len FROM (SELECT email_id, token, "
    f"list_transform(range(1, len(pieces)), lambda i: 1 + (i - 1) * length(token) "
    f"+ list_sum(list_transform(pieces[1:i], lambda p: length(p)))) AS starts "
    f"FROM (SELECT *, {_PIECES} AS pieces FROM (SELECT email_id, raw_email, unnest(high_risk_tokens) AS token FROM {RULED})))"
)



def filled(template: str, slots: list[str]) -> str:
    """SQL for a text with its slots filled in."""
    parts = template.split("%s")
    assert len(parts) == len(slots) + 1
    pieces = [q(parts[0])]
    for slot, rest in zip(slots, parts[1:]):
        pieces += [f"({slot})", q(rest)]
    return " || ".join(pieces)


_ID_OF = "coalesce(nullif(regexp_extract(mitre_technique, 'T[0-9]{4}(?:\\.[0-9]{3})?'), ''), 'UNKNOWN')"
_LISTED = "CASE WHEN len(found) > 0 THEN array_to_string(found, ', ') ELSE 'N/A' END"
_EXCERPT = "CASE WHEN length(analysis_text) <= 600 THEN analysis_text ELSE analysis_text[1:600] || '...' END"
_FEEDBACK = filled(
    FEEDBACK_TEMPLATE.replace("%.2f", "0.40"),
    [_ID_OF, "coalesce(mitre_technique, 'null')", _LISTED, _EXCERPT, _LISTED, _ID_OF],
)
_STATUS = audit_columns("").format(p="0.15::DOUBLE")
ORACLES["adversarial_prompt"] = (
    f"SELECT email_id, {_FEEDBACK} AS prompt FROM (SELECT *, {_STATUS} AS status FROM {_PERTURBED}) WHERE status = 'failed'"
)
_ESCAPED = "raw_email"
for _plain, _entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
    _ESCAPED = f"replace({_ESCAPED}, {q(_plain)}, {q(_entity)})"
# The phrases of the rule hold letters, blanks and full stops only.
_ALTERNATIVES = (
    "array_to_string(list_transform(list_sort(list_transform(high_risk_tokens, lambda t, i: {'k': -length(t), 'i': i, 't': t})), "
    "lambda s: replace(s.t, '.', '[.]')), '|')"
)
ORACLES["highlight_tokens"] = (
    f"SELECT email_id, CASE WHEN len(high_risk_tokens) > 0 THEN regexp_replace({_ESCAPED}, '(' || {_ALTERNATIVES} || ')', '<mark>\\1</mark>', 'gi') "
    f"ELSE {_ESCAPED} END AS marked FROM {RULED}"
)

# --- metrics -----------------------------------------------------------------------------------


def counts(predicted: str = "is_phishing") -> str:
    return (
        f"count(*) AS total, count(*) FILTER (WHERE {predicted} AND true_label = 'phishing') AS TP, "
        f"count(*) FILTER (WHERE NOT {predicted} AND true_label = 'benign') AS TN, "
        f"count(*) FILTER (WHERE {predicted} AND true_label = 'benign') AS FP, "
        f"count(*) FILTER (WHERE NOT {predicted} AND true_label = 'phishing') AS FN"
    )


def rates(f1: str) -> str:
    return (
        f"precision, recall, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0::DOUBLE END AS {f1}"
    )


_PR = (
    "CASE WHEN TP + FP > 0 THEN TP / (TP + FP) ELSE 0.0::DOUBLE END AS precision, "
    "CASE WHEN TP + FN > 0 THEN TP / (TP + FN) ELSE 0.0::DOUBLE END AS recall"
)
ORACLES["confusion"] = f"SELECT {counts()} FROM {RULED}"
_QUALITY = (
    f"SELECT total, TP, TN, FP, FN, {rates('f1_score')}, CASE WHEN total > 0 THEN (TP + TN) / total ELSE 0.0::DOUBLE END AS accuracy "
    f"FROM (SELECT *, {_PR} FROM (SELECT {counts()} FROM {STORED}))"
)
ORACLES["quality_metrics"] = _QUALITY
ORACLES["quality_report"] = (
    f"SELECT total, TP, TN, FP, FN, round_even(precision, 3) AS precision, round_even(recall, 3) AS recall, "
    f"round_even(f1_score, 3) AS f1_score, round_even(accuracy, 3) AS accuracy FROM ({_QUALITY})"
)
ORACLES["sink_report"] = ORACLES["quality_report"]
ORACLES["error_rows"] = (
    f"SELECT email_id, CASE WHEN is_phishing THEN 'FP' ELSE 'FN' END AS type, is_phishing, true_label FROM {STORED} "
    f"WHERE (is_phishing AND true_label = 'benign') OR (NOT is_phishing AND true_label = 'phishing')"
)
ORACLES["label_counts"] = f"SELECT true_label, count(*) AS n FROM {EMAILS} GROUP BY 1"
_TYPED = (
    f"(SELECT email_id, raw_email AS email_text, CASE true_label WHEN 'phishing' THEN 'Phishing Email' WHEN 'benign' THEN 'Safe Email' END AS email_type FROM {EMAILS})"
)
_SAMPLE = (
    f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY email_type ORDER BY md5('42:' || CAST(email_id AS VARCHAR)), email_id) AS sample_rank "
    f"FROM {_TYPED} WHERE email_type IS NOT NULL) WHERE sample_rank <= 50)"
)
ORACLES["class_balance"] = (
    f"SELECT c.name AS \"check\", c.expected, count(s.email_id) AS actual, count(s.email_id) = c.expected AS ok FROM "
    f"(VALUES ('total', 100::BIGINT), ('label_Phishing Email', 50::BIGINT), ('label_Safe Email', 50::BIGINT)) c(name, expected) "
    f"LEFT JOIN {_SAMPLE} s ON c.name = 'total' OR c.name = 'label_' || s.email_type GROUP BY c.name, c.expected"
)
_SCORED = (
    f"(SELECT email_id, CASE true_label WHEN 'phishing' THEN 1 ELSE 0 END AS label, risk_score AS predicted_score FROM {RULED} WHERE true_label IS NOT NULL)"
)
ORACLES["threshold_predictions"] = (
    f"SELECT email_id, CASE WHEN predicted_score >= 0.55::DOUBLE THEN 1 ELSE 0 END AS predicted FROM {_SCORED}"
)
ORACLES["confusion_cells"] = (
    f"SELECT a.v AS label, p.v AS predicted, count(s.email_id) AS n FROM (VALUES (0), (1)) a(v) CROSS JOIN (VALUES (0), (1)) p(v) "
    f"LEFT JOIN {_SCORED} s ON s.label = a.v AND (CASE WHEN s.predicted_score >= 0.87::DOUBLE THEN 1 ELSE 0 END) = p.v GROUP BY 1, 2"
)


def at_alphas(alphas: str) -> str:
    return (
        f"(SELECT *, {_PR} FROM (SELECT a.alpha, count(*) FILTER (WHERE label = 1 AND predicted_score >= a.alpha) AS TP, "
        f"count(*) FILTER (WHERE label = 0 AND predicted_score >= a.alpha) AS FP, "
        f"count(*) FILTER (WHERE label = 1 AND predicted_score < a.alpha) AS FN, "
        f"count(*) FILTER (WHERE label = 0 AND predicted_score < a.alpha) AS TN "
        f"FROM {_SCORED} s CROSS JOIN {alphas} a GROUP BY a.alpha))"
    )


ORACLES["threshold_metrics"] = f"SELECT alpha, TP, FP, FN, TN, {rates('f1')} FROM {at_alphas('(SELECT 0.3::DOUBLE AS alpha)')}"
ORACLES["alpha_sweep"] = (
    f"SELECT alpha, TP, FP, FN, TN, {rates('f1')} FROM {at_alphas('(SELECT i / 100 AS alpha FROM range(101) r(i))')}"
)
ORACLES["operating_point"] = f"SELECT alpha, precision, recall FROM {at_alphas('(SELECT 0.87::DOUBLE AS alpha)')}"
ORACLES["pr_curve"] = (
    f"SELECT alpha AS threshold, precision, recall FROM {at_alphas(f'(SELECT DISTINCT predicted_score AS alpha FROM {_SCORED})')} "
    f"UNION ALL SELECT NULL, 1.0::DOUBLE, 0.0::DOUBLE"
)

# --- retrieval and knowledge bases ----------------------------------------------------------------


def knn_sql(k: int) -> str:
    parts = "(SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings)"
    return (
        f"WITH parts AS MATERIALIZED (SELECT * FROM {parts}), "
        f"centers AS (SELECT label, i, avg(CAST(x AS DOUBLE)) AS c FROM parts GROUP BY 1, 2), "
        f"distances AS (SELECT p.vec_id, c.label AS kb_id, sum((p.x::DOUBLE - c.c) * (p.x::DOUBLE - c.c)) AS distance "
        f"FROM parts p JOIN centers c ON p.i = c.i GROUP BY 1, 2) "
        f"SELECT vec_id, CAST(rank - 1 AS INTEGER) AS rank, kb_id, round(distance, 6) AS distance FROM "
        f"(SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance, kb_id) AS rank FROM distances) WHERE rank <= {k}"
    )


ORACLES["knn_large_kb"] = (
    f"SELECT vec_id, CAST(rank - 1 AS INTEGER) AS rank, kb_id, round(distance, 6) AS distance FROM ("
    f"SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance, kb_id) AS rank FROM ("
    f"SELECT a.vec_id, b.vec_id AS kb_id, list_sum(list_transform(list_zip(a.embedding, b.embedding), "
    f"lambda p: (p[1]::DOUBLE - p[2]) * (p[1]::DOUBLE - p[2]))) AS distance FROM embeddings a, embeddings b)) "
    f"WHERE rank <= {fixed.TOP_EXAMPLES}"
)
ORACLES["knn_top2"] = knn_sql(2)
ORACLES["knn_top3"] = knn_sql(3)
_CUSTOM = ", ".join(f"({q(k)}, {q(v)})" for k, v in fixed.CUSTOM_INDICATORS.items())
_CUSTOM = f"(SELECT * FROM (VALUES {_CUSTOM}) c(id, custom))"


def extracted(text: str) -> str:
    words = ", ".join(f"CASE WHEN contains(lower({text}), {q(w.lower())}) THEN {q(w)} END" for w in fixed.INDICATOR_WORDS)
    found = f"list_filter([{words}], lambda x: x IS NOT NULL)"
    return f"CASE WHEN len({found}) > 0 THEN array_to_string({found}, ', ') ELSE 'social engineering' END"


_TARGETS = ", ".join(q(t) for t in fixed.TARGET_TECHNIQUES)
_KB = (
    f"(SELECT t.id, t.name, t.description[1:500] AS description, coalesce(c.custom, {extracted('t.description')}) AS indicators "
    f"FROM {TECHNIQUES} t LEFT JOIN {_CUSTOM} c ON t.id = c.id WHERE t.id IN ({_TARGETS}) AND NOT t.revoked)"
)
ORACLES["kb_build"] = f"SELECT id, name, description, indicators FROM {_KB}"
ORACLES["kb_texts"] = f"SELECT id, name || ': ' || description || '. 特徵：' || indicators AS kb_text FROM {_KB}"
ORACLES["extracted_indicators"] = f"SELECT email_id, {extracted('raw_email')} AS indicators FROM {EMAILS}"
ORACLES["kb_upsert"] = (
    "SELECT id, version, payload FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY version DESC) AS r FROM ("
    "SELECT source AS id, doc_id * 2 AS version, md5(text) AS payload FROM documents UNION ALL "
    "SELECT 'src' || CAST(page_id % 25 AS VARCHAR), page_id * 14 + 1, url FROM pages)) WHERE r = 1"
)
_RANKED = (
    f"(SELECT *, row_number() OVER (PARTITION BY email_id ORDER BY hits DESC, technique) AS rank FROM "
    f"(SELECT e.email_id, p.id AS technique, count(*) AS hits FROM {EMAILS} e JOIN "
    f"(SELECT id, lower(trim(unnest(string_split(custom, ',')))) AS phrase FROM {_CUSTOM}) p ON contains(lower(e.raw_email), p.phrase) GROUP BY 1, 2))"
)
ORACLES["indicator_match"] = (
    f"SELECT email_id, technique, hits, CAST(rank - 1 AS INTEGER) AS rank FROM {_RANKED} WHERE rank <= 2"
)
ORACLES["context_strings"] = (
    f"SELECT e.email_id, coalesce((SELECT string_agg('- ' || r.technique || ': ' || c.custom[1:150], chr(10) ORDER BY r.rank) "
    f"FROM {_RANKED} r JOIN {_CUSTOM} c ON r.technique = c.id WHERE r.rank <= 2 AND r.email_id = e.email_id), '') AS technique_lines, "
    f"'Example: ' || e.raw_email[1:100] || '...' || chr(10) || 'Label: ' || coalesce(e.true_label, 'unknown') || ', Reason: own text' AS example_lines "
    f"FROM {EMAILS} e"
)

_PROMPT = filled(
    JUDGE_TEMPLATE,
    [
        domain("raw_email"), subject("raw_email"), "CAST(has_urgency_keywords AS VARCHAR)", "CAST(has_money_request AS VARCHAR)",
        body("raw_email"), "technique_lines", "example_lines",
    ],
)
ORACLES["judge_prompt"] = (
    f"SELECT email_id, {_PROMPT} AS prompt FROM (SELECT *, {FLAGS} FROM {EMAILS}) JOIN ({ORACLES['context_strings']}) USING (email_id)"
)
# The plug-in of this query answers where a technique of the T1566 family is among the nearest.
_NUMBERED = ", ".join(f"({q(k)}, {i})" for i, k in enumerate(fixed.CUSTOM_INDICATORS))
_SQUARES = " + ".join(f"pow(({a}) - ({b}), 2)" for a, b in (("e.email_id % 7", "k.n % 7"), ("e.email_id % 5", "k.n % 5")))


def _nearest_sql(kb: str, k: int, value: str, separator: str) -> str:
    return (
        f"(SELECT email_id, string_agg({value}, '{separator}' ORDER BY rank) AS found FROM (SELECT e.email_id, k.*, "
        f"row_number() OVER (PARTITION BY e.email_id ORDER BY {_SQUARES}, k.id) AS rank FROM documents_ids e CROSS JOIN {kb} k) "
        f"WHERE rank <= {k} GROUP BY 1)"
    )


_IN_CONTEXT = (
    f"(SELECT m.*, t.found AS ids, x.found AS labels FROM {checked_sql(masked_sql(EMAILS, 'raw_email'))} m JOIN "
    + _nearest_sql(f"(SELECT id, n FROM (VALUES {_NUMBERED}) c(id, n))", 2, "id", ",")
    + " t ON t.email_id = m.email_id JOIN "
    + _nearest_sql(
        f"(SELECT email_id AS id, email_id AS n, CASE email_type WHEN 'Phishing Email' THEN 'phishing' ELSE 'benign' END AS label "
        f"FROM {_SAMPLE} WHERE sample_rank <= 20)", 3, "label", ",",
    )
    + " x ON x.email_id = m.email_id)"
)
_ANSWERED = "contains(ids, 'T1566')"
ORACLES["screen_with_context"] = (
    f"WITH documents_ids AS (SELECT doc_id AS email_id FROM documents) SELECT email_id, "
    f"CASE WHEN {_ANSWERED} THEN true ELSE is_phishing END AS is_phishing, "
    f"CASE WHEN {_ANSWERED} THEN 0.9::DOUBLE ELSE risk_score END AS risk_score, "
    f"CASE WHEN {_ANSWERED} THEN string_split(ids, ',')[1] ELSE mitre_technique END AS mitre_technique, "
    f"CASE WHEN {_ANSWERED} THEN ids || '|' || labels ELSE 'Gemini unavailable (parse_failed) — ' || why_malicious_context END AS why_malicious_context, "
    f"CASE WHEN {_ANSWERED} THEN 'gemini' ELSE 'heuristic_fallback' END AS verdict_source, "
    f"CASE WHEN NOT {_ANSWERED} THEN 'parse_failed' END AS gemini_error FROM {rule_sql(_IN_CONTEXT, 'masked_email')}"
)

# --- data sets, resume, order, sinks ----------------------------------------------------------------

ORACLES["class_filter"] = f"SELECT email_id, email_type FROM {_TYPED} WHERE email_type = 'Phishing Email'"
ORACLES["stratified_split"] = (
    f"SELECT email_id, email_type, sample_rank, CASE WHEN sample_rank <= 20 THEN 'fewshot' ELSE 'test' END AS part FROM {_SAMPLE}"
)
ORACLES["fewshot_build"] = (
    f"SELECT email_id, email_text[1:300] AS email, CASE email_type WHEN 'Phishing Email' THEN 'phishing' ELSE 'benign' END AS label, "
    f"CASE email_type WHEN 'Phishing Email' THEN 'T1566' ELSE 'none' END AS technique, "
    f"CASE email_type WHEN 'Phishing Email' THEN '真實釣魚郵件案例' ELSE '真實正常郵件案例' END AS reason FROM {_SAMPLE} WHERE sample_rank <= 20"
)
ORACLES["test_set_build"] = (
    f"SELECT email_id, email_text[1:500] AS raw_email, CASE email_type WHEN 'Phishing Email' THEN 'phishing' ELSE 'benign' END AS true_label "
    f"FROM {_SAMPLE} WHERE sample_rank > 20"
)
_TERMS = "unnest(regexp_split_to_array(lower({text}), '[^\\p{{L}}\\p{{N}}]+')) AS term"
ORACLES["tfidf_retrieval"] = (
    f"WITH kb AS ({ORACLES['fewshot_build']}), "
    f"kb_terms AS (SELECT id, term, count(*) AS n FROM (SELECT email_id AS id, {_TERMS.format(text='email')} FROM kb) WHERE term <> '' GROUP BY ALL), "
    f"idf AS (SELECT term, CAST(round(100.0 * (ln((1.0::DOUBLE + (SELECT count(DISTINCT email_id) FROM kb)) / (1.0::DOUBLE + count(*))) + 1.0::DOUBLE)) AS BIGINT) AS idf FROM kb_terms GROUP BY term), "
    f"weighed AS (SELECT id, term, n * idf AS w FROM kb_terms JOIN idf USING (term)), "
    f"norms AS (SELECT id, sum(w::HUGEINT * w) AS norm FROM weighed GROUP BY id), "
    f"own_terms AS (SELECT email_id, term, count(*) AS n FROM (SELECT email_id, {_TERMS.format(text='raw_email')} FROM {EMAILS}) WHERE term <> '' GROUP BY ALL), "
    f"own AS (SELECT email_id, term, n * idf AS w FROM own_terms JOIN idf USING (term)), "
    f"own_norms AS (SELECT email_id, sum(w::HUGEINT * w) AS norm FROM own GROUP BY email_id), "
    f"dots AS (SELECT o.email_id, k.id, sum(o.w::HUGEINT * k.w) AS dot FROM own o JOIN weighed k USING (term) GROUP BY ALL), "
    f"scored AS (SELECT d.email_id, d.id, dot::DOUBLE / (sqrt(o.norm::DOUBLE) * sqrt(n.norm::DOUBLE)) AS score "
    f"FROM dots d JOIN own_norms o USING (email_id) JOIN norms n ON n.id = d.id), "
    f"ranked AS (SELECT *, row_number() OVER (PARTITION BY email_id ORDER BY score DESC, id) AS place FROM scored) "
    f"SELECT email_id, CAST(place - 1 AS INTEGER) AS rank, id AS kb_id, round(score, 6) AS score FROM ranked WHERE place <= {fixed.TOP_EXAMPLES}"
)
ORACLES["embed_plugin"] = (
    f"SELECT email_id, length(raw_email) AS n_chars, length(regexp_replace(raw_email, '[^0-9]', '', 'g')) AS n_digits, "
    f"length(raw_email) - length(replace(raw_email, chr(10), '')) AS n_breaks FROM {EMAILS}"
)
ORACLES["semantic_large"] = (
    f"SELECT email_id, count(g.value) AS n_items, md5(coalesce(string_agg(g.type || ':' || g.value, '|' ORDER BY g.item_no), '')) AS items_md5 "
    f"FROM {EMAILS} m LEFT JOIN ({inputs.LARGE_GAZETTEER_DUCK}) g ON contains(m.raw_email, g.value) GROUP BY email_id"
)
ORACLES["kb_upsert_stored"] = ORACLES["kb_upsert"]
ORACLES["alpha_sweep_merged"] = ORACLES["alpha_sweep"]
ORACLES["pr_curve_merged"] = ORACLES["pr_curve"]
ORACLES["scan_labelled"] = f"SELECT md5(raw_email) AS mail_md5, length(raw_email) AS n_chars, true_label FROM {EMAILS}"
ORACLES["scan_techniques"] = (
    f"SELECT id, name, md5(description) AS description_md5, CAST(NULL AS VARCHAR) AS indicators FROM ({inputs.duck(inputs.TECHNIQUE_VIEW)})"
)
ORACLES["scan_examples"] = f"SELECT email, label, technique, reason FROM ({ORACLES['fewshot_build']})"
ORACLES["resume_pending"] = f"SELECT email_id, true_label FROM {STORED} WHERE error IS NOT NULL"
ORACLES["stage_log_order"] = (
    f"SELECT *, CASE stage WHEN 'B' THEN 1 WHEN 'A' THEN 2 WHEN 'C' THEN 3 ELSE 99 END AS stage_position, "
    f"CASE status WHEN 'running' THEN 0 WHEN 'skipped' THEN 1 WHEN 'complete' THEN 2 ELSE 9 END AS status_position "
    f"FROM ({duck(inputs.STAGE_LOG_VIEW)})"
)
ORACLES["sink_roundtrip_json"] = (
    f"SELECT email_id, raw_email, true_label, is_phishing, mitre_technique, tokens_text AS high_risk_tokens FROM {STORED}"
)
ORACLES["sink_roundtrip_csv"] = (
    f"SELECT email_id, true_label, is_phishing, CAST(to_json(high_risk_tokens) AS VARCHAR) AS high_risk_tokens FROM {STORED}"
)
ORACLES["stored_verdict_scan"] = (
    f"SELECT true_label, is_phishing, mitre_technique, count(*) AS n, CAST(sum(len(high_risk_tokens)) AS BIGINT) AS tokens "
    f"FROM {STORED} GROUP BY 1, 2, 3"
)

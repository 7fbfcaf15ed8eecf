"""Personal data by weak supervision: patterns propose spans, labelers vote, reliabilities are estimated.

Candidates come from patterns wide enough to hold false ones.  Five labelers vote for or against each, or
abstain: the strict form of its kind (checksum, digits, range), cue words and counter cues from gazetteers
just before it, the characters around it, its own shape, and whether the document holds strictly
checked data elsewhere.  Expectation-maximisation over the counts of vote patterns estimates how
reliable each labeler is; its soft labels then train the final classifier, a naive Bayes model per kind
whose weights are constants in the second pass.  Spans of the strict patterns stay whatever the
classifier says; it adds others.

Candidates are found row by row, nothing is shuffled but counts of vote patterns, of which there can
be no more than kinds x 3^labelers.

Defined results: a null or empty text has no spans; places are code points, ends exclusive; repeated
rows get equal spans; with no candidates at all the model is empty.  All work on rows is DataFrame expressions; the
estimation is plain arithmetic on the driver over those bounded counts.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilpost.operators.stage import computed_once

# Patterns of the kinds, each with a text that any match must hold.  Repetition is
# possessive and starts are guarded, so no text makes them run long; the matches are the same.
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WIDE = {
    "secret": r"(?i)(?<![a-z0-9_])(?:api[_-]?key|access[_-]?key|token|secret|password|passwd|pwd)\x20{0,3}[=:]\x20{0,3}[\"']?[a-z0-9_/+=-]{8,}+",
    "local_phone": r"(?<![0-9+(-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9-])",
    "name": r"(?<!\p{L})(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame|Mme|Señor|Señora|Sr|Sra)\.?\x20\p{Lu}\p{L}++(?:\x20\p{Lu}\p{L}++)?",
}
KINDS = ["email", "ip", "card", "phone", "secret", "local_phone", "name", "number"]
GATES = {"email": "@", "ip": ".", "phone": "+"}
CUES = {
    "email": "mail|contact|write|schreib|écri|correo",
    "ip": "ip|host|server|address|adresse",
    "card": "card|visa|credit|karte|carte|tarjeta",
    "phone": "phone|call|tel|fax|mobile|anruf|appel|llam",
    "secret": "token|key|secret|password|auth",
    "local_phone": "phone|call|tel|fax|mobile|anruf|appel|llam",
    "name": "dear|contact|from|regards|lieber|cher|estimado",
    "number": "card|visa|credit|account|konto|compte|cuenta|iban",
}
COUNTER_CUES = "version|isbn|order|figure|page|chapter|section|example|sample|test"
LABELERS = ["form", "cue", "border", "shape", "company"]
CONTEXT = 40
THRESHOLD = 0.5
ROUNDS = 25
_CHUNK = 256
_SPAN = "struct<kind:string,start:bigint,end:bigint,value:string,left:string,right:string>"


def _matches(kind: str, hits: Column, gaps: Column) -> Column:
    """Spans of the matches of one pattern from the matches and the texts between them.

    Places are running sums of lengths, taken in chunks so that a text of very many matches stays cheap.
    """
    parts = F.transform(
        hits,
        lambda x, i: F.struct(
            F.char_length(F.get(gaps, i)).alias("gap"),
            F.char_length(x).alias("size"),
            x.alias("value"),
            F.right(F.get(gaps, i), F.lit(CONTEXT)).alias("left"),
            F.left(F.get(gaps, i + 1), F.lit(1)).alias("right"),
        ),
    )
    none = F.array().cast(f"array<{_SPAN}>")

    def place(state: Column, x: Column) -> Column:
        start = state["at"] + x["gap"]
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), (start + x["size"]).alias("end"), x["value"].alias("value"), x["left"].alias("left"), x["right"].alias("right"))
        return F.struct((start + x["size"]).alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    def chunk(state: Column, number: Column) -> Column:
        inner = F.aggregate(F.slice(state["parts"], number * _CHUNK + 1, F.lit(_CHUNK)), F.struct(state["at"].alias("at"), none.alias("spans")), place)
        return F.get(
            F.transform(
                F.array(inner),
                lambda got: F.struct(got["at"].alias("at"), F.concat(state["chunks"], F.array(got["spans"])).alias("chunks"), state["parts"].alias("parts")),
            ),
            F.lit(0),
        )

    first = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<array<{_SPAN}>>").alias("chunks"), parts.alias("parts"))
    chunks = F.sequence(F.lit(0), F.floor((F.size(hits) - 1) / _CHUNK).cast("int"))
    return F.when(F.size(hits) > 0, F.aggregate(chunks, first, chunk, lambda state: F.flatten(state["chunks"]))).otherwise(none)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    """Whether the digits pass the Luhn check."""
    figures = F.reverse(F.split(_digits(value), ""))

    def weigh(x: Column, i: Column) -> Column:
        twice = x.cast("int") * (F.lit(1) + i % 2)
        return twice - F.when(twice > 9, 9).otherwise(0)

    total = F.aggregate(F.transform(F.filter(figures, lambda x: x != ""), weigh), F.lit(0), lambda a, x: a + x)
    return total % 10 == 0


def _passes(kind: Column, value: Column) -> Column:
    size = F.char_length(_digits(value))
    # Leading zeros do not make a part of an address larger.
    parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
    small = F.forall(parts, lambda p: (F.char_length(p) <= 3) & (F.try_to_number(F.right(p, F.lit(3)), F.lit("999")) <= 255))
    return (
        F.when(kind == "email", True)
        .when(kind == "ip", small)
        .when(kind == "card", size.between(12, 19) & _luhn(value))
        .when(kind == "phone", size.between(9, 15))
        .otherwise(False)
    )


def _votes(span: Column, strict: Column, company: Column) -> Column:
    """One, zero or minus one from each labeler."""
    kind, value, left, right = span["kind"], span["value"], F.lower(span["left"]), span["right"]
    cue = F.lit(False)
    for name in KINDS:
        cue = F.when(kind == name, left.rlike(CUES[name])).otherwise(cue)
    form = F.when(strict, 1).when(kind.isin("number", "card", "ip"), -1).when(kind == "local_phone", 0).otherwise(1)
    border = F.when(F.concat(F.right(left, F.lit(1)), right).rlike(r"[\p{L}\p{N}_]"), -1).otherwise(1)
    shape = F.when(_digits(value).rlike(r"^([0-9])\1*$") | F.lower(value).rlike("example|changeme|xxxx"), -1).otherwise(F.when(F.char_length(value) >= 12, 1).otherwise(0))
    return F.array(
        form,
        F.when(cue, 1).when(left.rlike(COUNTER_CUES), -1).otherwise(0),
        border,
        shape,
        F.when(company, 1).otherwise(0),
    )


def with_candidates(df: DataFrame, text: str = "text") -> DataFrame:
    """Add `candidates`: spans with kind, start, end, strict, and their votes."""
    whole = F.coalesce(F.col(text), F.lit(""))
    found = {}
    for kind, pattern in {**STRICT, **WIDE}.items():
        gate = whole.contains(GATES[kind]) if kind in GATES else F.lit(True)
        found[f"__hit_{kind}"] = F.when(gate, F.regexp_extract_all(whole, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))
    df = computed_once(df, **found)
    df = computed_once(df, **{f"__gap_{k}": F.when(F.size(f"__hit_{k}") > 0, F.split(whole, p, -1)) for k, p in {**STRICT, **WIDE}.items()})
    spans = F.concat(*[_matches(k, F.col(f"__hit_{k}"), F.col(f"__gap_{k}")) for k in {**STRICT, **WIDE}])
    df = computed_once(df, __spans=spans).drop(*[f"__{w}_{k}" for w in ("hit", "gap") for k in {**STRICT, **WIDE}])
    checked = F.transform("__spans", lambda s: F.struct(s.alias("span"), _passes(s["kind"], s["value"]).alias("strict")))
    df = computed_once(df, __checked=checked).drop("__spans")

    strict_kinds = list(STRICT)
    long_number = lambda c: (c["span"]["kind"] == "card") & F.char_length(_digits(c["span"]["value"])).between(12, 19)
    # A failed card of fitting length is still a candidate, as a number; other failed matches go.
    kept = F.filter("__checked", lambda c: c["strict"] | long_number(c) | ~c["span"]["kind"].isin(strict_kinds))
    total = F.size(F.filter("__checked", lambda c: c["strict"]))

    def finish(c: Column) -> Column:
        kind = F.when((c["span"]["kind"] == "card") & ~c["strict"], F.lit("number")).otherwise(c["span"]["kind"])
        span = c["span"].withField("kind", kind)
        company = total > F.when(c["strict"], 1).otherwise(0)
        return F.struct(kind.alias("kind"), span["start"].alias("start"), span["end"].alias("end"), c["strict"].alias("strict"), _votes(span, c["strict"], company).alias("votes"))

    return computed_once(df, candidates=F.transform(kept, finish)).drop("__checked")


def vote_counts(candidates: DataFrame) -> list:
    """(kind, votes, strict, n): how often each pattern of votes occurs in the whole corpus."""
    rows = candidates.select(F.inline("candidates")).groupBy("kind", "votes").agg(F.count(F.lit(1)).alias("n"))
    return rows.orderBy("kind", "votes").collect()


def estimate(patterns: list) -> dict[str, tuple[float, list[dict[int, float]]]]:
    """Bias and a weight for each vote of each labeler, by kind, from the counts of vote patterns alone.

    The first soft labels are majority votes.  A round estimates, for true and for false spans, how often
    each labeler votes each way, and from that the labels.  The reliabilities are shared by all
    kinds; how common true spans are is each kind's own.
    """
    if not patterns:
        return {}
    values = (-1, 0, 1)
    label = [1 / (1 + math.exp(-sum(p.votes))) for p in patterns]

    def log_odds(rows: list[int], shared: list[int]) -> tuple[float, list[dict[int, float]]]:
        yes = sum(patterns[i].n * label[i] for i in rows)
        no = sum(patterns[i].n * (1 - label[i]) for i in rows)
        weights = []
        for labeler in range(len(LABELERS)):
            table = {}
            for v in values:
                y = sum(patterns[i].n * label[i] for i in shared if patterns[i].votes[labeler] == v)
                z = sum(patterns[i].n * (1 - label[i]) for i in shared if patterns[i].votes[labeler] == v)
                all_y = sum(patterns[i].n * label[i] for i in shared)
                all_z = sum(patterns[i].n * (1 - label[i]) for i in shared)
                table[v] = math.log((y + 1) / (all_y + 3)) - math.log((z + 1) / (all_z + 3))
            weights.append(table)
        return math.log(yes + 1) - math.log(no + 1), weights

    everything = list(range(len(patterns)))
    by_kind = {k: [i for i in everything if patterns[i].kind == k] for k in {p.kind for p in patterns}}
    for _ in range(ROUNDS):
        models = {k: log_odds(rows, everything) for k, rows in by_kind.items()}
        for i, p in enumerate(patterns):
            bias, weights = models[p.kind]
            odds = bias + sum(w[v] for w, v in zip(weights, p.votes))
            label[i] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    # The final classifier learns each kind's own weights from the soft labels.
    return {k: log_odds(rows, rows) for k, rows in by_kind.items()}


def fit(candidates: DataFrame) -> dict:
    return estimate(vote_counts(candidates))


def _odds(model: dict, candidate: Column) -> Column:
    score = F.lit(-1e9)
    for kind, (bias, weights) in model.items():
        total = F.lit(bias)
        for labeler, table in enumerate(weights):
            vote = F.get(candidate["votes"], F.lit(labeler))
            total = total + F.when(vote == 1, table[1]).when(vote == -1, table[-1]).otherwise(table[0])
        score = F.when(candidate["kind"] == kind, total).otherwise(score)
    return score


def spans(model: dict) -> Column:
    """Spans that stay, ordered by start and kind: all strict ones, and those the classifier accepts that overlap none of them."""
    order = F.array(*[F.lit(k) for k in KINDS])
    line = math.log(THRESHOLD / (1 - THRESHOLD))

    def accepted(c: Column) -> Column:
        free = ~F.exists("candidates", lambda o: o["strict"] & (o["start"] < c["end"]) & (c["start"] < o["end"]))
        return c["strict"] | (free & (_odds(model, c) > line))

    ranked = F.transform(
        F.filter("candidates", accepted),
        lambda c: F.struct(c["start"].alias("start"), F.array_position(order, c["kind"]).alias("rank"), c["end"].alias("end"), c["kind"].alias("kind"), c["strict"].alias("strict")),
    )
    return F.sort_array(ranked)


def spans_text(spans_: Column) -> Column:
    return F.array_join(F.transform(spans_, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def strict_count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["strict"] & (s["kind"] == kind))).cast("long")


def masked(text: Column, spans_: Column) -> Column:
    """The text with every span replaced by the name of its kind in brackets.

    Spans that overlap are masked as one, from the first start to the last end, and named by the first.
    """
    first = F.struct(F.lit(1).cast("long").alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(state: Column, s: Column) -> Column:
        before = F.substring(text, state["at"].cast("int"), (s["start"] + 1 - state["at"]).cast("int"))
        parts = F.concat(state["parts"], F.array(before, F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))))
        further = F.struct(F.greatest(state["at"], s["end"] + 1).alias("at"), state["parts"].alias("parts"))
        return F.when(s["start"] + 1 >= state["at"], F.struct((s["end"] + 1).alias("at"), parts.alias("parts"))).otherwise(further)

    def whole(state: Column) -> Column:
        return F.concat(F.array_join(state["parts"], ""), F.substring(text, state["at"].cast("int"), F.lit(2**31 - 1)))

    return F.when(F.size(spans_) > 0, F.aggregate(spans_, first, step, whole)).otherwise(text)


def mask_documents(docs: DataFrame, model: dict, text: str = "text", chars: str = "n_chars") -> DataFrame:
    """`docs` with its spans masked, columns as they were; `chars`, if it is a column, follows the text."""
    # Columns go by number meanwhile, so none of them can clash with those added here.
    numbered = docs.toDF(*[f"__column_{i}" for i in range(len(docs.columns))])
    place = docs.columns.index(text)
    found = computed_once(with_candidates(numbered, f"__column_{place}"), __found=spans(model))
    changed = computed_once(found, __masked=masked(F.col(f"__column_{place}"), F.col("__found")))
    out = []
    for i, (name, kind) in enumerate(docs.dtypes):
        column = F.col(f"__column_{i}")
        if name == text:
            column = F.col("__masked")
        elif name == chars:
            column = F.when(F.size("__found") > 0, F.char_length("__masked").cast(kind)).otherwise(column)
        out.append(column.alias(name))
    return changed.select(*out)

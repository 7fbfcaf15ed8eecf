"""Quality rules and robust outliers: minimum-covariance-determinant estimates per language and source.

Counts of a text become a vector of five logarithms on a grid of 1/1024, so sums over rows are exact
whole numbers and the estimates do not depend on the order of rows.  Each group starts from medians
and quartile ranges; every concentration step takes the three quarters of its rows nearest to its
centre and estimates centre and covariance anew, which never raises the determinant.  Distances are
counted in fine steps, so a step is one aggregation, whatever the size of a group.  A group
with too few rows is judged with all other such rows together.

Defined results: a null text has no words and fails the base rule; null language or source is a value
of its own; rows count each; where even the joint group is too small, only the base rule decides.
Everything is DataFrame expressions.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from veilpost.operators.stage import computed_once

from .exchange import save

DIMS = 5
GRID = 1024
SHARE = 0.75
STEPS = 5
LEAST_ROWS = 100
#: Least spread of a dimension, in logarithms: counts that are nearly always zero would have none.
FLOORS = (0.2, 0.15, 0.5, 0.7, 0.7)
#: Chi-square with five degrees of freedom: 0.75 quantile, and the value one in a million exceeds.
CHI_SHARE, CUTOFF = 6.626, 35.89
#: Groups whose estimates may be sent to every executor: some 6 MB at 300 bytes each.
MAX_SENT_GROUPS = 20_000
SPACE = "[\\x20\\x09-\\x0D]+"
_REST = "*"


def text_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words to every row, each text worked on once.

    Repeated windows are looked for among 64-bit hashes first; only rows where two agree sort the
    windows themselves, so the counts are exact.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    df = computed_once(
        df,
        __words=F.array_remove(F.split(whole, SPACE, -1), ""),
        __lines=F.filter(F.split(whole, "\n", -1), lambda line: line.rlike("[^\\x20\\x09-\\x0D]")),
        n_symbols=(F.char_length(whole) - F.char_length(F.translate(whole, "#*$%&|<>", ""))).cast("long"),
    )
    n = F.size("__words")
    hashes = F.transform(F.sequence(F.lit(0), n - 5), lambda i: F.xxhash64(*[F.get("__words", i + j) for j in range(5)]))
    df = computed_once(df.withColumn("n_words", n.cast("long")), __hashes=F.when(n > 5, hashes))
    repeats = F.size(F.array_distinct("__hashes")) < F.size("__hashes")
    windows = F.sort_array(
        F.transform(
            F.sequence(F.lit(0), n - 5),
            lambda i: F.struct(F.array_join(F.slice("__words", i + 1, 5), " ").alias("w"), i.alias("at")),
        )
    )
    df = computed_once(df, __windows=F.when(repeats, windows))

    def twice(x: Column, i: Column) -> Column:
        equal = F.coalesce(F.get("__windows", i - 1)["w"] == x["w"], F.lit(False)) | F.coalesce(F.get("__windows", i + 1)["w"] == x["w"], F.lit(False))
        return F.when(equal, x["at"])

    places = F.sort_array(F.filter(F.transform("__windows", twice), lambda at: at.isNotNull()))
    df = computed_once(df, __places=places)
    covered = F.transform("__places", lambda at, i: F.least(F.lit(5), F.coalesce(F.get("__places", i + 1) - at, F.lit(5))))
    total = lambda array: F.aggregate(array, F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))
    return df.withColumns(
        {
            "word_chars": total(F.transform("__words", lambda w: F.char_length(w))),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
            "n_repeat_words": F.coalesce(total(covered), F.lit(0)),
        }
    ).drop("__words", "__lines", "__hashes", "__windows", "__places")


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)


def vector() -> list[Column]:
    """The five logarithms of a row's counts, on the grid."""
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    values = [
        F.log(words),
        F.log(chars / words),
        F.log1p(F.col("n_symbols") * 100 / chars),
        F.log1p(F.col("n_dup_lines").cast("double")),
        F.log1p(F.col("n_repeat_words") * 100 / words),
    ]
    return [F.round(v * GRID).cast("long") for v in values]


_PAIRS = [(i, j) for i in range(1, DIMS + 1) for j in range(1, i + 1)]


def _factored(params: DataFrame) -> DataFrame:
    """Cholesky factor l.. of each group's covariance c.., whose diagonal is raised to the least spread."""
    lines = []
    for i, j in _PAIRS:
        below = "".join(f" - l{i}{k} * l{j}{k}" for k in range(1, j))
        if i == j:
            floor = (FLOORS[i - 1] * GRID) ** 2
            lines.append(f"sqrt(greatest(c{i}{i}, {floor!r}D){below} + 1D) AS l{i}{i}")
        else:
            lines.append(f"(c{i}{j}{below}) / l{j}{j} AS l{i}{j}")
    return params.selectExpr("g", *[f"m{i}" for i in range(1, DIMS + 1)], *lines, "scale")


def _near(rows: DataFrame, params: DataFrame) -> DataFrame:
    """Rows with the estimates of their group; hot groups meet a small table where they lie, or are split by the join."""
    small = params.count() <= MAX_SENT_GROUPS
    return rows.join(F.broadcast(params) if small else params, "g")


def _with_distance(joined: DataFrame) -> DataFrame:
    """Add d2, the squared Mahalanobis distance."""
    lines = []
    for i in range(1, DIMS + 1):
        below = "".join(f" - l{i}{k} * y{k}" for k in range(1, i))
        lines.append(f"(x{i} - m{i}{below}) / l{i}{i} AS y{i}")
    return joined.selectExpr("*", *lines, " + ".join(f"y{i} * y{i}" for i in range(1, DIMS + 1)) + " AS d2")


_STEP = "CAST(floor(log2(1 + least(d2, 1e15D)) * 16) AS INT)"


def _concentrate(rows: DataFrame, params: DataFrame, share: float = SHARE) -> DataFrame:
    """One step: estimates from the nearest rows of every group, and the distance within which they lie."""
    far = _with_distance(_near(rows, params)).selectExpr("g", *[f"x{i}" for i in range(1, DIMS + 1)], f"{_STEP} AS step")
    sums = [F.count(F.lit(1)).alias("n")]
    sums += [F.sum(f"x{i}").alias(f"s{i}") for i in range(1, DIMS + 1)]
    sums += [F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"q{i}{j}") for i, j in _PAIRS]
    steps = far.groupBy("g", "step").agg(*sums)
    by_group = Window.partitionBy("g")
    before = F.sum("n").over(by_group.orderBy("step")) - F.col("n")
    taken = steps.withColumns({"all": F.sum("n").over(by_group), "before": before}).where(F.col("before") < F.ceil(F.col("all") * share))
    names = ["n", *[f"s{i}" for i in range(1, DIMS + 1)], *[f"q{i}{j}" for i, j in _PAIRS]]
    whole = taken.groupBy("g").agg(F.max("step").alias("step"), *[F.sum(c).cast("double").alias(c) for c in names])
    estimates = [f"s{i} / n AS m{i}" for i in range(1, DIMS + 1)]
    estimates += [f"q{i}{j} / n - (s{i} / n) * (s{j} / n) AS c{i}{j}" for i, j in _PAIRS]
    return whole.selectExpr("g", *estimates, f"greatest((pow(2D, (step + 1) / 16D) - 1) / {CHI_SHARE}, 1e-6D) AS scale")


def _start(rows: DataFrame) -> DataFrame:
    """Medians and quartile ranges of every group and dimension, from counts on a coarse grid."""
    long = rows.selectExpr("g", f"stack({DIMS}, {', '.join(f'{i}, x{i} div 32' for i in range(1, DIMS + 1))}) AS (dim, bin)")
    counts = long.groupBy("g", "dim", "bin").agg(F.count(F.lit(1)).alias("n"))
    by = Window.partitionBy("g", "dim")
    cum = counts.withColumns({"all": F.sum("n").over(by), "upto": F.sum("n").over(by.orderBy("bin"))})
    quartiles = cum.groupBy("g", "dim").agg(*[F.min(F.when(F.col("upto") >= F.col("all") * q / 4, F.col("bin"))).alias(f"b{q}") for q in (1, 2, 3)])
    wide = quartiles.groupBy("g").agg(
        *[F.max(F.when(F.col("dim") == i, F.col("b2") * 32.0 + 16)).alias(f"m{i}") for i in range(1, DIMS + 1)],
        *[F.max(F.when(F.col("dim") == i, F.pow((F.col("b3") - F.col("b1")) * 32 / 1.349, F.lit(2.0)))).alias(f"c{i}{i}") for i in range(1, DIMS + 1)],
    )
    off = {f"c{i}{j}": F.lit(0.0) for i, j in _PAIRS if i != j}
    return wide.withColumns(off).withColumn("scale", F.lit(1.0))


def fit(rows: DataFrame) -> DataFrame:
    """(g, centre, factor, scale) of every group of (g, x1..x5) rows that has rows enough."""
    params = save(_factored(_start(rows)), "start")
    for _ in range(STEPS):
        params = save(_factored(_concentrate(rows, params)), "estimates")
    return params


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", groups: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """(key, counts, base_failed, distance, kept) of every row; distance is null where nothing was estimated."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    slim = docs.select(F.col(key), F.col(text).alias("text"), F.to_json(F.struct(*groups), {"ignoreNullFields": "false"}).alias("g"))
    counted = text_counts(slim).drop("text").withColumn("base_failed", base_failed())
    counted = save(counted.withColumns({f"x{i + 1}": x for i, x in enumerate(vector())}), "counts")

    good = counted.where("NOT base_failed")
    sizes = good.groupBy("g").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") >= LEAST_ROWS).select("g", F.col("g").alias("own"))
    own = save(sizes, "groups")
    few = own.count() <= MAX_SENT_GROUPS
    placed = counted.join(F.broadcast(own) if few else own, "g", "left").withColumn("g", F.coalesce("own", F.lit(_REST))).drop("own")
    params = fit(placed.where("NOT base_failed"))
    enough = placed.where(f"NOT base_failed AND g = '{_REST}'").limit(LEAST_ROWS).count() >= LEAST_ROWS
    params = params if enough else params.where(F.col("g") != _REST)
    few = params.count() <= MAX_SENT_GROUPS
    measured = _with_distance(placed.join(F.broadcast(params) if few else params, "g", "left"))
    distance = F.col("d2") / F.col("scale")
    kept = ~F.col("base_failed") & F.coalesce(distance <= CUTOFF, F.lit(True))
    return measured.select(key, *names, "base_failed", distance.alias("distance"), kept.alias("kept"))

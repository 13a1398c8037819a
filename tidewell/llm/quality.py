"""Quality rules: fixed limits, and robust multivariate outliers by minimum covariance determinant.

Everything is DataFrame functions. One pass over the texts counts; what it finds is a narrow table, and all else
works on that. Four transformed statistics describe a document: mean word length against its group's median, damped
for short texts; and the shares of symbols, repeated lines and repeated windows on logarithmic or angular scales. For each language and
source the estimate starts from medians and quartiles and then concentrates: mean and covariance of the
``SUPPORT`` share of rows with the smallest distances, new distances, and again, until no group's determinant falls
any more (``LEAST_FALL`` of its logarithm, which the floors bound from below). A group that has settled is not read again.
Documents are rejected by their Mahalanobis distance to the final estimate. Quantiles come from counts of bins, so they
are the same however the rows are partitioned.

Most documents have no symbol and no repetition at all, so the covariance of the central rows is singular;
the square of ``FLOOR`` is added to each variance, which says what deviation is too small to matter. Floors and
cutoff let each statistic reject by itself; repetition alone does from 18.4 percent of a text in a group without any.
Groups under ``MIN_ROWS`` rows share the estimate of their language's small groups, and those of small languages
one estimate. Groups are aggregated map-side and joined by their key; a hot source is one row of the small side.

Edge cases: a NULL or empty text has no words, fails the base rules and enters no estimate. NULL languages and
sources are groups of their own. Repeated rows each get a row. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.session import staged

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
SUPPORT = 0.75
LEAST_FALL = 1e-3
MIN_ROWS = 100
DAMPING = 100
MAX_BROADCAST_GROUPS = 50_000  # of some 150 bytes each
FLOOR = (0.2, 0.3, 0.3, 0.07)
#: Of a chi-squared variable with four degrees of freedom one value in twenty-five million is larger.
CUTOFF = 40.0
#: SUPPORT / P(chi2 with 6 degrees <= its SUPPORT quantile with 4): makes the covariance of a part stand for the whole.
CONSISTENCY = 1.485
_SPACES = r"[\x20\x09-\x0D]+"
_SYMBOLS = "#*$%&|<>"
_T = ("t1", "t2", "t3", "t4")
_KEYS = ("lang_key", "source_key")
#: Bins a unit of the inverse hyperbolic sine: a thousandth apart near zero, a thousandth of the value beyond.
GRAIN = 1000


def _bound(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def _shifted_hash(values: Column, by: int, n: Column) -> Column:
    """Hashes of each element with the one ``by`` places on."""
    return F.zip_with(values, F.slice(values, by + 1, n), lambda a, b: F.xxhash64(a, b))


def _covered(windows: Column) -> Column:
    """Words in windows whose hash comes more than once: their starts in order, and what each adds."""

    def repeated(s: Column) -> Column:
        same = F.zip_with(
            s, F.slice(s, 2, F.size(s)), lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False))
        )
        either = _bound(same, lambda e: F.zip_with(e, F.concat(F.array(F.lit(False)), e), lambda x, y: x | y))
        return F.zip_with(s, F.slice(either, 1, F.size(s)), lambda a, f: F.when(f, a["i"]))

    def total(starts: Column) -> Column:
        gaps = F.zip_with(
            starts, F.slice(starts, 2, F.size(starts)), lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW)))
        )
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda acc, x: acc + x)

    ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    starts = F.sort_array(F.array_compact(_bound(ordered, repeated)))
    return _bound(starts, total)


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``lang``, ``source``, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words`` of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    plain = text
    for symbol in _SYMBOLS:
        plain = F.replace(plain, F.lit(symbol), F.lit(""))
    base = docs.select(
        "doc_id",
        "lang",
        "source",
        F.array_remove(F.split(text, _SPACES), "").alias("words"),
        (F.octet_length(text) - F.octet_length(plain)).cast("long").alias("n_symbols"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    n = F.size("words")
    counted = base.select(
        "doc_id",
        "lang",
        "source",
        n.alias("n"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("w1"),
    )
    for width in (1, 2, 4):
        counted = counted.withColumn(f"w{2 * width}", _shifted_hash(F.col(f"w{width}"), width, F.col("n") + 1)).drop(
            f"w{width}"
        )
    windows = counted.withColumn("windows", F.slice("w8", 1, F.greatest(F.col("n") - WINDOW + 1, F.lit(0))))
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    return windows.select(
        "doc_id",
        "lang",
        "source",
        F.col("n").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        F.when(repeats, _covered(F.col("windows"))).otherwise(F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def _with_base_verdict(stats: DataFrame) -> DataFrame:
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return stats.withColumn("base_failed", failed)


def _grouped(stats: DataFrame) -> DataFrame:
    """Rows with ``lang_key`` and ``source_key``: whose estimate applies. ``*`` stands for several."""
    usable = stats.where("NOT base_failed")
    sizes = usable.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("rows"))
    large = sizes.where(F.col("rows") >= MIN_ROWS).select(F.col("lang").alias("l"), F.col("source").alias("s"))
    rest = sizes.where(F.col("rows") < MIN_ROWS).groupBy("lang").agg(F.sum("rows").alias("rows"))
    rest = rest.where(F.col("rows") >= MIN_ROWS).select(F.col("lang").alias("rest_lang"), F.lit(True).alias("has_rest"))
    own = stats.join(
        large.withColumn("has_own", F.lit(True)),
        stats["lang"].eqNullSafe(F.col("l")) & stats["source"].eqNullSafe(F.col("s")),
        "left",
    )
    keyed = own.join(rest, F.col("lang").eqNullSafe(F.col("rest_lang")), "left")
    lang = F.concat(F.lit("="), F.coalesce(F.col("lang").cast("string"), F.lit("")), F.col("lang").isNull().cast("string"))
    source = F.concat(
        F.lit("="), F.coalesce(F.col("source").cast("string"), F.lit("")), F.col("source").isNull().cast("string")
    )
    return keyed.select(
        *stats.columns,
        F.when(F.col("has_own") | F.col("has_rest"), lang).otherwise("*").alias("lang_key"),
        F.when(F.col("has_own"), source).otherwise("*").alias("source_key"),
    )


def _bin(value: Column) -> Column:
    return F.round(F.asinh(value) * GRAIN).cast("int")


def _quantile_bins(rows: DataFrame, values: dict[str, Column], shares: tuple[float, ...]) -> DataFrame:
    """For each group the smallest bins that hold the given shares of its rows, as an array for each value.

    Rows are counted by bin before they are exchanged; what a window orders is the bins of one group, some ten
    thousand however many rows there are.
    """
    pairs = F.array(*(F.struct(F.lit(name).alias("which"), _bin(value).alias("bin")) for name, value in values.items()))
    counts = rows.select(*_KEYS, F.inline(pairs)).groupBy(*_KEYS, "which", "bin").agg(F.count(F.lit(1)).alias("n"))
    group = Window.partitionBy(*_KEYS, "which")
    running = counts.select(
        *_KEYS, "which", "bin", F.sum("n").over(group.orderBy("bin")).alias("upto"), F.sum("n").over(group).alias("all")
    )

    def reached(name: str, share: float) -> Column:
        return F.min(F.when((F.col("which") == name) & (F.col("upto") >= share * F.col("all")), F.col("bin")))

    return running.groupBy(*_KEYS).agg(
        *(F.array(*(reached(name, share) for share in shares)).alias(name) for name in values)
    )


def _middle(bins: Column) -> Column:
    """The value in the middle of a bin."""
    return F.sinh(bins / GRAIN)


def _transformed(stats: DataFrame) -> DataFrame:
    """Rows with the vector ``t1`` to ``t4``."""
    length = F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1))
    medians = _quantile_bins(stats.where("NOT base_failed"), {"lengths": length}, (0.5,))
    usual = medians.select(*_KEYS, _middle(F.col("lengths")[0]).alias("usual_length"))
    words = F.greatest(F.col("n_words"), F.lit(1))
    return (
        stats.join(_small(staged(usual, "usual")), list(_KEYS), "left")
        .withColumn("t1", (length - F.coalesce("usual_length", length)) * F.sqrt(words / (words + DAMPING)))
        .withColumn("t2", F.log1p(100 * F.col("n_symbols") / (F.col("word_chars") + DAMPING)))
        .withColumn("t3", F.log1p(100 * F.col("n_dup_lines") / (words + DAMPING)))
        .withColumn("t4", F.asin(F.sqrt(F.least(F.col("n_repeat_words") / words, F.lit(1.0)))))
        .drop("usual_length")
    )


def _cholesky(cov) -> dict[str, Column]:
    """Entries of the lower triangular factor of a 4 x 4 covariance, ``cov(i, j)``, as columns on each other."""
    out: dict[str, Column] = {}
    for i in range(4):
        for j in range(i + 1):
            inner = cov(i, j)
            for k in range(j):
                inner = inner - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            out[f"l{i}{j}"] = F.sqrt(F.greatest(inner, F.lit(FLOOR[i] ** 2))) if i == j else inner / F.col(f"l{j}{j}")
    return out


def _distance() -> Column:
    """Squared Mahalanobis distance by forward substitution in the factor's columns."""
    z: list[Column] = []
    for i in range(4):
        rest = F.col(_T[i]) - F.col(f"m{i}")
        for k in range(i):
            rest = rest - F.col(f"l{i}{k}") * z[k]
        z.append(rest / F.col(f"l{i}{i}"))
    return sum((x * x for x in z[1:]), z[0] * z[0])


def _factored(estimates: DataFrame) -> DataFrame:
    """Means ``m*`` and covariances ``c*`` as means and factor entries ``l*``."""
    for name, entry in _cholesky(lambda i, j: F.col(f"c{i}{j}")).items():
        estimates = estimates.withColumn(name, entry)
    return estimates.drop(*(f"c{i}{j}" for i in range(4) for j in range(i + 1)))


def _start(rows: DataFrame) -> DataFrame:
    """Medians, and variances from quartiles. No rows stand behind them yet, so any step counts as a fall."""
    quartiles = _quantile_bins(rows, {f"q{i}": F.col(t) for i, t in enumerate(_T)}, (0.25, 0.5, 0.75))
    columns = [_middle(F.col(f"q{i}")[1]).alias(f"m{i}") for i in range(4)]
    for i in range(4):
        for j in range(i + 1):
            spread = (_middle(F.col(f"q{i}")[2]) - _middle(F.col(f"q{i}")[0])) / 1.349
            value = spread * spread + FLOOR[i] ** 2 if i == j else F.lit(0.0)
            columns.append(value.alias(f"c{i}{j}"))
    started = _factored(quartiles.select(*_KEYS, *columns))
    return started.withColumns({"log_det": F.lit(float("inf")), "falling": F.lit(True)})


def _small(groups: DataFrame) -> DataFrame:
    """One row for each group, broadcast while there are few; beyond that Spark joins by key."""
    return F.broadcast(groups) if groups.count() <= MAX_BROADCAST_GROUPS else groups


def _concentrated(rows: DataFrame, moving: DataFrame) -> DataFrame:
    """Estimates from the nearest rows of each group, or those before where the determinant has not fallen."""
    apart = rows.join(_small(moving), list(_KEYS))
    cut = _quantile_bins(apart, {"nearest": _distance()}, (SUPPORT,))
    cut = staged(moving.join(cut.select(*_KEYS, F.col("nearest")[0].alias("cut")), list(_KEYS)), "cut")
    central = rows.join(_small(cut), list(_KEYS)).where(_bin(_distance()) <= F.col("cut"))
    moments = [F.avg(t).alias(f"m{i}") for i, t in enumerate(_T)]
    for i in range(4):
        for j in range(i + 1):
            value = F.covar_pop(_T[i], _T[j]) * CONSISTENCY + (FLOOR[i] ** 2 if i == j else 0.0)
            moments.append(value.alias(f"c{i}{j}"))
    found = _factored(central.groupBy(*_KEYS).agg(*moments))
    found = found.withColumn("log_det", 2 * sum((F.log(f"l{i}{i}") for i in range(1, 4)), F.log("l00")))
    names = [name for name in moving.columns if name not in (*_KEYS, "falling")]
    both = moving.join(found.select(*_KEYS, F.struct(*names).alias("new")), list(_KEYS))
    fallen = F.col("new.log_det") < F.col("log_det")
    return both.select(
        *_KEYS,
        *(F.when(fallen, F.col(f"new.{name}")).otherwise(F.col(name)).alias(name) for name in names),
        (F.col("new.log_det") < F.col("log_det") - LEAST_FALL).alias("falling"),
    )


def estimates(rows: DataFrame) -> DataFrame:
    """One row for each ``lang_key`` and ``source_key`` in ``rows``: mean ``m*`` and Cholesky factor ``l*``."""
    current = staged(_start(rows), "estimate")
    while not current.where("falling").isEmpty():
        settled = current.where("NOT falling")
        current = staged(settled.unionByName(_concentrated(rows, current.where("falling"))), "estimate")
    return current.drop("falling")


def judged(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, the four base statistics, ``base_failed``, ``distance`` and ``kept`` of every row.

    ``distance`` is the squared Mahalanobis distance to the group's estimate, NULL without one.
    """
    stats = staged(_with_base_verdict(statistics(docs)), "statistics")
    rows = staged(_transformed(_grouped(stats)), "vectors")
    found = estimates(rows.where("NOT base_failed"))
    return (
        rows.join(_small(found), list(_KEYS), "left")
        .withColumn("distance", _distance())
        .select(
            "doc_id",
            "n_words",
            "word_chars",
            "n_symbols",
            "n_dup_lines",
            "n_repeat_words",
            "base_failed",
            "distance",
            (~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= CUTOFF)).alias("kept"),
        )
    )

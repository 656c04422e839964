"""Quality rules: fixed ones, and robust multivariate outliers within each language and source. DataFrame functions only.

Every text gets a vector of transformed statistics (FEATURES). For each (language, source) group a minimum covariance
determinant estimate is sought by concentration steps: start at medians and quartile ranges, then again and again take
the ``share`` of the group with the smallest distances and re-estimate mean and covariance from it. A group takes a step
only if its determinant falls, and is done when it does not; the search ends when all groups are. There is one start, so
what is found is a local minimum near the medians. Distances are cut into fine bins to find that share, so a group's rows are counted and summed where they are,
whatever its size, and results do not depend on how the rows are spread. Rows whose squared Mahalanobis distance
exceeds ``cutoff`` are rejected. Each feature's variance has a floor: statistics that are zero nearly everywhere would
otherwise make any other value infinitely far; the floors are set so that symbols on about a twentieth of the
characters alone, or average words twice as long as is usual, lead to rejection.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

SPACE_RUN = r"[\x20\x09-\x0D]+"
#: A feature for each row: its name, SQL expression and the floor of its standard deviation.
FEATURES = (
    ("f_symbols", "asinh(1000.0 * n_symbols / greatest(word_chars, 1))", 0.8),
    ("f_length", "ln(greatest(word_chars, 1) / greatest(n_words, 1))", 0.1),
    ("f_lines", "asinh(cast(n_dup_lines as double))", 1.0),
    ("f_repeats", "asinh(100.0 * n_repeat_words / greatest(n_words, 1))", 1.0),
)
#: Share of a group the estimate rests on, and the 1 - 1e-6 quantile of chi-square with as many degrees as features.
SHARE, CUTOFF = 0.75, 33.38
#: What makes the scatter of the nearest SHARE of normal rows that of all: SHARE / P(chi2(6) <= 5.385), the latter being the
#: SHARE quantile for four features.
CONSISTENCY = 1.485
#: By how much a step has to lower a group's log determinant to be taken.
GAIN = 1e-6
#: Bins of a unit of log distance, and of a feature.
FINE = 256


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with columns that are computed once; a plain projection may be inlined into each of its uses."""
    made = F.explode_outer(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))).alias("_made")
    return df.select("*", made).select(*df.columns, *[F.col("_made")[n].alias(n) for n in columns])


def text_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed.

    Null and empty texts have no words. Existing columns of these names are replaced.
    """
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    docs = docs.select(*[c for c in docs.columns if c not in names])
    body = F.coalesce(docs[text].cast("string"), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = _once(docs, _words=F.array_remove(F.split(body, SPACE_RUN), ""), _lines=lines, _symbols=F.regexp_count(body, F.lit(r"[#*$%&|<>]")))
    windows = F.when(
        F.size("_words") >= 8,
        F.transform(F.sequence(F.lit(1), F.size("_words") - 7), lambda i: F.xxhash64(F.slice("_words", i, 8))),
    ).otherwise(F.array().cast("array<bigint>"))
    df = _once(
        df, n_words=F.size("_words").cast("long"), word_chars=F.char_length(F.array_join("_words", "")).cast("long"),
        n_dup_lines=(F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"), _windows=windows,
    ).drop("_words", "_lines")
    # windows sorted by hash: repeated ones are neighbours; their starts in order tell the words they cover
    df = _once(
        df,
        _sorted=F.when(
            F.size(F.array_distinct("_windows")) < F.size("_windows"),
            F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    ).drop("_windows")
    s = F.col("_sorted")
    starts = F.array_sort(F.transform(
        F.filter(
            F.transform(s, lambda x, j: F.struct(
                x["i"].alias("i"),
                (((j > 0) & (F.get(s, j - 1)["h"] == x["h"])) | F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False))).alias("r"),
            )),
            lambda x: x["r"],
        ),
        lambda x: x["i"],
    ))
    df = _once(df, _starts=starts).drop("_sorted")
    covered = F.aggregate(
        F.transform("_starts", lambda i, j: F.least(F.lit(8), F.coalesce(F.get("_starts", j + 1) - i, F.lit(8)))),
        F.lit(0).cast("long"), lambda a, x: a + x,
    )
    df = df.withColumns({"n_symbols": F.col("_symbols").cast("long"), "n_repeat_words": F.coalesce(covered, F.lit(0).cast("long"))})
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return df.drop("_starts", "_symbols").withColumn("base_failed", failed)


def _with_group(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with the columns of their group; null keys are keys."""
    groups = groups.withColumnsRenamed({k: f"_{k}" for k in keys})
    on = reduce(Column.__and__, [rows[k].eqNullSafe(groups[f"_{k}"]) for k in keys])
    return rows.join(groups, on).drop(*[f"_{k}" for k in keys])


def _quantile_of_bins(bins: DataFrame, keys: list[str], share: float) -> DataFrame:
    """The least bin below or in which ``share`` of the group's rows lie; ``bins`` has keys, bin, n."""
    along = Window.partitionBy(*keys).orderBy("bin")
    counted = bins.withColumns({"upto": F.sum("n").over(along), "all": F.sum("n").over(Window.partitionBy(*keys))})
    return counted.filter(F.col("upto") >= F.ceil(F.lit(share) * F.col("all"))).groupBy(*keys).agg(F.min("bin").alias("bin"))


def _distance(features: list[str]) -> Column:
    """Squared Mahalanobis distance from m_* with the Cholesky factor l_*_*: forward substitution, written out."""
    solved: list[Column] = []
    for i, f in enumerate(features):
        rest = F.col(f) - F.col(f"m_{i}")
        for j in range(i):
            rest = rest - F.col(f"l_{i}_{j}") * solved[j]
        solved.append(rest / F.col(f"l_{i}_{i}"))
    return reduce(Column.__add__, [y * y for y in solved])


def _factored(moments: DataFrame, keys: list[str], floors: list[float]) -> DataFrame:
    """m_*, l_*_* and ``logdet`` of each group from the sums over its chosen rows (n, s_*, s_*_*)."""
    size = len(floors)
    made = moments.select("*", *[(F.col(f"s_{i}") / F.col("n")).alias(f"m_{i}") for i in range(size)])
    for i in range(size):
        for j in range(i + 1):
            value = F.col(f"s_{i}_{j}") / F.col("n") - F.col(f"m_{i}") * F.col(f"m_{j}")
            # a quarter cut away makes variances too small: the factor that holds for normal data
            value = value * CONSISTENCY
            if i == j:
                value = F.greatest(value, F.lit(0.0)) + floors[i] ** 2
            for k in range(j):
                value = value - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            made = made.withColumn(
                f"l_{i}_{j}", F.sqrt(F.greatest(value, F.lit(floors[i] ** 2 / 4))) if i == j else value / F.col(f"l_{j}_{j}")
            )
    logdet = reduce(Column.__add__, [F.log(f"l_{i}_{i}") for i in range(size)]) * 2
    names = [f"m_{i}" for i in range(size)] + [f"l_{i}_{j}" for i in range(size) for j in range(i + 1)]
    return made.select(*keys, *names, logdet.alias("logdet"))


def robust_estimates(rows: DataFrame, keys: list[str], features: list[str], floors: list[float]) -> DataFrame:
    """Centre and Cholesky factor of each group's scatter. ``rows`` is a stored narrow table, read once a step."""
    binned = rows.select(
        *keys, F.posexplode(F.array(*[F.round(F.col(f) * FINE).cast("long") for f in features])).alias("feature", "bin")
    ).groupBy(*keys, "feature", "bin").agg(F.count("*").alias("n"))
    binned = written(binned, "feature_bins")
    by = [*keys, "feature"]
    quarters = [_quantile_of_bins(binned, by, q).withColumnRenamed("bin", f"q{int(q * 4)}") for q in (0.25, 0.5, 0.75)]
    table = quarters[0]
    for q in quarters[1:]:
        table = _with_group(table, q, by)
    start = table.groupBy(*keys).agg(
        *[F.max(F.when(F.col("feature") == i, F.col("q2") / FINE)).alias(f"m_{i}") for i in range(len(features))],
        *[
            F.max(F.when(F.col("feature") == i, F.sqrt(((F.col("q3") - F.col("q1")) / FINE / 1.349) ** 2 + floors[i] ** 2))).alias(f"l_{i}_{i}")
            for i in range(len(features))
        ],
    ).withColumns({f"l_{i}_{j}": F.lit(0.0) for i in range(len(features)) for j in range(i)})
    estimates = written(start.withColumns({"logdet": F.lit(None).cast("double"), "open": F.lit(True)}), "estimates")
    names = [c for c in estimates.columns if c not in (*keys, "open")]
    while not (open_ := estimates.filter("open").drop("open")).isEmpty():
        near = _with_group(rows, open_, keys).withColumn("bin", F.floor(F.log1p(_distance(features)) * FINE).cast("long"))
        # sums of each bin in fixed point, so that they do not depend on the order of addition
        sums = {f"s_{i}": F.col(f) for i, f in enumerate(features)}
        sums |= {f"s_{i}_{j}": F.col(features[i]) * F.col(features[j]) for i in range(len(features)) for j in range(i + 1)}
        bins = near.groupBy(*keys, "bin").agg(
            F.count("*").alias("n"), *[F.sum((c * 1e6).cast("decimal(28,0)")).alias(s) for s, c in sums.items()]
        )
        # bins up to the one in which the share is reached: those before whose beginning it is not
        along = Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        chosen = bins.withColumns({
            "before": F.coalesce(F.sum("n").over(along), F.lit(0)), "all": F.sum("n").over(Window.partitionBy(*keys)),
        }).filter(F.col("before") < F.ceil(F.lit(SHARE) * F.col("all")))
        moments = chosen.groupBy(*keys).agg(
            F.sum("n").cast("double").alias("n"), *[(F.sum(s).cast("double") / 1e6).alias(s) for s in sums]
        )
        new = _factored(moments, keys, floors).withColumnsRenamed({c: f"_{c}" for c in (*keys, *names)})
        same = reduce(Column.__and__, [estimates[k].eqNullSafe(new[f"_{k}"]) for k in keys])
        falls = F.coalesce(F.col("_logdet") < F.coalesce("logdet", F.lit(float("inf"))) - GAIN, F.lit(False))
        estimates = written(
            estimates.join(new, same, "left").select(
                *keys, *[F.when(falls, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in names], falls.alias("open")
            ),
            "estimates",
        )
    return estimates.drop("open")


def quality_verdicts(
    docs: DataFrame, text: str = "text", groups: tuple[str, ...] = ("lang", "source"), carry: tuple[str, ...] = ("doc_id",),
    cutoff: float = CUTOFF,
) -> DataFrame:
    """``carry`` columns, the statistics, base_failed, distance and kept (not base_failed, distance within cutoff).

    The estimates rest on rows that pass the base rules; a group without any has no estimate and its rows no distance.
    Null languages and sources are groups like others; null, empty and blank texts have no words and fail; repeated rows
    are judged each; columns not carried are ignored; an empty table gives an empty result. Stores the statistics with
    the carried columns when called.
    """
    features, floors = [n for n, _, _ in FEATURES], [s for _, _, s in FEATURES]
    keys = [f"g_{i}" for i in range(len(groups))]
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    given = docs.select(
        F.struct(*carry).alias("row"), docs[text].cast("string").alias("text"),
        *[docs[g].cast("string").alias(k) for g, k in zip(groups, keys)],
    )
    judged = text_statistics(given).drop("text").withColumns({n: F.expr(e) for n, e, _ in FEATURES})
    judged = written(judged, "statistics")
    fit = judged.filter(~F.col("base_failed")).select(*keys, *features)
    estimates = robust_estimates(fit, keys, features, floors)
    known = estimates.withColumnsRenamed({k: f"_{k}" for k in keys})
    on = reduce(Column.__and__, [judged[k].eqNullSafe(known[f"_{k}"]) for k in keys])
    distance = _distance(features)
    return judged.join(known, on, "left").select(
        *[F.col("row")[c].alias(c) for c in carry], *counts, distance.alias("distance"),
        (~F.col("base_failed") & F.coalesce(distance <= cutoff, F.lit(True))).alias("kept"),
    )

"""Profiles of a table: types, missingness, moments, quantiles, frequencies, correlations, distribution fits.

Every operator reads its columns in one pass: numeric columns share one aggregate, categorical ones one long
(column, value) count whose partial sums are made before the shuffle. Results are small long tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.coerce import to_double
from ..spec import NUMERIC
from .ranges import by_ranges

QUANTILES = (0.01, 0.05, 0.10, 0.25, 0.50, 0.75, 0.90, 0.95, 0.99)
#: Most ranks that are broadcast.
RANKS_SENT = 1_000_000


def rows_of(names: Sequence[str], **fields: Sequence[Column]) -> Column:
    """An array of structs (column, **fields), to explode the one wide row of an aggregate into a row per column."""
    return F.array(*(F.struct(F.lit(n).alias("column"), *(v[i].alias(k) for k, v in fields.items())) for i, n in enumerate(names)))


def explode_rows(one: DataFrame, names: Sequence[str], **fields: Sequence[Column]) -> DataFrame:
    return one.select(F.explode(rows_of(names, **fields)).alias("r")).select("r.*")


def long_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value) with values as strings, nulls included: one scan for all columns."""
    pairs = F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns))
    return df.select(F.explode(pairs).alias("p")).select("p.column", "p.value")


def infer_types(df: DataFrame, probe: int = 50, ratio: float = 0.10, few: int = 20) -> DataFrame:
    """column, position, semantic_type: boolean, integer, float, datetime, categorical, text or unknown.

    A string column is a datetime if its first `probe` non-null values all parse (so one without values is), categorical if its distinct values
    are under `ratio` of its non-null ones or `few` at most, else text.
    """
    spark = df.sparkSession
    by_type: dict[str, str] = {}
    strings = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    for f in df.schema:
        t = f.dataType
        by_type[f.name] = "boolean" if isinstance(t, T.BooleanType) else "integer" if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)) else "float" if isinstance(t, NUMERIC) else "datetime" if isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)) else "unknown"
    if strings:
        counts = df.agg(*(x for c in strings for x in (F.count(c).alias(f"{c}__n"), F.approx_count_distinct(c, 0.01).alias(f"{c}__d")))).first()
        for c in strings:
            sample = df.where(F.col(c).isNotNull()).select(c).limit(probe).agg(F.coalesce(F.bool_and(F.col(c).try_cast("timestamp").isNotNull()), F.lit(True))).first()[0]
            n, d = counts[f"{c}__n"], counts[f"{c}__d"]
            if d <= 2 * few:  # close to the limit: count exactly, over few values
                d = df.select(c).na.drop().distinct().limit(2 * few + 50).count()
            by_type[c] = "datetime" if sample else "categorical" if d / max(n, 1) < ratio or d <= few else "text"
    return spark.createDataFrame([(c, i, by_type[c]) for i, c in enumerate(df.columns)], "column string, position int, semantic_type string")


def table_meta(df: DataFrame) -> DataFrame:
    """One row: n_rows and n_columns."""
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)).cast("bigint"))


def base_stats(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """column, n_total, n_non_null, n_unique. exact counts distinct values in long form; otherwise by sketch in one pass."""
    if exact:
        pairs = long_values(df, columns).groupBy("column", "value").agg(F.count("*").alias("n"))
        return pairs.groupBy("column").agg(F.sum("n").alias("n_total"), F.sum(F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)).alias("n_non_null"), F.count("value").alias("n_unique"))
    one = df.agg(F.count("*").alias("t"), *(x for i, c in enumerate(columns) for x in (F.count(c).alias(f"n{i}"), F.approx_count_distinct(c).alias(f"u{i}"))))
    k = range(len(columns))
    return explode_rows(one, columns, n_total=[F.col("t") for _ in k], n_non_null=[F.col(f"n{i}") for i in k], n_unique=[F.col(f"u{i}") for i in k])


def missingness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, count, rate of the columns that have nulls."""
    k = range(len(columns))
    one = df.agg(F.count("*").alias("t"), *(F.count_if(F.col(c).isNull()).alias(f"m{i}") for i, c in enumerate(columns)))
    out = explode_rows(one, columns, count=[F.col(f"m{i}") for i in k], rate=[F.round(F.try_divide(F.col(f"m{i}").cast("double"), F.col("t")), 6) for i in k])
    return out.where(F.col("count") > 0)


def numeric_summary(df: DataFrame, columns: Sequence[str], quantile: str = "exact") -> DataFrame:
    """column, min, max, mean, median, std, variance (sample), skewness, kurtosis (population, excess).

    quantile: the method of `quantiles` that the median is taken by.
    """
    aggs = []
    for i, c in enumerate(columns):
        x = to_double(F.col(c))
        aggs += [F.min(x).alias(f"a{i}"), F.max(x).alias(f"b{i}"), F.avg(x).alias(f"c{i}"), F.stddev_samp(x).alias(f"e{i}"), F.var_samp(x).alias(f"f{i}"), F.skewness(x).alias(f"g{i}"), F.kurtosis(x).alias(f"h{i}")]
    names = dict(zip(("min", "max", "mean", "std", "variance", "skewness", "kurtosis"), "abcefgh", strict=True))
    rows = explode_rows(df.agg(*aggs), columns, **{k: [F.round(F.col(f"{v}{i}"), 6) for i in range(len(columns))] for k, v in names.items()})
    mid = quantiles(df, columns, (0.5,), quantile).select("column", F.round("value", 6).alias("median"))
    return rows.join(F.broadcast(mid), "column", "left").select("column", "min", "max", "mean", "median", "std", "variance", "skewness", "kurtosis")  # a row per column


def quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float] = QUANTILES, method: str = "exact") -> DataFrame:
    """column, prob, value with linear interpolation; a column without a number has no rows.

    method="exact" finds the ranks that the probabilities ask for from counts per value, dealt out by ranges, so no task holds a column's
    distinct values; "buffer" is as exact and holds them in one task's buffer, for columns that are known to have few; "approx" merges sketches.
    """
    if method == "exact":
        return _ranked_quantiles(df, columns, probs)
    made = [(F.percentile(to_double(F.col(c)), F.array(*map(F.lit, probs))) if method == "buffer" else F.percentile_approx(to_double(F.col(c)), list(probs), 10_000)).alias(f"q{i}") for i, c in enumerate(columns)]
    one = df.agg(*made)
    flat = explode_rows(one, columns, q=[F.col(f"q{i}") for i in range(len(columns))])
    at = F.array(*map(F.lit, probs))
    return flat.select("column", F.posexplode("q").alias("i", "value")).select("column", F.element_at(at, F.col("i") + 1).alias("prob"), "value")


def _ranked_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    cells = F.array(*(F.struct(F.lit(c).alias("column"), to_double(F.col(c)).alias("x")) for c in columns))
    counts = df.select(F.explode(cells).alias("c")).select("c.*").where("x IS NOT NULL").groupBy("column", "x").agg(F.count("*").alias("n"))
    ranged = by_ranges(counts, "column", "x")
    per = ranged.groupBy("column", "_range").agg(F.sum("n").alias("t"))  # columns times ranges
    earlier, every = Window.partitionBy("column").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("column")
    offsets = per.select("column", "_range", F.coalesce(F.sum("t").over(earlier), F.lit(0)).alias("before"), F.sum("t").over(every).alias("total"))
    inside = F.coalesce(F.sum("n").over(Window.partitionBy("column", "_range").orderBy("x").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = ranged.withColumn("_in", inside).join(F.broadcast(offsets), ["column", "_range"]).select("column", "x", (F.col("before") + F.col("_in")).alias("lo"), (F.col("before") + F.col("_in") + F.col("n")).alias("hi"), "total")
    # A value is kept for each probability whose rank, or the one above it, falls on it: two rows a probability at most.
    holds = lambda rank: (rank >= F.col("lo")) & (rank < F.col("hi"))
    rank = lambda p: (F.col("total") - 1) * p
    asked = F.filter(F.array(*map(F.lit, probs)), lambda p: holds(F.floor(rank(p))) | holds(F.ceil(rank(p))))
    hits = placed.withColumn("prob", F.explode(asked)).withColumn("at", rank(F.col("prob")))
    ends = hits.groupBy("column", "prob").agg(F.max(F.when(holds(F.floor("at")), F.col("x"))).alias("a"), F.max(F.when(holds(F.ceil("at")), F.col("x"))).alias("b"), F.max(F.col("at") - F.floor("at")).alias("part"))
    return ends.select("column", "prob", (F.col("a") + (F.col("b") - F.col("a")) * F.col("part")).alias("value"))  # between equal values, that value exactly


def frequency_table(df: DataFrame, columns: Sequence[str], top: int | None = 50) -> DataFrame:
    """column, value, count, proportion of the non-null, rank; equal counts are ordered by value. top=None keeps all."""
    counts = long_values(df, columns).where("value IS NOT NULL").groupBy("column", "value").agg(F.count("*").alias("count"))
    totals = counts.groupBy("column").agg(F.sum("count").alias("total"))
    ranked = counts.withColumn("rank", F.row_number().over(Window.partitionBy("column").orderBy(F.desc("count"), "value")))
    kept = ranked if top is None else ranked.where(F.col("rank") <= top)
    return kept.join(F.broadcast(totals), "column").select("column", "value", "count", (F.col("count") / F.col("total")).alias("proportion"), "rank")


def mode_and_entropy(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, mode, mode_frequency, entropy_nats, entropy_bits over all values."""
    counts = long_values(df, columns).where("value IS NOT NULL").groupBy("column", "value").agg(F.count("*").alias("n"))
    # H = ln N - sum(n ln n) / N, so one pass over the counts is enough.
    agg = counts.groupBy("column").agg(F.sum("n").alias("t"), F.sum(F.col("n") * F.ln("n")).alias("s"), F.max(F.struct(F.col("n"))).alias("m"), F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode"), F.max("n").alias("top"))
    nats = F.ln("t") - F.col("s") / F.col("t")
    return agg.select("column", "mode", (F.col("top") / F.col("t")).alias("mode_frequency"), nats.alias("entropy_nats"), (nats / F.ln(F.lit(2.0))).alias("entropy_bits"))


def datetime_stats(df: DataFrame, column: str) -> DataFrame:
    """min, max, range_days, median, mean_gap_s and std_gap_s of consecutive sorted values.

    Gaps are taken inside ranges of the column; the one between two ranges comes from their ends, a row per range.
    """
    ts = df.where(F.col(column).isNotNull()).select((F.unix_micros(F.col(column).cast("timestamp")) / 1e6).alias("s"))
    head = ts.agg(F.min("s").alias("lo"), F.max("s").alias("hi"), F.percentile("s", F.lit(0.5)).alias("mid"))
    ranged = by_ranges(ts, "s")
    inner = ranged.withColumn("gap", F.col("s") - F.lag("s").over(Window.partitionBy("_range").orderBy("s")))
    per = inner.groupBy("_range").agg(F.count("gap").alias("n"), F.sum("gap").alias("g"), F.sum(F.col("gap") * F.col("gap")).alias("g2"), F.min("s").alias("lo"), F.max("s").alias("hi"))
    between = F.col("lo") - F.lag("hi").over(Window.orderBy("_range"))
    every = per.withColumn("b", between).agg((F.sum("n") + F.count("b")).alias("n"), (F.coalesce(F.sum("g"), F.lit(0.0)) + F.coalesce(F.sum("b"), F.lit(0.0))).alias("g"), (F.coalesce(F.sum("g2"), F.lit(0.0)) + F.coalesce(F.sum(F.col("b") * F.col("b")), F.lit(0.0))).alias("g2"))
    var = F.greatest((F.col("g2") - F.col("g") * F.col("g") / F.col("n")) / (F.col("n") - 1), F.lit(0.0))
    return head.crossJoin(F.broadcast(every)).select(  # one row with one row
        F.timestamp_seconds("lo").alias("min"), F.timestamp_seconds("hi").alias("max"), F.round((F.col("hi") - F.col("lo")) / 86400, 2).alias("range_days"), F.timestamp_seconds("mid").alias("median"),
        F.when(F.col("n") > 0, F.col("g") / F.col("n")).alias("mean_gap_s"), F.when(F.col("n") > 1, F.sqrt(var)).alias("std_gap_s"),
    )


def boolean_rates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, true_rate, false_rate among the non-null."""
    one = df.agg(*(F.avg(F.col(c).cast("boolean").cast("double")).alias(f"t{i}") for i, c in enumerate(columns)))
    return explode_rows(one, columns, true_rate=[F.col(f"t{i}") for i in range(len(columns))], false_rate=[1 - F.col(f"t{i}") for i in range(len(columns))])


def pearson_expr(a: Column, b: Column) -> Column:
    """Correlation over rows where both are there; null where one of them is constant or fewer than two rows are left."""
    x, y = F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)
    return F.when((F.min(x) < F.max(x)) & (F.min(y) < F.max(y)), F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)))


def pearson_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """col_a, col_b, n, r for each unordered pair: one pass, pairwise deletion."""
    pairs = list(combinations(columns, 2))
    aggs = []
    for i, (a, b) in enumerate(pairs):
        x, y = to_double(F.col(a)), to_double(F.col(b))
        aggs += [F.count_if(x.isNotNull() & y.isNotNull()).alias(f"n{i}"), pearson_expr(x, y).alias(f"r{i}")]
    rows = F.array(*(F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"n{i}").alias("n"), F.col(f"r{i}").alias("r")) for i, (a, b) in enumerate(pairs)))
    return df.agg(*aggs).select(F.explode(rows).alias("p")).select("p.*")


def average_ranks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """df's complete rows over the columns, with `<column>__rank`: the average rank of equal values.

    Ranks come from counts per value with running sums per range of values, so no column is sorted in one task. A table of up to a million
    ranks (some 24 MB) is broadcast, so rows are not shuffled; a larger one is joined by shuffles, whose hot values the planner splits.
    """
    base = df.select(*(to_double(F.col(c)).alias(c) for c in columns)).na.drop()
    out = base
    for c in columns:
        counts = by_ranges(base.groupBy(c).agg(F.count("*").alias("_n")), c)
        inside = F.sum("_n").over(Window.partitionBy("_range").orderBy(c).rowsBetween(Window.unboundedPreceding, -1))
        offset = counts.groupBy("_range").agg(F.sum("_n").alias("_t")).withColumn("_before", F.coalesce(F.sum("_t").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_t")
        ranks = counts.withColumn("_in", F.coalesce(inside, F.lit(0))).join(F.broadcast(offset), "_range").select(c, (F.col("_before") + F.col("_in") + (F.col("_n") + 1) / 2).alias(f"{c}__rank"))
        out = out.join(F.broadcast(ranks) if counts.count() <= RANKS_SENT else ranks, c)  # counts are checkpointed
    return out


def spearman_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """col_a, col_b, r of average ranks, rows with any null left out."""
    ranked = average_ranks(df, columns).select(*(F.col(f"{c}__rank").alias(c) for c in columns))
    return pearson_pairs(ranked, columns).select("col_a", "col_b", "r")


def strong_pairs(pairs: DataFrame, least: float = 0.5) -> DataFrame:
    return pairs.where(F.abs("r") > least)


def cramers_v(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """col_a, col_b, n, v without continuity correction; 0 where a side has one level. Rows with a null in the pair are left out."""
    both = F.array(*(F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(a).cast("string").alias("x"), F.col(b).cast("string").alias("y")) for a, b in pairs))
    cells = df.select(F.explode(both).alias("p")).select("p.*").where("x IS NOT NULL AND y IS NOT NULL").groupBy("col_a", "col_b", "x", "y").agg(F.count("*").alias("o"))
    key = ["col_a", "col_b"]
    by = lambda *c: F.sum("o").over(Window.partitionBy(*key, *c)).cast("double")
    parts = cells.select(*key, "o", "x", "y", (F.col("o") * F.col("o") / (by("x") * by("y"))).alias("s"))
    tot = parts.groupBy(*key).agg(F.sum("o").alias("n"), F.sum("s").alias("s"), F.countDistinct("x").alias("r"), F.countDistinct("y").alias("k"))
    least = F.least("r", "k") - 1
    return tot.select(*key, "n", F.when(least > 0, F.sqrt(F.greatest(F.col("s") - 1, F.lit(0.0)) / least)).otherwise(0.0).alias("v"))


def point_biserial(df: DataFrame, binary: Sequence[str], numeric: Sequence[str], least_n: int = 4) -> DataFrame:
    """binary, numeric, n, r, p of each two-valued column's code (0 for its lesser value) with each number."""
    ends = df.agg(*(x for i, b in enumerate(binary) for x in (F.min(F.col(b).cast("string")).alias(f"lo{i}"), F.max(F.col(b).cast("string")).alias(f"hi{i}"))))
    wide = df.crossJoin(F.broadcast(ends))  # one row
    pairs = [(i, b, x) for i, b in enumerate(binary) for x in numeric]
    aggs = []
    for j, (i, b, x) in enumerate(pairs):
        code = F.when(F.col(b).isNotNull(), (F.col(b).cast("string") == F.col(f"hi{i}")).cast("double"))
        v = to_double(F.col(x))
        aggs += [F.count_if(code.isNotNull() & v.isNotNull()).alias(f"n{j}"), pearson_expr(code, v).alias(f"r{j}")]
    rows = F.array(*(F.struct(F.lit(b).alias("binary"), F.lit(x).alias("numeric"), F.col(f"n{j}").alias("n"), F.col(f"r{j}").alias("r")) for j, (_, b, x) in enumerate(pairs)))
    out = wide.agg(*aggs).select(F.explode(rows).alias("p")).select("p.*").where((F.col("n") >= least_n) & F.col("r").isNotNull())
    return out.withColumn("p", F.udf(lambda r, n: t_two_sided(r, n), "double")("r", "n"))  # a row per pair of columns


# -- small-sample mathematics on the driver or a row per column -------------------------------------------------


def _beta_fraction(a: float, b: float, x: float) -> float:
    """The continued fraction of the incomplete beta function, by the modified Lentz method."""
    tiny, c = 1e-300, 1.0
    d = 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 400):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + num * d
            d = 1 / (d if abs(d) > tiny else tiny)
            c = 1 + num / c
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1) < 1e-14:
            break
    return h


def incomplete_beta(a: float, b: float, x: float) -> float:
    from math import exp, lgamma, log, log1p

    if x <= 0 or x >= 1:
        return float(x >= 1)
    front = exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * log(x) + b * log1p(-x))
    return front * _beta_fraction(a, b, x) / a if x < (a + 1) / (a + b + 2) else 1 - front * _beta_fraction(b, a, 1 - x) / b


def t_two_sided(r: float | None, n: int) -> float | None:
    """The two-sided p of a correlation over n rows."""
    if r is None or n < 3:
        return None
    if abs(r) >= 1:
        return 0.0
    t2 = r * r * (n - 2) / (1 - r * r)
    return incomplete_beta((n - 2) / 2, 0.5, (n - 2) / (n - 2 + t2))


def _log_gamma(x: np.ndarray | float) -> float:
    from math import lgamma

    return lgamma(x)


def _digamma(x: float) -> float:
    total = 0.0
    while x < 8:
        total -= 1 / x
        x += 1
    y = 1 / (x * x)
    return total + float(np.log(x)) - 0.5 / x - y * (1 / 12 - y * (1 / 120 - y / 252))


def _trigamma(x: float) -> float:
    total = 0.0
    while x < 8:
        total += 1 / (x * x)
        x += 1
    y = 1 / (x * x)
    return total + 1 / x + y / 2 + y / x * (1 / 6 - y * (1 / 30 - y / 42))


def best_fit(n: int, s: dict[str, float]) -> tuple[str, float] | None:
    """The distribution with the least AIC from sufficient statistics.

    s: mean, var (population), min, max, mean_log and var_log (of positive columns), and mean_u_log, mean_1u_log (logs of the
    value scaled into (0, 1) and of its complement).
    """
    from math import log, pi

    if n < 10 or s["var"] <= 0:
        return None
    aic: dict[str, float] = {"norm": n * (log(2 * pi * s["var"]) + 1) + 4, "uniform": 2 * n * log(s["max"] - s["min"]) + 4}
    spread = s["mean"] - s["min"]
    if spread > 0:
        aic["expon"] = 2 * n * (log(spread) + 1) + 4
    if s["min"] > 0 and s["var_log"] > 0:
        aic["lognorm"] = n * (log(2 * pi * s["var_log"]) + 1) + 2 * n * s["mean_log"] + 4
        gap = log(s["mean"]) - s["mean_log"]
        if gap > 0:
            k = (3 - gap + ((gap - 3) ** 2 + 24 * gap) ** 0.5) / (12 * gap)
            for _ in range(50):
                k = max(1e-8, k - (log(k) - _digamma(k) - gap) / (1 / k - _trigamma(k)))
            theta = s["mean"] / k
            aic["gamma"] = -2 * n * ((k - 1) * s["mean_log"] - s["mean"] / theta - k * log(theta) - _log_gamma(k)) + 4
    scale = (s["max"] - s["min"]) * (1 + 2e-6)
    m, v = (s["mean"] - s["min"]) / scale + 1e-6, s["var"] / scale**2
    if 0 < m < 1 and v < m * (1 - m):
        a, b = m * (m * (1 - m) / v - 1), (1 - m) * (m * (1 - m) / v - 1)
        for _ in range(100):
            g = np.array([s["mean_u_log"] - _digamma(a) + _digamma(a + b), s["mean_1u_log"] - _digamma(b) + _digamma(a + b)])
            t = _trigamma(a + b)
            step = np.linalg.solve(np.array([[t - _trigamma(a), t], [t, t - _trigamma(b)]]), -g)
            a, b = max(1e-6, a + step[0]), max(1e-6, b + step[1])
        aic["beta"] = -2 * n * ((a - 1) * s["mean_u_log"] + (b - 1) * s["mean_1u_log"] - _log_gamma(a) - _log_gamma(b) + _log_gamma(a + b) - log(scale)) + 8
    name = min(aic, key=aic.__getitem__)
    return name, float(aic[name])


def best_distributions(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, distribution, aic: norm, uniform, expon, lognorm, gamma or beta by least AIC, from two aggregates over all rows."""
    ends = df.agg(*(x for i, c in enumerate(columns) for x in (F.min(to_double(F.col(c))).alias(f"lo{i}"), F.max(to_double(F.col(c))).alias(f"hi{i}")))).first()
    aggs = []
    for i, c in enumerate(columns):
        x, lo, hi = to_double(F.col(c)), ends[f"lo{i}"] or 0.0, ends[f"hi{i}"] or 0.0
        logx = F.when(x > 0, F.ln(x))
        u = (x - F.lit(lo)) / F.lit((hi - lo) * (1 + 2e-6) or 1.0) + F.lit(1e-6)
        for k, e in (("n", F.count(x)), ("mean", F.avg(x)), ("var", F.var_pop(x)), ("mean_log", F.avg(logx)), ("var_log", F.var_pop(logx)), ("mean_u_log", F.avg(F.ln(u))), ("mean_1u_log", F.avg(F.ln(1 - u)))):
            aggs.append(e.alias(f"{k}{i}"))
    got = df.agg(*aggs).first()
    rows = []
    for i, c in enumerate(columns):
        s = {k: got[f"{k}{i}"] for k in ("mean", "var", "mean_log", "var_log", "mean_u_log", "mean_1u_log")} | {"min": ends[f"lo{i}"], "max": ends[f"hi{i}"]}
        fit = best_fit(got[f"n{i}"], s) if got[f"n{i}"] else None
        rows.append((c, *(fit or (None, None))))
    return df.sparkSession.createDataFrame(rows, "column string, distribution string, aic double")


def pca(df: DataFrame, columns: Sequence[str], share: float = 0.9) -> DataFrame:
    """component, variance_ratio, cumulative_ratio, needed (for `share`): eigenvalues of the correlation matrix of complete rows."""
    complete = df.select(*(to_double(F.col(c)).alias(c) for c in columns)).na.drop()
    r = {(p["col_a"], p["col_b"]): p["r"] or 0.0 for p in pearson_pairs(complete, columns).collect()}  # columns squared
    m = np.array([[1.0 if a == b else r.get((a, b), r.get((b, a))) for b in columns] for a in columns])
    ratio = np.sort(np.linalg.eigvalsh(m))[::-1] / len(columns)
    total = np.cumsum(ratio)
    need = int(np.searchsorted(total, share - 1e-12) + 1)
    return df.sparkSession.createDataFrame([(i + 1, float(x), float(t), i < need) for i, (x, t) in enumerate(zip(ratio, total, strict=True))], "component int, variance_ratio double, cumulative_ratio double, needed boolean")


def _normal_cdf(z: float) -> float:
    from math import erfc

    return 0.5 * erfc(-z / 2**0.5)


def _normal_quantile(p: np.ndarray) -> np.ndarray:
    from statistics import NormalDist

    return np.array([NormalDist().inv_cdf(float(x)) for x in p])


def shapiro(x: np.ndarray) -> tuple[float, float] | None:
    """W and p of Royston's 1995 approximation for 8 to 5000 values; None outside, or where all are equal."""
    x = np.sort(np.asarray(x, float))
    n = len(x)
    if not 8 <= n <= 5000 or x[0] == x[-1]:
        return None
    m = _normal_quantile((np.arange(1, n + 1) - 0.375) / (n + 0.25))
    c, u = m / np.sqrt(m @ m), 1 / np.sqrt(n)
    # Coefficients of the published polynomials.
    last = np.polyval([-2.706056, 4.434685, -2.071190, -0.147981, 0.221157, c[-1]], u)
    before = np.polyval([-3.582633, 5.682633, -1.752461, -0.293762, 0.042981, c[-2]], u)
    a = np.zeros(n)
    phi = (m @ m - 2 * m[-1] ** 2 - 2 * m[-2] ** 2) / (1 - 2 * last**2 - 2 * before**2)
    a[2:-2] = m[2:-2] / np.sqrt(phi)
    a[-1], a[-2], a[0], a[1] = last, before, -last, -before
    w = float((a @ x) ** 2 / ((x - x.mean()) @ (x - x.mean())))
    y = np.log(max(1 - w, 1e-300))
    if n <= 11:
        gamma = 0.459 * n - 2.273
        if y >= gamma:
            return w, 0.0
        y, mu, sigma = -np.log(gamma - y), np.polyval([-0.0006714, 0.025054, -0.39978, 0.5440], n), np.exp(np.polyval([-0.0020322, 0.062767, -0.77857, 1.3822], n))
    else:
        k = np.log(n)
        mu, sigma = np.polyval([0.0038915, -0.083751, -0.31082, -1.5861], k), np.exp(np.polyval([0.0030302, -0.082676, -0.4803], k))
    return w, 1 - _normal_cdf(float((y - mu) / sigma))


def shapiro_wilk(df: DataFrame, columns: Sequence[str], key: Sequence[str], seed: int = 42, most: int = 5000) -> DataFrame:
    """column, n, w, p on a hash-ordered sample of at most `most` values a column (the test's own limit)."""
    from ..functions.rng import hash_order

    rows = []
    for c in columns:
        x = df.select(to_double(F.col(c)).alias("x"), *key).where("x IS NOT NULL").orderBy(*hash_order(seed, *(F.col(k) for k in key))).limit(most).select("x").collect()
        got = shapiro(np.array([r[0] for r in x]))
        rows.append((c, len(x), *((None, None) if got is None else got)))
    return df.sparkSession.createDataFrame(rows, "column string, n long, w double, p double")

"""Differential privacy of published statistics: Laplace noise on long tables of counts and moments.

Noise is a function of the seed and the cell's name, so a run is repeatable on any partitioning. Tables here have a row
per column, value or pair; rows of the data are never touched.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rng import laplace

#: Shares of the budget.
BUDGET = {"proportions": 0.40, "numeric": 0.30, "missing": 0.10, "correlations": 0.20}


def split_budget(epsilon: float, columns: Mapping[str, int] | None = None) -> dict[str, float]:
    """The family's share of epsilon; with numbers of columns, of each column of a family, so that the whole adds up to epsilon."""
    if epsilon <= 0:
        raise ValueError("epsilon must be positive")
    return {k: epsilon * s / max(1, (columns or {}).get(k, 1)) for k, s in BUDGET.items()}


def dp_proportions(freq: DataFrame, epsilon: float, seed: int | str = 42) -> DataFrame:
    """column, value, count, proportion of a (column, value, count) table with Lap(2 / epsilon) on counts, floored at 0, normalised.

    A column whose noised counts are all 0 has a total of 1.
    """
    noisy = F.greatest(F.lit(0.0), F.col("count") + laplace(2.0 / epsilon, seed, F.col("column"), F.col("value")))
    out = freq.select("column", "value", noisy.alias("count"))
    total = F.sum("count").over(Window.partitionBy("column"))
    return out.select("column", "value", "count", F.round(F.col("count") / F.when(total > 0, total).otherwise(1.0), 6).alias("proportion"))


def dp_modes(noised: DataFrame) -> DataFrame:
    """column, mode, mode_frequency of noised proportions."""
    return noised.groupBy("column").agg(F.min_by("value", F.struct(-F.col("proportion"), F.col("value"))).alias("mode"), F.max("proportion").alias("mode_frequency"))


def dp_numeric(summary: DataFrame, n: Column | int, epsilon: float, seed: int | str = 42) -> DataFrame:
    """column, min, max, mean, median, std of a summary table with Lap((max - min) / n / epsilon); means and medians stay in range."""
    width = F.greatest(F.col("max") - F.col("min"), F.lit(1e-9))
    scale = width / (n if isinstance(n, Column) else F.lit(float(n))) / F.lit(float(epsilon))
    noised = lambda c: F.col(c) + laplace(scale, seed, F.col("column"), F.lit(c))
    inside = lambda x: F.least(F.greatest(x, F.col("min")), F.col("max"))
    return summary.select("column", "min", "max", F.round(inside(noised("mean")), 6).alias("mean"), F.round(inside(noised("median")), 6).alias("median"), F.round(F.greatest(noised("std"), F.lit(0.0)), 6).alias("std"))


def dp_quantiles(quantiles: DataFrame, ends: DataFrame, n: int, epsilon: float, seed: int | str = 42) -> DataFrame:
    """column, prob, value: monotone noised quantiles.

    The gaps between min, quantiles and max get noise, are floored at 0, scaled to the range again and added up. quantiles: column, prob,
    value; ends: column, min, max. A column's few quantiles are one window.
    """
    w = Window.partitionBy("column").orderBy("prob")
    base = quantiles.join(ends.select("column", "min", "max"), "column")
    width = F.greatest(F.col("max") - F.col("min"), F.lit(1e-9))
    scale = width / F.lit(float(n)) / F.lit(float(epsilon))
    gap = F.greatest(F.lit(0.0), F.col("value") - F.coalesce(F.lag("value").over(w), F.col("min")))
    last = F.greatest(F.lit(0.0), F.col("max") - F.col("value"))
    g = base.withColumn("g", F.greatest(F.lit(0.0), gap + laplace(scale, seed, F.col("column"), F.col("prob"))))
    tail = F.last(F.greatest(F.lit(0.0), last + laplace(scale, seed, F.col("column"), F.lit("tail")))).over(Window.partitionBy("column").orderBy("prob").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    total = F.sum("g").over(Window.partitionBy("column")) + tail
    return g.select("column", "prob", F.round(F.col("min") + F.sum("g").over(w) * F.when(total > 0, width / total).otherwise(0.0), 4).alias("value"))


def dp_missing(missing: DataFrame, n_total: int, epsilon: float, seed: int | str = 42) -> DataFrame:
    """column, count, rate with Lap(1 / epsilon) on the number of values that are there, cut to whole numbers in [0, n]."""
    there = F.lit(float(n_total)) - F.col("count") + laplace(1.0 / epsilon, seed, F.col("column"), F.lit("non_null"))
    whole = F.least(F.greatest(there, F.lit(0.0)), F.lit(float(n_total))).cast("bigint")
    return missing.select("column", (F.lit(n_total) - whole).alias("count"), F.round((F.lit(n_total) - whole) / F.lit(float(max(n_total, 1))), 6).alias("rate"))


def nearest_correlation(m: np.ndarray) -> np.ndarray:
    """Eigenvalues floored at 0, unit diagonal, entries in [-1, 1]: a correlation matrix near m; one that is valid is left as it is."""
    values, vectors = np.linalg.eigh((m + m.T) / 2)
    fixed = (vectors * np.maximum(values, 0)) @ vectors.T
    d = np.sqrt(np.maximum(np.diag(fixed), 1e-12))
    out = np.clip(fixed / np.outer(d, d), -1, 1)
    np.fill_diagonal(out, 1.0)
    return out


def dp_correlations(pairs: DataFrame, columns: Sequence[str], n: int, epsilon: float, seed: int | str = 42) -> DataFrame:
    """col_a, col_b, r with Lap(2 / (sqrt(n) epsilon)) on the upper triangle, made a correlation matrix again: columns squared numbers on the driver."""
    noisy = pairs.select("col_a", "col_b", (F.coalesce("r", F.lit(0.0)) + laplace(2.0 / (max(n, 1) ** 0.5 * epsilon), seed, F.col("col_a"), F.col("col_b"))).alias("r")).collect()
    at = {c: i for i, c in enumerate(columns)}
    m = np.eye(len(columns))
    for p in noisy:
        i, j = at[p["col_a"]], at[p["col_b"]]
        m[i, j] = m[j, i] = p["r"]
    fixed = nearest_correlation(m)
    rows = [(p["col_a"], p["col_b"], round(float(fixed[at[p["col_a"]], at[p["col_b"]]]), 4)) for p in noisy]
    return pairs.sparkSession.createDataFrame(rows, "col_a string, col_b string, r double")


def dp_drift(raw: DataFrame, noised: DataFrame, key: Sequence[str], value: str, least: float = 0.0) -> DataFrame:
    """n, max_drift, mean_drift between a raw and a noised long table, over cells that moved by more than `least`."""
    a, b = raw.select(*key, F.col(value).alias("a")), noised.select(*key, F.col(value).alias("b"))
    d = F.abs(F.col("a") - F.col("b"))
    return a.join(b, list(key)).where(d > least).agg(F.count("*").alias("n"), F.max(d).alias("max_drift"), F.avg(d).alias("mean_drift"))

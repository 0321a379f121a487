"""Drift between a seed and a synthetic table: PSI, KS, frequencies, coverage, correlation, missingness.

Both tables are read once; what meets in a join are counts per value or bin.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.coerce import to_double, to_text
from .profile import QUANTILES, cramers_v, long_values, pearson_pairs, quantiles
from .ranges import by_ranges

FLOOR = 1e-4


def psi_status(psi: Column, stable: float = 0.10, monitor: float = 0.20) -> Column:
    return F.when(psi < stable, "stable").when(psi < monitor, "monitor").otherwise("unstable")


def value_shares(df: DataFrame, columns: Sequence[str], nulls: bool = False) -> DataFrame:
    """column, value, n, p: shares among the non-null, or among all rows with null as `nan`."""
    flat = long_values(df, columns)
    flat = flat.withColumn("value", to_text(F.col("value"))) if nulls else flat.where("value IS NOT NULL")
    n = flat.groupBy("column", "value").agg(F.count("*").alias("n"))
    totals = n.groupBy("column").agg(F.sum("n").alias("t"))  # a row per column
    return n.join(F.broadcast(totals), "column").select("column", "value", "n", (F.col("n") / F.col("t")).alias("p"))


def psi_categorical(seed: DataFrame, synth: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """column, kind, psi, n_bins. A bin per seed value, and one for all others; shares are floored at 1e-4 on both sides.

    Seed shares are rounded to `digits`, as a stored profile's are, so the residue can make a bin of others of no weight.
    """
    e = value_shares(seed, columns).select("column", "value", F.round("p", digits).alias("e"))
    a = value_shares(synth, columns, nulls=True).select("column", "value", F.col("p").alias("a"))
    met = e.join(a, ["column", "value"], "full_outer")
    act, exp = F.greatest(F.coalesce("a", F.lit(0.0)), F.lit(FLOOR)), F.greatest("e", F.lit(FLOOR))
    per = met.groupBy("column").agg(
        F.sum(F.when(F.col("e").isNotNull(), (act - exp) * F.ln(act / exp))).alias("s"), F.count("e").alias("k"),
        F.greatest(1 - F.sum("e"), F.lit(0.0)).alias("eo"), F.coalesce(F.sum(F.when(F.col("e").isNull(), F.col("a"))), F.lit(0.0)).alias("ao"),
    )
    eo, ao = F.greatest("eo", F.lit(FLOOR)), F.greatest("ao", F.lit(FLOOR))
    other = (F.col("eo") > 1e-9) | (F.col("ao") > 0)
    return per.select("column", F.lit("categorical").alias("kind"), F.when(other, F.col("s") + (ao - eo) * F.ln(ao / eo)).otherwise(F.col("s")).alias("psi"), (F.col("k") + other.cast("long")).alias("n_bins"))


def _edges(seed: DataFrame, columns: Sequence[str], method: str, keep: str) -> DataFrame:
    """One row per column: edges and their probabilities, each distinct quantile once with the first (or last) probability seen."""
    found = quantiles(seed, columns, QUANTILES, method).where("value IS NOT NULL")
    per = found.groupBy("column", F.col("value").alias("edge")).agg((F.min("prob") if keep == "first" else F.max("prob")).alias("prob"))
    return per.groupBy("column").agg(F.array_sort(F.collect_list(F.struct("edge", "prob"))).alias("edges"))  # nine edges at most


def psi_numeric(seed: DataFrame, synth: DataFrame, columns: Sequence[str], method: str = "exact", keep: str = "first") -> DataFrame:
    """column, kind, psi, n_bins. Bins are closed above between the seed's distinct quantiles; the floor is inside the logarithm only.

    keep: which probability a repeated quantile has; "last" is the corrected reading of columns with many equal values.
    Fewer than two edges, or no synthetic number, give 0 and 0.
    """
    edges = _edges(seed, columns, method, keep)
    pairs = F.array(*(F.struct(F.lit(c).alias("column"), to_double(F.col(c)).alias("x")) for c in columns))
    values = synth.select(F.explode(pairs).alias("p")).select("p.*").where("x IS NOT NULL")
    # Edges, a row per column, go to the rows, so what is shuffled has a row per column and bin.
    binned = values.join(F.broadcast(edges), "column").withColumn("bin", F.size(F.filter("edges", lambda e: e["edge"] < F.col("x")))).groupBy("column", "bin").agg(F.count("*").alias("n"))
    probs = edges.select("column", F.size("edges").alias("k"), F.concat(F.array(F.lit(0.0)), F.col("edges.prob"), F.array(F.lit(1.0))).alias("cum"))
    expected = probs.select("column", "k", F.posexplode(F.transform(F.sequence(F.lit(1), F.col("k") + 1), lambda i: F.element_at(F.col("cum"), i + 1) - F.element_at(F.col("cum"), i))).alias("bin", "e"))
    totals = binned.groupBy("column").agg(F.sum("n").alias("t"))
    met = expected.join(totals, "column", "left").join(binned, ["column", "bin"], "left")
    a = F.coalesce(F.col("n"), F.lit(0)) / F.col("t")
    term = (a - F.col("e")) * F.ln(F.greatest(a, F.lit(FLOOR)) / F.greatest("e", F.lit(FLOOR)))
    per = met.groupBy("column", "k").agg(F.sum(term).alias("s"), F.max("t").alias("t"))
    live = (F.col("k") >= 2) & F.col("t").isNotNull()
    out = per.select("column", F.lit("numeric").alias("kind"), F.when(live, F.col("s")).otherwise(0.0).alias("psi"), F.when(live, F.col("k") + 1).otherwise(0).cast("long").alias("n_bins"))
    named = seed.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    return named.join(out, "column", "left").select("column", F.lit("numeric").alias("kind"), F.coalesce("psi", F.lit(0.0)).alias("psi"), F.coalesce("n_bins", F.lit(0).cast("long")).alias("n_bins"))


def psi_report(seed: DataFrame, synth: DataFrame, categorical: Sequence[str], numeric: Sequence[str], method: str = "exact") -> DataFrame:
    """column, kind, psi, n_bins, status of all columns."""
    both = psi_categorical(seed, synth, categorical).unionByName(psi_numeric(seed, synth, numeric, method))
    return both.select("column", "kind", F.round("psi", 6).alias("psi"), "n_bins", psi_status(F.round("psi", 6)).alias("status"))


def psi_summary(report: DataFrame) -> DataFrame:
    """n_columns, mean_psi, worst_column, worst_psi and the number of columns of each status."""
    return report.agg(
        F.count("*").alias("n_columns"), F.avg("psi").alias("mean_psi"), F.min_by("column", F.struct(-F.col("psi"), F.col("column"))).alias("worst_column"), F.max("psi").alias("worst_psi"),
        *(F.count_if(F.col("status") == s).alias(f"n_{s}") for s in ("stable", "monitor", "unstable")),
    )


def frequency_align(seed: DataFrame, synth: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, value, seed_p, synth_p of the union of values; 0 where one side lacks it."""
    a, b = value_shares(seed, columns), value_shares(synth, columns)
    return a.select("column", "value", F.col("p").alias("seed_p")).join(b.select("column", "value", F.col("p").alias("synth_p")), ["column", "value"], "full_outer").na.fill(0.0, ["seed_p", "synth_p"])


def categorical_drift(seed: DataFrame, synth: DataFrame, columns: Sequence[str], tolerance: float = 0.05) -> DataFrame:
    """column, value, seed_p, synth_p, change, severity: novel HIGH, absent and drifted MEDIUM; values within tolerance are left out."""
    met = frequency_align(seed, synth, columns)
    kind = F.when(F.col("seed_p") == 0, "novel").when(F.col("synth_p") == 0, "absent").when(F.abs(F.col("synth_p") - F.col("seed_p")) > tolerance, "drifted")
    return met.withColumn("change", kind).where("change IS NOT NULL").withColumn("severity", F.when(F.col("change") == "novel", "HIGH").otherwise("MEDIUM"))


def top_drifts(drift: DataFrame, n: int = 5) -> DataFrame:
    """The n greatest drifts of each column."""
    w = Window.partitionBy("column").orderBy(F.desc(F.abs(F.col("synth_p") - F.col("seed_p"))), "value")
    return drift.withColumn("at", F.row_number().over(w)).where(F.col("at") <= n).drop("at")


def cardinality_check(seed: DataFrame, synth: DataFrame, columns: Sequence[str], ratio: float = 1.2) -> DataFrame:
    """column, seed_n, synth_n, severity: LOW where the synthetic table has over `ratio` times the values."""
    n = lambda df, name: long_values(df, columns).where("value IS NOT NULL").distinct().groupBy("column").agg(F.count("*").alias(name))
    met = n(seed, "seed_n").join(n(synth, "synth_n"), "column", "full_outer").na.fill(0)
    return met.withColumn("severity", F.when(F.col("synth_n") > ratio * F.col("seed_n"), F.lit("LOW")))


def null_rate_check(seed: DataFrame, synth: DataFrame, columns: Sequence[str], tolerance: float = 0.05) -> DataFrame:
    """column, seed_rate, synth_rate, error, severity: HIGH where the synthetic rate is more than tolerance above."""

    def rates(df: DataFrame, name: str) -> DataFrame:
        one = df.agg(*(F.avg(F.col(c).isNull().cast("double")).alias(f"m{i}") for i, c in enumerate(columns)))
        return one.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias(name)) for i, c in enumerate(columns)))).alias("r")).select("r.*")

    met = rates(seed, "seed_rate").join(rates(synth, "synth_rate"), "column")
    gap = F.col("synth_rate") - F.col("seed_rate")
    return met.withColumn("error", F.abs(gap)).withColumn("severity", F.when(gap > tolerance, F.lit("HIGH")))


def class_mae(seed: DataFrame, synth: DataFrame, target: str) -> DataFrame:
    """n_classes, mae over the union of classes."""
    return frequency_align(seed, synth, [target]).agg(F.count("*").alias("n_classes"), F.avg(F.abs(F.col("seed_p") - F.col("synth_p"))).alias("mae"))


def target_drift(seed: DataFrame, synth: DataFrame, target: str, tolerance: float = 0.03) -> DataFrame:
    """value, seed_p, synth_p, flagged beyond the tolerance."""
    met = frequency_align(seed, synth, [target])
    return met.select("value", "seed_p", "synth_p", (F.abs(F.col("synth_p") - F.col("seed_p")) > tolerance).alias("flagged"))


def category_coverage(seed: DataFrame, synth: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, n_seed, n_covered, coverage, missing (sorted values that the synthetic table lacks)."""
    a = long_values(seed, columns).where("value IS NOT NULL").distinct()
    b = long_values(synth, columns).where("value IS NOT NULL").distinct().withColumn("there", F.lit(True))
    met = a.join(b, ["column", "value"], "left")
    return met.groupBy("column").agg(F.count("*").alias("n_seed"), F.count("there").alias("n_covered"), F.sort_array(F.collect_list(F.when(F.col("there").isNull(), F.col("value")))).alias("missing")).select("column", "n_seed", "n_covered", (F.col("n_covered") / F.col("n_seed")).alias("coverage"), "missing")


def ks_two_sample(seed: DataFrame, synth: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, n_seed, n_synth, ks: the greatest gap of the two distribution functions.

    Counts per value are dealt out by ranges of (column, value); running sums inside a range and offsets of the ranges before it
    give both functions, so no column is sorted in one task.
    """
    flat = lambda df, i: df.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), to_double(F.col(c)).alias("x")) for c in columns))).alias("p")).select("p.*", F.lit(i).alias("side")).where("x IS NOT NULL")
    counts = flat(seed, 0).unionByName(flat(synth, 1)).groupBy("column", "x").agg(F.count_if(F.col("side") == 0).alias("a"), F.count_if(F.col("side") == 1).alias("b"))
    ranged = by_ranges(counts, "column", "x")
    per = ranged.groupBy("column", "_range").agg(F.sum("a").alias("ta"), F.sum("b").alias("tb"))  # columns times ranges
    before, all_ = Window.partitionBy("column").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("column")
    offsets = per.select("column", "_range", *(F.coalesce(F.sum(f"t{k}").over(before), F.lit(0)).alias(f"o{k}") for k in "ab"), *(F.sum(f"t{k}").over(all_).alias(f"n{k}") for k in "ab"))
    run = Window.partitionBy("column", "_range").orderBy("x")
    cum = ranged.select("column", "_range", *(F.sum(k).over(run).alias(f"c{k}") for k in "ab")).join(F.broadcast(offsets), ["column", "_range"])
    gap = F.abs((F.col("oa") + F.col("ca")) / F.col("na") - (F.col("ob") + F.col("cb")) / F.col("nb"))
    return cum.where("na > 0 AND nb > 0").groupBy("column").agg(F.max("na").alias("n_seed"), F.max("nb").alias("n_synth"), F.max(gap).alias("ks"))


def correlation_mae(seed: DataFrame, synth: DataFrame, columns: Sequence[str]) -> DataFrame:
    """n_pairs, mae over the upper triangle."""
    a, b = pearson_pairs(seed, columns), pearson_pairs(synth, columns)
    met = a.select("col_a", "col_b", F.col("r").alias("ra")).join(b.select("col_a", "col_b", F.col("r").alias("rb")), ["col_a", "col_b"])
    return met.where("ra IS NOT NULL AND rb IS NOT NULL").agg(F.count("*").alias("n_pairs"), F.avg(F.abs(F.col("ra") - F.col("rb"))).alias("mae"))


def cramers_drift(seed: DataFrame, synth: DataFrame, pairs: Sequence[tuple[str, str]], medium: float = 0.15, high: float = 0.30) -> DataFrame:
    """col_a, col_b, seed_v, synth_v, drift, severity."""
    a, b = cramers_v(seed, pairs), cramers_v(synth, pairs)
    met = a.select("col_a", "col_b", F.col("v").alias("seed_v")).join(b.select("col_a", "col_b", F.col("v").alias("synth_v")), ["col_a", "col_b"])
    met = met.withColumn("drift", F.abs(F.col("synth_v") - F.col("seed_v")))
    return met.withColumn("severity", F.when(F.col("drift") > high, "HIGH").when(F.col("drift") > medium, "MEDIUM"))


def fidelity_scores(seed: DataFrame, synth: DataFrame, target: str, categorical: Sequence[str], numeric: Sequence[str]) -> DataFrame:
    """metric, value: the five fidelity metrics of one candidate."""
    gaps = null_rate_check(seed, synth, [*categorical, *numeric]).agg(F.avg("error").alias("v"))
    parts = [
        class_mae(seed, synth, target).select(F.lit("class_mae").alias("metric"), F.col("mae").alias("value")),
        ks_two_sample(seed, synth, numeric).agg(F.avg("ks").alias("value")).select(F.lit("mean_ks").alias("metric"), "value"),
        category_coverage(seed, synth, categorical).agg(F.avg("coverage").alias("value")).select(F.lit("coverage").alias("metric"), "value"),
        correlation_mae(seed, synth, numeric).select(F.lit("correlation_mae").alias("metric"), F.col("mae").alias("value")),
        gaps.select(F.lit("missingness_error").alias("metric"), F.col("v").alias("value")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def ab_tally(a: DataFrame, b: DataFrame, higher_wins: Sequence[str] = ("coverage",), tie: float = 1e-4) -> DataFrame:
    """metric, a, b, winner (`a`, `b` or `tie`)."""
    met = a.toDF("metric", "a").join(b.toDF("metric", "b"), "metric")
    better = F.when(F.col("metric").isin(*higher_wins), F.col("a") - F.col("b")).otherwise(F.col("b") - F.col("a"))
    return met.withColumn("winner", F.when(F.abs(better) < tie, "tie").when(better > 0, "a").otherwise("b"))


def schema_diff(seed: DataFrame, synth: DataFrame) -> DataFrame:
    """column, change: missing from or extra in the synthetic table, without a job over the data."""
    rows = [(c, "missing") for c in seed.columns if c not in synth.columns] + [(c, "extra") for c in synth.columns if c not in seed.columns]
    return seed.sparkSession.createDataFrame(rows, "column string, change string")



"""Privacy risk: k-anonymity, linkage, leakage, nearest neighbours, membership inference, attribute disclosure.

Distances need every pair of two sets, so they run on samples of a fixed size (rows in hash order, the same on any
partitioning); the reference side has a size bound and is broadcast, and each row keeps its least distance at once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.coerce import to_double, to_text
from ..functions.rng import hash_order
from .ranges import by_ranges

#: Most rows of a sample that distances are taken to.
SAMPLE = 2000
#: Most rows of a reference that is broadcast.
REFERENCE = 100_000


def sample(df: DataFrame, n: int, key: Sequence[str], seed: int | str = 42) -> DataFrame:
    """n rows in hash order of their key: top-n per partition, then of those."""
    return df.orderBy(*hash_order(seed, *(F.col(k) for k in key))).limit(n)


def disjoint_samples(df: DataFrame, n: int, key: Sequence[str], seed: int | str = 42) -> tuple[DataFrame, DataFrame]:
    """Two samples of up to n rows without a common row: the first 2n in hash order, in turn."""
    order = hash_order(seed, *(F.col(k) for k in key))
    both = df.orderBy(*order).limit(2 * n).withColumn("_at", F.row_number().over(Window.orderBy(*order)))  # 2n rows
    return both.where("_at % 2 = 1").drop("_at"), both.where("_at % 2 = 0").drop("_at")


def group_sizes(df: DataFrame, qi: Sequence[str]) -> DataFrame:
    """The quasi-identifier groups with their sizes; rows with a null in one are left out."""
    return df.na.drop(subset=list(qi)).groupBy(*qi).agg(F.count("*").alias("size"))


def k_anonymity(df: DataFrame, qi: Sequence[str], k: int = 5) -> DataFrame:
    """n_groups, min_size, n_violations, violation_rate, pct_below_5, pct_below_11, severity."""
    one = group_sizes(df, qi).agg(F.count("*").alias("n_groups"), F.min("size").alias("min_size"), F.count_if(F.col("size") < k).alias("n_violations"), F.avg((F.col("size") < k).cast("double")).alias("violation_rate"), F.avg((F.col("size") < 5).cast("double")).alias("pct_below_5"), F.avg((F.col("size") < 11).cast("double")).alias("pct_below_11"))
    r = F.col("violation_rate")
    return one.withColumn("severity", F.when(F.col("n_violations") > 0, F.when(r > 0.20, "CRITICAL").when(r > 0.05, "HIGH").otherwise("MEDIUM")))


def record_linkage(synth: DataFrame, seed: DataFrame, qi: Sequence[str]) -> DataFrame:
    """n, unique_link_rate, no_match_rate, mean_group, pct_small, severity of synthetic rows linked to the seed by quasi-identifiers.

    The seed is one row per group before the join and synthetic rows are counted per group too, so a group that a third
    of all rows are in is one row on either side. Rows with a null in a quasi-identifier match none.
    """
    ours = synth.groupBy(*qi).agg(F.count("*").alias("m"))
    met = ours.join(group_sizes(seed, qi), list(qi), "left")
    share = lambda c: F.sum(F.when(c, F.col("m")).otherwise(0)) / F.sum("m")
    one = met.agg(
        F.sum("m").alias("n"), share(F.col("size") == 1).alias("unique_link_rate"), share(F.col("size").isNull()).alias("no_match_rate"),
        (F.sum(F.col("size") * F.col("m")) / F.sum(F.when(F.col("size").isNotNull(), F.col("m")))).alias("mean_group"), share(F.coalesce(F.col("size") <= 5, F.lit(False))).alias("pct_small"),
    )
    u = F.col("unique_link_rate")
    return one.withColumn("severity", F.when(u > 0.10, "HIGH").when(u > 0.05, "MEDIUM").otherwise("LOW")).withColumn("passed", u <= 0.05)


def _row_key(columns: Sequence[str]) -> Column:
    """Equal for equal rows, with null equal to null only."""
    return F.struct(*(F.col(c).cast("string").alias(f"k{i}") for i, c in enumerate(columns)))


def row_leakage(synth: DataFrame, seed: DataFrame, columns: Sequence[str], threshold: float = 0.01) -> DataFrame:
    """n, n_leaked, rate, severity: synthetic rows that equal a seed row in all shared columns."""
    ours = synth.groupBy(_row_key(columns).alias("k")).agg(F.count("*").alias("m"))
    theirs = seed.select(_row_key(columns).alias("k")).distinct().withColumn("there", F.lit(True))
    one = ours.join(theirs, "k", "left").agg(F.sum("m").alias("n"), F.sum(F.when(F.col("there"), F.col("m")).otherwise(0)).alias("n_leaked"))
    rate = F.col("n_leaked") / F.col("n")
    return one.withColumn("rate", rate).withColumn("severity", F.when(F.col("rate") > 10 * threshold, "CRITICAL").when(F.col("rate") > threshold, "HIGH"))


def diversity(synth: DataFrame, seed: DataFrame, columns: Sequence[str], collapsed: float = 0.05) -> DataFrame:
    """n_rows, n_distinct, n_in_seed, diversity, mode_collapse of distinct synthetic rows."""
    ours = synth.groupBy(_row_key(columns).alias("k")).agg(F.count("*").alias("m"))
    theirs = seed.select(_row_key(columns).alias("k")).distinct().withColumn("there", F.lit(True))
    one = ours.join(theirs, "k", "left").agg(F.sum("m").alias("n_rows"), F.count("*").alias("n_distinct"), F.count("there").alias("n_in_seed"))
    return one.withColumn("diversity", F.col("n_distinct") / F.col("n_rows")).withColumn("mode_collapse", F.col("diversity") < collapsed)


def gower_scale(frames: Sequence[DataFrame], numeric: Sequence[str]) -> DataFrame:
    """One row: median and range (at least 1 where it is 0) of each number over all frames together."""
    both = frames[0].select(*numeric)
    for f in frames[1:]:
        both = both.unionByName(f.select(*numeric))
    aggs = []
    for i, c in enumerate(numeric):
        x = to_double(F.col(c))
        width = F.max(x) - F.min(x)
        aggs += [F.coalesce(F.median(x), F.lit(0.0)).alias(f"mid{i}"), F.when(width > 0, width).otherwise(1.0).alias(f"width{i}")]
    return both.agg(*aggs)


def _sides(df: DataFrame, scale: DataFrame, categorical: Sequence[str], numeric: Sequence[str], prefix: str, keep: Sequence[str] = ()) -> DataFrame:
    wide = df.crossJoin(F.broadcast(scale))  # one row
    cats = [to_text(F.col(c)).alias(f"{prefix}c{i}") for i, c in enumerate(categorical)]
    nums = [(F.coalesce(to_double(F.col(c)), F.col(f"mid{i}")) / F.col(f"width{i}")).alias(f"{prefix}n{i}") for i, c in enumerate(numeric)]
    return wide.select(*(F.col(k).alias(f"{prefix}{k}") for k in keep), *cats, *nums)


def _distance(n_cat: int, n_num: int) -> Column:
    parts = [F.when(F.col(f"q_c{i}") == F.col(f"r_c{i}"), 0.0).otherwise(1.0) for i in range(n_cat)] + [F.abs(F.col(f"q_n{i}") - F.col(f"r_n{i}")) for i in range(n_num)]
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total / F.lit(float(n_cat + n_num))


def gower_nearest(query: DataFrame, ref: DataFrame, categorical: Sequence[str], numeric: Sequence[str], key: Sequence[str], exclude_self: bool = False, scale: DataFrame | None = None) -> DataFrame:
    """The key of each query row and `distance`, the least Gower distance to a reference row; key unique in query.

    ref is a sample of up to REFERENCE rows, which is checked: it is broadcast, and the least distance is kept row by row while it is scanned.
    """
    if ref.limit(REFERENCE + 1).count() > REFERENCE:
        raise ValueError(f"distances are taken to {REFERENCE} rows at most: sample the reference")
    scale = scale if scale is not None else gower_scale([query, ref], numeric)
    q = _sides(query, scale, categorical, numeric, "q_", key)
    r = _sides(ref, scale, categorical, numeric, "r_", key if exclude_self else ())
    # The stated query set against the bounded reference sample.
    pairs = q.crossJoin(F.broadcast(r))
    if exclude_self:
        same = F.lit(True)
        for k in key:
            same = same & F.col(f"q_{k}").eqNullSafe(F.col(f"r_{k}"))
        pairs = pairs.where(~same)
    out = pairs.groupBy(*(f"q_{k}" for k in key)).agg(F.min(_distance(len(categorical), len(numeric))).alias("distance"))
    return out.select(*(F.col(f"q_{k}").alias(k) for k in key), "distance")


def auc(scores: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """One row: auc of label 1 against 0 by rank sums, ties shared, from counts per score dealt out by ranges."""
    per = scores.groupBy(F.col(score).alias("s")).agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) != 1).alias("n"))
    ranged = by_ranges(per, "s")
    inside = Window.partitionBy("_range").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("below", F.coalesce(F.sum("n").over(inside), F.lit(0))).groupBy("_range").agg(F.sum(F.col("p") * (F.col("below") + F.col("n") / 2)).alias("u"), F.sum("p").alias("p"), F.sum("n").alias("n"))
    offset = F.coalesce(F.sum("n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row per range
    return local.withColumn("before", offset).agg(F.try_divide(F.sum(F.col("u") + F.col("p") * F.col("before")), F.sum("p").cast("double") * F.sum("n")).alias("auc"))


def membership_inference(synth: DataFrame, seed: DataFrame, categorical: Sequence[str], numeric: Sequence[str], key: Sequence[str], n: int = SAMPLE, seed_no: int = 42) -> DataFrame:
    """auc, severity, passed: whether distance to the synthetic table tells members from others.

    A logistic model of one distance is monotone, so its AUC is the rank statistic, turned to the side of the means.
    """
    train, holdout = disjoint_samples(seed, n, key, seed_no)
    ref = sample(synth, n, key, seed_no)
    asked = train.withColumn("_member", F.lit(1)).unionByName(holdout.withColumn("_member", F.lit(0)))
    scale = gower_scale([asked, ref], numeric)
    near = gower_nearest(asked, ref, categorical, numeric, [*key, "_member"], scale=scale)
    sums = near.agg(F.avg(F.when(F.col("_member") == 1, F.col("distance"))).alias("m1"), F.avg(F.when(F.col("_member") == 0, F.col("distance"))).alias("m0"))
    raw = auc(near.select(F.round("distance", 9).alias("score"), F.col("_member").alias("label")))
    one = raw.crossJoin(sums).select(F.when(F.col("m1") >= F.col("m0"), F.col("auc")).otherwise(1 - F.col("auc")).alias("auc"))  # one row each
    return one.withColumn("severity", F.when(F.col("auc") > 0.75, "CRITICAL").when(F.col("auc") > 0.60, "HIGH").otherwise("LOW")).withColumn("passed", F.col("auc") <= 0.60)


def closest_records(synth: DataFrame, seed: DataFrame, categorical: Sequence[str], numeric: Sequence[str], key: Sequence[str], n: int = SAMPLE, inner: int = 500, seed_no: int = 42) -> DataFrame:
    """dcr_ratio, mean_synth, mean_holdout, p5, p50, share_below, mean_nndr, severities.

    dcr_ratio: mean distance of synthetic rows to the training sample over that of held-out rows. nndr: a synthetic row's distance to
    training over its distance to its nearest other synthetic row, on `inner` rows.
    """
    train, holdout = disjoint_samples(seed, n, key, seed_no)
    ours = sample(synth, n, key, seed_no)
    scale = gower_scale([ours, train, holdout], numeric)
    a = gower_nearest(ours, train, categorical, numeric, key, scale=scale)
    b = gower_nearest(holdout, train, categorical, numeric, key, scale=scale)
    few = sample(ours, min(inner, n), key, seed_no)
    c = gower_nearest(few, few, categorical, numeric, key, exclude_self=True, scale=scale).withColumnRenamed("distance", "other")
    ratio = a.join(c, list(key)).agg(F.avg(F.col("distance") / F.greatest("other", F.lit(1e-9))).alias("mean_nndr"))
    one = a.agg(F.avg("distance").alias("mean_synth"), F.percentile("distance", F.lit(0.05)).alias("p5"), F.percentile("distance", F.lit(0.5)).alias("p50"), F.avg((F.col("distance") < 0.1).cast("double")).alias("share_below"))
    one = one.crossJoin(b.agg(F.avg("distance").alias("mean_holdout"))).crossJoin(ratio)  # one row each
    one = one.withColumn("dcr_ratio", F.col("mean_synth") / F.greatest("mean_holdout", F.lit(1e-9)))
    return one.withColumn("dcr_severity", F.when(F.col("dcr_ratio") < 0.50, "HIGH").when(F.col("dcr_ratio") < 0.80, "MEDIUM")).withColumn("nndr_severity", F.when(F.col("mean_nndr") < 0.20, F.lit("HIGH")))


def nmi(df: DataFrame, sensitive: str, qi: Sequence[str]) -> DataFrame:
    """One row: nmi, mutual information over the mean of the two entropies (natural logarithm), null as a value."""
    cells = df.groupBy(to_text(F.col(sensitive)).alias("s"), F.concat_ws("-", *(to_text(F.col(c)) for c in qi)).alias("q")).agg(F.count("*").alias("n"))
    total = cells.agg(F.sum("n").alias("t"))
    h = lambda by: cells.groupBy(by).agg(F.sum("n").alias("n")).crossJoin(F.broadcast(total)).agg((-F.sum(F.col("n") / F.col("t") * F.ln(F.col("n") / F.col("t")))).alias(f"h{by}"))
    joint = cells.crossJoin(F.broadcast(total)).agg((-F.sum(F.col("n") / F.col("t") * F.ln(F.col("n") / F.col("t")))).alias("hj"))
    return joint.crossJoin(h("s")).crossJoin(h("q")).select(F.when(F.col("hs") + F.col("hq") > 0, 2 * (F.col("hs") + F.col("hq") - F.col("hj")) / (F.col("hs") + F.col("hq"))).otherwise(1.0).alias("nmi"))  # one row each


def attribute_disclosure(synth: DataFrame, seed: DataFrame, sensitive: str, qi: Sequence[str]) -> DataFrame:
    """synth_nmi, seed_nmi, risk: how much more the synthetic table tells of the attribute than the seed does."""
    one = nmi(synth, sensitive, qi).select(F.col("nmi").alias("synth_nmi")).crossJoin(nmi(seed, sensitive, qi).select(F.col("nmi").alias("seed_nmi")))
    return one.withColumn("risk", F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("synth_nmi") - F.col("seed_nmi")) / F.greatest("seed_nmi", F.lit(0.01))))


def residual_risk(metrics: DataFrame) -> DataFrame:
    """identity, linkage, attribute, overall (the greatest) from 0 to 1 to four digits, and their bands.

    metrics is one row of mia_auc, dcr_ratio, mean_nndr, unique_link_rate, pct_small, mean_group and attribute_risk; a null is no risk.
    """
    floor0 = lambda c: F.greatest(F.lit(0.0), c)
    mia = floor0((F.coalesce("mia_auc", F.lit(0.5)) - 0.5) / 0.5)
    dcr = floor0(1 - F.coalesce("dcr_ratio", F.lit(1.0)) / 0.8)
    nndr = floor0(1 - F.least(F.coalesce("mean_nndr", F.lit(1.0)), F.lit(10.0)) / 0.2)
    group = floor0(1 - F.least(F.coalesce("mean_group", F.lit(1000.0)), F.lit(100.0)) / 100)
    out = metrics.select(
        F.round(0.5 * mia + 0.3 * dcr + 0.2 * nndr, 4).alias("identity"),
        F.round(0.5 * F.coalesce("unique_link_rate", F.lit(0.0)) + 0.3 * F.coalesce("pct_small", F.lit(0.0)) + 0.2 * group, 4).alias("linkage"),
        F.round(F.coalesce("attribute_risk", F.lit(0.0)), 4).alias("attribute"),
    ).withColumn("overall", F.greatest("identity", "linkage", "attribute"))
    for c in ("identity", "linkage", "attribute", "overall"):
        out = out.withColumn(f"{c}_band", F.when(F.col(c) < 0.33, "LOW").when(F.col(c) < 0.66, "MEDIUM").otherwise("HIGH"))
    return out

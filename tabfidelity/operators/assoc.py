"""Association rules: transactions, frequent itemsets, rules with several consequents, pruning, coverage.

A row becomes an array of `<column>_<value or bin>` items by one projection. Itemsets come from Spark's parallel FP-Growth, mined
once at the lowest rung of the support ladder; everything after works on itemsets, whose number the support bounds.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.coerce import right_closed_bin, slug, to_double
from ..functions.text import feature

LADDER = (0.50, 0.45, 0.40, 0.35, 0.30, 0.25, 0.20)


def bin_edges(edges: Sequence[float]) -> list[str]:
    return [f"({a:g}, {b:g}]" for a, b in zip(edges, edges[1:], strict=False)]


def quantile_edges(df: DataFrame, column: str, parts: int) -> list[float]:
    """Linear quantile edges; equal ones are an error, as they leave an empty bin."""
    q = df.agg(F.percentile(to_double(F.col(column)), F.array(*(F.lit(i / parts) for i in range(parts + 1))))).first()[0]
    if q is None or len(set(q)) < len(q):
        raise ValueError(f"{column}: quantile edges are not distinct")
    return list(q)


def items(categorical: Sequence[str] = (), binned: Mapping[str, tuple[Sequence[float], Sequence[str]]] | None = None, quantile: Mapping[str, tuple[Sequence[float], Sequence[str]]] | None = None, flags: Mapping[str, Column] | None = None) -> Column:
    """An array of the row's items; values out of every bin have none. binned is closed above, quantile takes its lowest edge in."""
    made = [feature(c, F.col(c)) for c in categorical]
    for spec, lowest in ((binned or {}, False), (quantile or {}, True)):
        made += [feature(c, right_closed_bin(to_double(F.col(c)), list(e), list(labels), lowest)) for c, (e, labels) in spec.items()]
    made += [F.when(cond, F.lit(name)) for name, cond in (flags or {}).items()]
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*made))))


def stay_bins(stay: str, labs: str, medications: str, zero_flags: Sequence[str] = ()) -> Column:
    """Fixed bins of hospital stays: days up to 2, 5 and over; lab tests under 30, 60 and over; drugs under 12, 22 and over; visits that are zero."""
    three = lambda c, name, a, b: F.when(a, F.lit(f"{name}_low")).when(b, F.lit(f"{name}_medium")).when(c.isNotNull(), F.lit(f"{name}_high"))
    s, lab, m = (to_double(F.col(c)) for c in (stay, labs, medications))
    flags = [F.when(to_double(F.col(c)) == 0, F.lit(f"{c}_zero")) for c in zero_flags]
    return F.array_compact(F.array(three(s, stay, s <= 2, s <= 5), three(lab, labs, lab < 30, lab < 60), three(m, medications, m < 12, m < 22), *flags))


def frequent_itemsets(transactions: DataFrame, min_support: float, column: str = "items", partitions: int | None = None) -> DataFrame:
    """items (sorted), freq, support."""
    from pyspark.ml.fpm import FPGrowth

    n = transactions.count()
    spark = transactions.sparkSession
    if not n:
        return spark.createDataFrame([], "items array<string>, freq long, support double")
    model = FPGrowth(itemsCol=column, minSupport=min_support, minConfidence=1.0, numPartitions=partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))).fit(transactions.select(column))
    return model.freqItemsets.select(F.array_sort("items").alias("items"), "freq", (F.col("freq") / F.lit(n)).alias("support"))


def association_rules(itemsets: DataFrame, min_confidence: float = 0.5, max_size: int = 12) -> DataFrame:
    """antecedents, consequents, support, confidence, lift for every split of each itemset in two non-empty parts.

    An itemset is cut by the bits of a number; each side's support comes by a join with the itemsets, which hold all subsets of frequent ones.
    """
    sets = itemsets.where(F.size("items") >= 2)
    big = sets.agg(F.max(F.size("items"))).first()[0]
    if big and big > max_size:
        raise ValueError(f"itemsets of {big} items have too many splits; raise the support or max_size")
    bit = lambda i: F.substring(F.lpad(F.bin("mask"), 64, "0"), F.lit(64) - i, F.lit(1))
    pick = lambda want: F.filter("items", lambda x, i: bit(i) == F.lit(want))
    cut = sets.select("items", "support", F.explode(F.sequence(F.lit(1).cast("long"), F.expr("shiftleft(1L, size(items)) - 2"))).alias("mask"))
    cut = cut.select("support", pick("1").alias("antecedents"), pick("0").alias("consequents"))
    a = itemsets.select(F.col("items").alias("antecedents"), F.col("support").alias("sa"))
    c = itemsets.select(F.col("items").alias("consequents"), F.col("support").alias("sc"))
    rules = cut.join(a, "antecedents").join(c, "consequents").withColumn("confidence", F.col("support") / F.col("sa"))
    return rules.where(F.col("confidence") >= min_confidence).select("antecedents", "consequents", "support", "confidence", (F.col("confidence") / F.col("sc")).alias("lift"))


def hard_rules(rules: DataFrame, min_support: float = 0.20, min_confidence: float = 0.95) -> DataFrame:
    return rules.where((F.col("support") >= min_support) & (F.col("confidence") >= min_confidence)).orderBy(F.desc("support"), "antecedents", "consequents")


def mine(transactions: DataFrame, ladder: Sequence[float] = LADDER, min_confidence: float = 0.5) -> tuple[float, DataFrame]:
    """The first rung of the ladder with a hard rule, and all rules at its support.

    Itemsets above a rung are a subset of those above a lower one, so one mining at the lowest serves all rungs.
    """
    low = min(ladder)
    rules = association_rules(frequent_itemsets(transactions, low), min_confidence)
    best = hard_rules(rules).agg(F.max("support")).first()[0]
    if best is None:
        raise ValueError("no hard rule at any support of the ladder")
    rung = max(s for s in ladder if s <= best)
    return rung, rules.where(F.col("support") >= rung)


def soft_rules(rules: DataFrame, ceiling: float = 0.95, floor: float = 0.70, max_repeats: int = 3, max_rules: int = 15) -> DataFrame:
    """Rules below the ceiling with one consequent, at most max_repeats a consequent, the best max_rules by lift and support.

    Where none lie between, those at or above the floor are taken whatever the ceiling.
    """
    single = rules.where(F.size("consequents") == 1)
    below = single.where(F.col("confidence") < ceiling)
    chosen = below if not below.isEmpty() else single.where(F.col("confidence") >= floor)
    order = [F.desc("lift"), F.desc("support"), F.col("antecedents"), F.col("consequents")]
    w = Window.partitionBy("consequents").orderBy(*order)
    return chosen.withColumn("at", F.row_number().over(w)).where(F.col("at") <= max(1, max_repeats)).drop("at").orderBy(*order).limit(max_rules)


def narrative_rules(rules: DataFrame, n: int = 10, min_confidence: float = 0.6) -> DataFrame:
    """The n rules with the greatest confidence times lift."""
    return rules.where(F.col("confidence") >= min_confidence).orderBy(F.desc(F.col("confidence") * F.col("lift")), "antecedents", "consequents").limit(n)


def rule_coverage(transactions: DataFrame, rules: DataFrame, column: str = "items") -> DataFrame:
    """rule_id, n_triggered, n_passed, n_failed. rules (rule_id, antecedents, consequents) is a short list.

    Transactions are counted per set of items first, so the test runs once a set, and the list of rules travels as one array.
    """
    sets = transactions.groupBy(F.col(column).alias("s")).agg(F.count("*").alias("m"))
    listed = rules.agg(F.collect_list(F.struct("rule_id", "antecedents", "consequents")).alias("rules"))  # one row
    hit = sets.crossJoin(F.broadcast(listed)).select("m", "s", F.explode("rules").alias("r")).where(F.size(F.array_except("r.antecedents", "s")) == 0)
    ok = F.size(F.array_except("r.consequents", "s")) == 0
    return hit.groupBy(F.col("r.rule_id").alias("rule_id")).agg(F.sum("m").alias("n_triggered"), F.sum(F.when(ok, F.col("m")).otherwise(0)).alias("n_passed"), F.sum(F.when(ok, 0).otherwise(F.col("m"))).alias("n_failed"))


def rows_passed(transactions: DataFrame, rules: DataFrame, column: str = "items") -> DataFrame:
    """n_rows, n_passed, n_failed, pass_rate: a row fails if it breaks any rule that it triggers."""
    sets = transactions.groupBy(F.col(column).alias("s")).agg(F.count("*").alias("m"))
    listed = rules.agg(F.collect_list(F.struct("antecedents", "consequents")).alias("rules"))
    failed = F.exists("rules", lambda r: (F.size(F.array_except(r["antecedents"], F.col("s"))) == 0) & (F.size(F.array_except(r["consequents"], F.col("s"))) > 0))
    one = sets.crossJoin(F.broadcast(listed)).agg(F.sum("m").alias("n_rows"), F.sum(F.when(failed, 0).otherwise(F.col("m"))).alias("n_passed"))
    return one.withColumn("n_failed", F.col("n_rows") - F.col("n_passed")).withColumn("pass_rate", F.col("n_passed") / F.col("n_rows"))


def describe_rules(rules: DataFrame) -> DataFrame:
    """narrative: a sentence per rule."""
    side = lambda c: F.concat_ws(" and ", c)
    return rules.select("*", F.format_string("When %s, then %s in %.0f%% of rows (lift %.2f).", side("antecedents"), side("consequents"), F.col("confidence") * 100, F.col("lift")).alias("narrative"))


def slug_items(c: Column) -> Column:
    return F.transform(c, slug)

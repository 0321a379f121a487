"""URL filters as a sort-merge range join, with DataFrame functions only.

A rule is `host/path`. Its canonical key is the host with its labels reversed, a slash and the path, so everything it
fits at the level of its own host is one interval of keys: those that the key is a prefix of. A url stands in the sweep
once for each suffix of its host that has as many labels as the host of some rule, with the same kind of key; other suffixes fit no rule, so a
broken url with a thousand dots costs no more than another. Rules and urls are range-partitioned and sorted together, in one order, with the row's number as the
last part, so that a host with a third of all urls is cut into as many ranges as its size asks for.

Prefix intervals nest. A sweep that pushes and pops has no form as a DataFrame operation, so what the stack holds once a rule opens is
found before, by a join of the rules with the prefixes of their own keys. Each rule carries that stack, of the rules that enclose it, so the stack at a key is that of the rule
opened last, less those that have closed: the entries that are no longer prefixes of the key. A running `last` inside
each range, and one carried-in stack per range (a table with one row per range), give every url its stack; its top is
the longest rule at that level. The longest rule over the levels of a url wins.

Defined results: a null url or one without `://` has empty host and path; no rule fits it unless it has an empty host.
Repeated rows give repeated results. Of rules with equal strings `block` wins. Null rules are ignored. Other columns of
the input are ignored. With no rules every url gets the default verdict.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, lower_ascii

STACK = "array<struct<key:string,rule:string,verdict:string>>"


def url_host(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    """After the host up to `?`, `#` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _reversed_labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\."))


def _rule_stacks(rules: DataFrame) -> DataFrame:
    """key and stack: the rule and every rule whose key is a proper prefix, outermost first."""
    parts = rules.where("rule IS NOT NULL AND verdict IS NOT NULL").select(
        F.col("rule"), F.col("verdict"), F.split("rule", "/", 2).alias("cut"),
    )
    flat = parts.select("rule", "verdict", lower_ascii(F.col("cut")[0]).alias("host"), F.when(F.size("cut") > 1, F.concat(F.lit("/"), F.col("cut")[1])).otherwise("").alias("path"))
    one = flat.groupBy(F.concat_ws(".", _reversed_labels(F.col("host"))).alias("rev"), "path").agg(F.max_by("rule", "verdict").alias("rule"), F.max("verdict").alias("verdict"))
    keyed = one.select(F.concat("rev", F.lit("/"), "path").alias("key"), F.length("rev").alias("from"), "rule", "verdict")
    # A rule looks for those around it under each prefix of its own key from the end of its host on.
    asks = keyed.select(F.col("key").alias("inner"), F.explode(F.transform(F.sequence(F.col("from") + 1, F.length("key")), lambda i: F.substring(F.col("key"), F.lit(1), i))).alias("key"))
    return asks.join(keyed, "key").groupBy("inner").agg(F.array_sort(F.collect_list(F.struct("key", "rule", "verdict"))).alias("stack")).select(F.col("inner").alias("key"), F.col("stack").cast(STACK))


def filter_urls(pages: DataFrame, rules: DataFrame | Sequence[tuple[str, str]], default: str = "allow", key: str = "page_id", url: str = "url") -> DataFrame:
    """page_id, host, path, rule and verdict for each row of pages.

    rules: (rule, verdict) pairs, or a frame with these columns. rule is null and verdict is `default` where none fits.
    """
    spark: SparkSession = pages.sparkSession
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame([(r, v) for r, v in rules], "rule string, verdict string")
    scratch = Scratch(spark, "url-filter")
    stacks = _rule_stacks(rules)
    parsed = pages.select(F.monotonically_increasing_id().alias("row"), pages[key].alias("page_id"), url_host(pages[url]).alias("host"), url_path(pages[url]).alias("path"))
    labels = _reversed_labels(F.col("host"))
    # How many labels the hosts of rules have: numbers up to 127, as names have no more; a rule with more is compared as well.
    depths = [r[0] for r in rules.where("rule IS NOT NULL AND verdict IS NOT NULL").select(F.size(F.split(F.split("rule", "/")[0], r"\.")).alias("n")).distinct().collect()]
    levels = F.transform(F.filter(F.array(*map(F.lit, sorted(depths) or [1])), lambda n: n <= F.size(labels)), lambda n: F.concat(F.concat_ws(".", F.slice(labels, F.lit(1), n)), F.lit("/"), F.col("path")))
    asked = scratch.table(parsed.select("row", "page_id", "host", "path", F.explode_outer(levels).alias("key")), "asked")  # a url without such a suffix has a null key
    events = asked.select("key", F.lit(1).alias("kind"), "row", "page_id", "host", "path", F.lit(None).cast(STACK).alias("stack")).unionByName(
        stacks.select("key", F.lit(0).alias("kind"), F.lit(-1).cast("long").alias("row"), F.lit(None).cast(asked.schema["page_id"].dataType).alias("page_id"), F.lit("").alias("host"), F.lit("").alias("path"), "stack")
    )
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))  # several to a task, so that tasks come out even
    swept = scratch.table(events.repartitionByRange(ranges, "key", "kind", "row").withColumn("range", F.spark_partition_id()), "swept")
    scratch.drop("asked")

    ends = swept.groupBy("range").agg(F.max_by("stack", F.when(F.col("kind") == 0, F.col("key"))).alias("stack"))
    carried = ends.select("range", F.last("stack", ignorenulls=True).over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)).alias("carried"))
    running = Window.partitionBy("range").orderBy("key", "kind", "row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opened = swept.withColumn("stack", F.last("stack", ignorenulls=True).over(running)).where("kind = 1").join(F.broadcast(carried), "range")
    active = F.filter(F.coalesce("stack", "carried"), lambda r: F.startswith(F.col("key"), r["key"]))
    hits = opened.select("row", "page_id", "host", "path", F.element_at(F.when(F.size(active) > 0, active), -1).alias("top"))
    best = hits.groupBy("row", "page_id", "host", "path").agg(F.max(F.when(F.col("top").isNotNull(), F.struct(F.length("top.rule").alias("n"), F.col("top.verdict").alias("verdict"), F.col("top.rule").alias("rule")))).alias("best"))
    return best.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))

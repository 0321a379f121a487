"""Synthetic rows: strata, a pluggable row source, parsing, pinning, quantile matching, rank correlation.

Rows carry `row_id` from the first step to the last; nothing depends on arrival or partition order. Draws are hashed
uniforms looked up in cumulative shares, a small table. Global ranks come from ranges of values with offsets, never
from one sorted task.
"""

from __future__ import annotations

import json
import os
import time
import urllib.request
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.coerce import is_missing, to_double, to_text
from ..functions.rng import normal, uniform
from ..functions.text import parse_rows
from .ranges import by_ranges, ensure_checkpoint_dir

MISSING = ""


def normalise_counts(df: DataFrame, count: str, by: Sequence[str]) -> DataFrame:
    """df with `p`: counts over their group's total; a group of zeros keeps its counts."""
    total = F.sum(count).over(Window.partitionBy(*by)) if by else F.sum(count).over(Window.partitionBy(F.lit(0)))
    return df.withColumn("p", F.when(total > 0, F.col(count) / total).otherwise(F.col(count).cast("double")))


def conditional_distributions(seed: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    """column, target, value, n, p (among values that are there), missing_rate: P(value | target) of every column in one scan.

    A missing cell is null or blank; it has a row with a null value, n its count and p null.
    """
    cells = F.array(*(F.struct(F.lit(c).alias("column"), F.when(~is_missing(F.col(c)), F.trim(F.col(c).cast("string"))).alias("value")) for c in columns))
    n = seed.where(F.col(target).isNotNull()).select(F.col(target).cast("string").alias("target"), F.explode(cells).alias("c")).select("target", "c.*").groupBy("column", "target", "value").agg(F.count("*").alias("n"))
    totals = n.groupBy("column", "target").agg(F.sum("n").alias("t"), F.sum(F.when(F.col("value").isNotNull(), F.col("n"))).alias("there"))
    met = n.join(F.broadcast(totals), ["column", "target"])
    return met.select("column", "target", "value", "n", F.when(F.col("value").isNotNull(), F.col("n") / F.col("there")).alias("p"), (1 - F.coalesce("there", F.lit(0)) / F.col("t")).alias("missing_rate"))


def _cumulative(p: DataFrame, by: Sequence[str]) -> DataFrame:
    """Arrays of values and cumulative shares per group, in order of value: a row per group."""
    listed = p.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("value", "p"))).alias("v")) if by else p.agg(F.array_sort(F.collect_list(F.struct("value", "p"))).alias("v"))
    cum = F.transform(F.sequence(F.lit(1), F.size("v")), lambda i: F.aggregate(F.slice(F.col("v.p"), F.lit(1), i), F.lit(0.0), lambda a, x: a + x))
    return listed.select(*by, F.col("v.value").alias("values"), cum.alias("cum"))


def draw(u: Column, values: Column, cum: Column) -> Column:
    """The first value whose cumulative share is above u; the last where rounding leaves none."""
    return F.element_at(values, F.least(F.size(F.filter(cum, lambda c: c <= u)) + 1, F.size(values)))


def sample_strata(seed: DataFrame, n: int, target: str, columns: Sequence[str], seed_no: int | str = 42, first_row: int = 0) -> DataFrame:
    """row_id, target and columns of n strata: the target by its marginal, the others given the target, blank where missing."""
    spark = seed.sparkSession
    marginal = seed.where(F.col(target).isNotNull()).groupBy(F.col(target).cast("string").alias("value")).agg(F.count("*").alias("n"))
    marginal = marginal.crossJoin(F.broadcast(marginal.agg(F.sum("n").alias("t")))).select("value", (F.col("n") / F.col("t")).alias("p"))
    rows = spark.range(first_row, first_row + n).withColumnRenamed("id", "row_id").crossJoin(F.broadcast(_cumulative(marginal, [])))  # one row of classes
    rows = rows.select("row_id", draw(uniform(seed_no, F.lit(target), F.col("row_id")), F.col("values"), F.col("cum")).alias(target))
    cond = conditional_distributions(seed, target, columns)
    rates = cond.groupBy("column", "target").agg(F.max("missing_rate").alias("missing_rate"))
    table = _cumulative(cond.where("value IS NOT NULL"), ["column", "target"]).join(rates, ["column", "target"], "full_outer")
    wide = table.groupBy("target").agg(F.map_from_entries(F.collect_list(F.struct("column", F.struct("values", "cum", "missing_rate")))).alias("m"))  # a row per class
    rows = rows.join(F.broadcast(wide), F.col(target) == F.col("target") if target != "target" else "target", "left")
    out = []
    for c in columns:
        cell = F.element_at("m", F.lit(c))
        gone = uniform(seed_no, F.lit(f"{c}?"), F.col("row_id")) < F.coalesce(cell["missing_rate"], F.lit(0.0))
        out.append(F.when(gone | cell["values"].isNull(), F.lit(MISSING)).otherwise(draw(uniform(seed_no, F.lit(c), F.col("row_id")), cell["values"], cell["cum"])).alias(c))
    return rows.select("row_id", target, *out)


def strata_summary(strata: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, value, proportion (4 digits); blank is `<missing>`."""
    cells = F.array(*(F.struct(F.lit(c).alias("column"), F.when(is_missing(F.col(c)), F.lit("<missing>")).otherwise(F.col(c).cast("string")).alias("value")) for c in columns))
    n = strata.select(F.explode(cells).alias("c")).select("c.*").groupBy("column", "value").agg(F.count("*").alias("n"))
    return n.join(F.broadcast(n.groupBy("column").agg(F.sum("n").alias("t"))), "column").select("column", "value", F.round(F.col("n") / F.col("t"), 4).alias("proportion"))


def plan_batches(rows: DataFrame, size: int, row_id: str = "row_id") -> DataFrame:
    """rows with batch_id and pos, the place in the batch from 0."""
    return rows.withColumn("batch_id", F.floor(F.col(row_id) / size).cast("long")).withColumn("pos", F.pmod(F.col(row_id), F.lit(size)).cast("long"))


def truncate_batches(rows: DataFrame, size: int, order: str = "row_id") -> DataFrame:
    """The first `size` rows of each batch."""
    w = Window.partitionBy("batch_id").orderBy(order)
    return rows.withColumn("_at", F.row_number().over(w)).where(F.col("_at") <= size).drop("_at")


def pin_strata(rows: DataFrame, strata: DataFrame, columns: Sequence[str], on: Sequence[str] = ("row_id",)) -> DataFrame:
    """rows with the strata's values in place of their own; rows without a stratum, and columns that rows lack, stay as they are."""
    live = [c for c in columns if c in rows.columns and c in strata.columns]
    s = strata.select(*on, F.lit(True).alias("_pinned"), *(F.col(c).alias(f"_s_{c}") for c in live))
    out = rows.join(s, list(on), "left")
    return out.withColumns({c: F.when(F.col("_pinned"), F.col(f"_s_{c}")).otherwise(F.col(c)) for c in live}).drop("_pinned", *(f"_s_{c}" for c in live))


def strata_drift(rows: DataFrame, strata: DataFrame, columns: Sequence[str], on: Sequence[str] = ("row_id",)) -> DataFrame:
    """column, n, n_differ before pinning."""
    s = strata.select(*on, *(F.col(c).alias(f"_s_{c}") for c in columns))
    met = rows.join(s, list(on))
    one = met.agg(F.count("*").alias("n"), *(F.count_if(to_text(F.col(c)) != to_text(F.col(f"_s_{c}"))).alias(f"d{i}") for i, c in enumerate(columns)))
    return one.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col("n"), F.col(f"d{i}").alias("n_differ")) for i, c in enumerate(columns)))).alias("r")).select("r.*")


def batch_checks(rows: DataFrame, plan: DataFrame, target: str, classes: Sequence[tuple[str, float]], min_yield: float = 0.8) -> DataFrame:
    """batch_id, want, got, short, and `low_<i>` for each (class, least share): what a batch is sent back for."""
    want = plan.groupBy("batch_id").agg(F.count("*").alias("want"))
    got = rows.groupBy("batch_id").agg(F.count("*").alias("got"), *(F.avg((F.col(target) == v).cast("double")).alias(f"s{i}") for i, (v, _) in enumerate(classes)))
    met = want.join(got, "batch_id", "left").na.fill(0, ["got"])
    return met.select("batch_id", "want", "got", (F.col("got") < F.col("want") * min_yield).alias("short"), *(F.coalesce(F.col(f"s{i}") < least, F.lit(True)).alias(f"low_{i}") for i, (_, least) in enumerate(classes)))


# -- row sources ---------------------------------------------------------------------------------------------

Completion = Callable[[str, str], str]


@dataclass(frozen=True)
class Endpoint:
    """A text source behind a chat-completions service, as a Completion that can be sent to executors.

    The key is read from the environment where a request is made, so it travels in no plan. kind: `chat` for services that take the
    system text as a message, `messages` for those that take it apart.
    """

    url: str
    model: str
    key_variable: str = "TABFIDELITY_API_KEY"
    kind: str = "chat"
    temperature: float = 0.7
    max_tokens: int = 4096
    timeout: float = 120.0

    def body(self, system: str, user: str) -> dict[str, Any]:
        common = {"model": self.model, "temperature": self.temperature, "max_tokens": self.max_tokens}
        if self.kind == "messages":
            return common | {"system": system, "messages": [{"role": "user", "content": user}]}
        return common | {"messages": [{"role": "system", "content": system}, {"role": "user", "content": user}]}

    def text_of(self, answer: Mapping[str, Any]) -> str:
        if self.kind == "messages":
            return "".join(part.get("text", "") for part in answer["content"])
        return answer["choices"][0]["message"]["content"] or ""

    def __call__(self, system: str, user: str) -> str:
        key = os.environ.get(self.key_variable, "")
        headers = {"content-type": "application/json"} | ({"x-api-key": key} if self.kind == "messages" else {"authorization": f"Bearer {key}"})
        request = urllib.request.Request(self.url, json.dumps(self.body(system, user)).encode(), headers)
        with urllib.request.urlopen(request, timeout=self.timeout) as answer:
            return self.text_of(json.load(answer))


def with_back_off(complete: Completion, system: str, user: str, tries: int = 3, first_wait: float = 2.0, sleep: Callable[[float], None] = time.sleep) -> str:
    """complete(system, user), called again after an error with waits that double; the last error is raised."""
    for i in range(tries):
        try:
            return complete(system, user)
        except Exception:
            if i + 1 == tries:
                raise
            sleep(first_wait * 2**i)
    raise ValueError("tries must be at least 1")


def request_rows(strata: DataFrame, complete: Completion, system: str, message: Callable[[pd.DataFrame], str], batch: int = 50, max_retries: int = 3, min_yield: float = 0.8, first_wait: float = 2.0) -> DataFrame:
    """row_id, batch_id, line, tries, error: one request per batch of strata, whose lines answer to row ids in order.

    A request is made again while it yields too few lines, and after an error with waits that double. Rows still missing then have a null
    line; error is the batch's last one, or that its yield was short, and null where all is well. No stratum is lost or shifted, and no error
    of one batch ends the others.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), batch):
                part = frame.iloc[at : at + batch]
                best, error, tries = [], None, 0
                while tries < max_retries and len(best) < min_yield * len(part):
                    if error and tries:
                        time.sleep(first_wait * 2 ** (tries - 1))
                    tries += 1
                    try:
                        best = max(best, [x for x in complete(system, message(part)).splitlines() if x.strip()], key=len)
                        error = None
                    except Exception as e:  # noqa: BLE001  whatever a text source raises is reported with the batch
                        error = f"{type(e).__name__}: {e}"
                best = best[: len(part)]
                if error is None and len(best) < min_yield * len(part):
                    error = f"{len(best)} of {len(part)} rows"
                yield pd.DataFrame({"row_id": part["row_id"].to_numpy(), "batch_id": int(part["row_id"].iloc[0]) // batch, "line": best + [None] * (len(part) - len(best)), "tries": tries, "error": error})

    return strata.repartitionByRange("row_id").sortWithinPartitions("row_id").mapInPandas(run, "row_id long, batch_id long, line string, tries int, error string")


def failures(asked: DataFrame) -> DataFrame:
    """batch_id, n, n_missing, tries, error of the batches that have an error."""
    return asked.where("error IS NOT NULL").groupBy("batch_id").agg(F.count("*").alias("n"), F.count_if(F.col("line").isNull()).alias("n_missing"), F.max("tries").alias("tries"), F.max("error").alias("error"))


def generate(strata: DataFrame, columns: Sequence[str], complete: Completion, system: str, message: Callable[[pd.DataFrame], str], batch: int = 50, max_retries: int = 3, min_yield: float = 0.8, progress: Callable[[int, int, int], None] | None = None) -> DataFrame:
    """row_id and `cells` of generated rows; rows that no batch yielded have null cells, so a later pass can ask for just these.

    Answers are checkpointed, as a service gives others when asked again. progress(rows asked for, rows there, batches with an error) is
    called once they are all there.
    """
    names = list(columns)
    ensure_checkpoint_dir(strata.sparkSession)
    asked = request_rows(strata, complete, system, message, batch, max_retries, min_yield).checkpoint()
    if progress:
        n = asked.agg(F.count("*").alias("n"), F.count("line").alias("there"), F.countDistinct(F.when(F.col("error").isNotNull(), F.col("batch_id"))).alias("failed")).first()
        progress(n["n"], n["there"], n["failed"])
    parsed = parse_rows(asked.where("line IS NOT NULL").select("row_id", "line"), names)
    return asked.select("row_id").join(parsed.select("row_id", "cells"), "row_id", "left")


def cells_to_columns(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    return rows.select("row_id", *(F.get("cells", F.lit(i)).alias(c) for i, c in enumerate(columns)))


def offline_rows(strata: DataFrame, seed: DataFrame, numeric: Sequence[str], seed_no: int | str = 42) -> DataFrame:
    """strata with numeric columns drawn from the seed's quantiles: the row source that needs no service. A bounded table of 101 quantiles a column."""
    qs = seed.agg(*(F.percentile_approx(to_double(F.col(c)), [i / 100 for i in range(101)], 10_000).alias(f"_q_{c}") for c in numeric))
    wide = strata.crossJoin(F.broadcast(qs))  # one row
    return wide.select(*strata.columns, *(F.element_at(F.col(f"_q_{c}"), F.floor(uniform(seed_no, F.lit(c), F.col("row_id")) * 101).cast("int") + 1).cast("string").alias(c) for c in numeric))


# -- matching to the seed ------------------------------------------------------------------------------------


def global_rank(df: DataFrame, value: str, key: Sequence[str], by: Sequence[str] = (), name: str = "rank") -> DataFrame:
    """df with the 0-based rank by (value, key) inside each group: ranks inside ranges plus the rows of the ranges before."""
    ranged = by_ranges(df, *by, value, *key)
    inside = F.row_number().over(Window.partitionBy(*by, "_range").orderBy(value, *key)) - 1
    sizes = ranged.groupBy(*by, "_range").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) if by else F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.withColumn("_before", before).drop("_n")
    met = ranged.withColumn("_in", inside).join(F.broadcast(offsets), [*by, "_range"])
    return met.withColumn(name, (F.col("_before") + F.col("_in")).cast("long")).drop("_range", "_in", "_before")


def quantile_match(rows: DataFrame, seed: DataFrame, column: str, key: Sequence[str] = ("row_id",), seed_key: Sequence[str] = (), zero_share: float = 0.5) -> DataFrame:
    """key and `matched`: each number replaced by the seed's value at the same quantile; cells that are no number are left out.

    A column whose seed is zero at least zero_share of the time keeps that share of zeros at its lowest ranks; the rest map to positive
    seed values up to their 99th percentile, cut to whole numbers.
    """
    x = rows.select(*key, to_double(F.col(column)).alias("x")).where("x IS NOT NULL")
    s = seed.select(to_double(F.col(column)).alias("v"), *seed_key).where("v IS NOT NULL")
    # Equal seed values are interchangeable, so ranks of the seed are ranges over counts per value.
    stats = s.agg(F.count("*").alias("m"), F.avg((F.col("v") == 0).cast("double")).alias("z"), F.count_if(F.col("v") > 0).alias("mp")).first()
    n = x.count()
    ranked = global_rank(x, "x", key)
    r = F.col("rank")
    if not stats["m"]:
        return ranked.select(*key, F.col("x").alias("matched"))
    inflated = (stats["z"] or 0.0) >= zero_share and stats["mp"] > 0
    if inflated:
        cut, p99 = int(np.rint(stats["z"] * n)), int(np.rint(0.99 * (stats["mp"] - 1)))
        q = (r - cut) / F.lit(float(max(max(n - cut, 1) - 1, 1)))
        ranked = ranked.withColumn("at", F.when(r >= cut, F.least(F.greatest(F.rint(q * p99), F.lit(0.0)), F.lit(float(p99))).cast("long")))
        pool = s.where("v > 0")
    else:
        m = stats["m"]
        ranked = ranked.withColumn("at", F.least(F.greatest(F.rint(r / F.lit(float(max(n - 1, 1))) * (m - 1)), F.lit(0.0)), F.lit(float(m - 1))).cast("long"))
        pool = s
    counts = pool.groupBy("v").agg(F.count("*").alias("c"))
    ranged = by_ranges(counts, "v")
    inside = F.coalesce(F.sum("c").over(Window.partitionBy("_range").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    off = ranged.groupBy("_range").agg(F.sum("c").alias("t")).withColumn("o", F.coalesce(F.sum("t").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("t")
    table = ranged.withColumn("i", inside).join(F.broadcast(off), "_range").select("v", (F.col("o") + F.col("i")).cast("long").alias("lo"), F.col("c"))
    # One seed row per rank that is asked for: distinct ranks meet the value whose run of ranks holds them, by blocks of ranks.
    block = 4096
    asked = ranked.where("at IS NOT NULL").select("at").distinct().withColumn("b", F.floor(F.col("at") / block))
    spans = table.withColumn("b", F.explode(F.sequence(F.floor(F.col("lo") / block), F.floor((F.col("lo") + F.col("c") - 1) / block))))
    found = asked.join(spans, "b").where((F.col("at") >= F.col("lo")) & (F.col("at") < F.col("lo") + F.col("c"))).select("at", "v")
    out = ranked.join(found, "at", "left")
    value = F.when(F.col("at").isNull(), F.lit(0.0)).otherwise(F.floor("v") if inflated else F.col("v"))
    return out.select(*key, value.cast("double").alias("matched"))


def iman_conover(rows: DataFrame, columns: Sequence[str], corr: np.ndarray, key: Sequence[str] = ("row_id",), by: Sequence[str] = (), seed_no: int | str = 42) -> DataFrame:
    """rows with the columns' values rearranged, inside each group, to the given rank correlation; marginals stay exactly.

    A matrix of k x k numbers is made positive on the driver; each row has hashed normals times its root; ranks of values and of
    normals meet per column.
    """
    values, vectors = np.linalg.eigh((corr + corr.T) / 2)
    fixed = (vectors * np.maximum(values, 1e-8)) @ vectors.T
    d = np.sqrt(np.diag(fixed))
    root = np.linalg.cholesky(fixed / np.outer(d, d) + 1e-12 * np.eye(len(d)))
    z = [normal(f"{seed_no}-{c}", *(F.col(k) for k in key)) for c in columns]
    scored = rows.withColumns({f"_y_{c}": sum((z[j] * float(root[i, j]) for j in range(1, i + 1)), z[0] * float(root[i, 0])) for i, c in enumerate(columns)})
    out = scored
    for c in columns:
        place = global_rank(scored.select(*key, *by, F.col(f"_y_{c}").alias("_y")), "_y", key, by, "_r").select(*key, *by, "_r")
        pool = global_rank(scored.select(*key, *by, to_double(F.col(c)).alias("_v")), "_v", key, by, "_r").select(*by, "_r", F.col("_v").alias(f"_new_{c}"))
        out = out.join(place.join(pool, [*by, "_r"]).select(*key, f"_new_{c}"), list(key))
    return out.withColumns({c: F.col(f"_new_{c}") for c in columns}).drop(*(f"_y_{c}" for c in columns), *(f"_new_{c}" for c in columns))


def repair(rows: DataFrame, strata: DataFrame, seed: DataFrame, categorical: Sequence[str], numeric: Sequence[str], corr: np.ndarray | None = None, target: str | None = None) -> DataFrame:
    """Pinned strata, then matched quantiles, then rank correlation inside each target class."""
    out = pin_strata(rows, strata, categorical)
    for c in numeric:
        out = out.join(quantile_match(out, seed, c), "row_id", "left").withColumn(c, F.coalesce("matched", to_double(F.col(c)))).drop("matched")
    return out if corr is None else iman_conover(out, numeric, corr, by=[target] if target else ())


def synthesise(spark: SparkSession, seed: DataFrame, n: int, target: str, categorical: Sequence[str], numeric: Sequence[str], corr: np.ndarray | None = None, seed_no: int | str = 42) -> DataFrame:
    """n offline rows: strata, numbers from quantiles, matching, correlation."""
    others = [c for c in categorical if c != target]
    strata = sample_strata(seed, n, target, others, seed_no)
    return repair(offline_rows(strata, seed, numeric, seed_no), strata, seed, [target, *others], numeric, corr, target)

"""PSI of arriving batches: bin counts are the state, and they add up, so each batch costs one pass over its own rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.drift import FLOOR, psi_status, value_shares
from ..operators.profile import long_values


def count_values(batch: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, value, n of a batch, null as `nan`."""
    return long_values(batch, columns).withColumn("value", F.coalesce("value", F.lit("nan"))).groupBy("column", "value").agg(F.count("*").alias("n"))


def psi_of_counts(seed: DataFrame, counts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, n, psi, status of accumulated counts against the seed's shares."""
    e = value_shares(seed, columns).select("column", "value", F.col("p").alias("e"))
    n = counts.groupBy("column", "value").agg(F.sum("n").alias("n"))
    t = n.groupBy("column").agg(F.sum("n").alias("t"))
    met = e.join(n.join(F.broadcast(t), "column").select("column", "value", (F.col("n") / F.col("t")).alias("a")), ["column", "value"], "full_outer")
    a, x = F.greatest(F.coalesce("a", F.lit(0.0)), F.lit(FLOOR)), F.greatest(F.coalesce("e", F.lit(0.0)), F.lit(FLOOR))
    psi = met.groupBy("column").agg(F.sum((a - x) * F.ln(a / x)).alias("psi"))
    return psi.join(t.withColumnRenamed("t", "n"), "column").select("column", "n", "psi", psi_status(F.col("psi")).alias("status"))


def monitor(stream: DataFrame, seed: DataFrame, columns: Sequence[str], state_path: str, checkpoint: str, report: Callable[[DataFrame, int], None] | None = None):
    """A started query that adds each micro-batch's counts to state_path, under its number, and hands the PSI so far to report.

    A batch that runs again after a failure writes its own number again, so nothing is counted twice.
    """
    spark: SparkSession = stream.sparkSession

    def add(batch: DataFrame, number: int) -> None:
        count_values(batch, columns).write.mode("overwrite").parquet(f"{state_path}/batch={number}")
        if report:
            counts = spark.read.schema("column string, value string, n long, batch long").parquet(state_path)
            report(psi_of_counts(seed, counts.where(F.col("batch") <= number), columns), number)

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, time: str, column: str, window: str = "1 hour", late: str = "30 minutes") -> DataFrame:
    """Counts per value and event-time window; rows later than the watermark are dropped by the engine."""
    return stream.withWatermark(time, late).groupBy(F.window(time, window), F.col(column).cast("string").alias("value")).agg(F.count("*").alias("n"))

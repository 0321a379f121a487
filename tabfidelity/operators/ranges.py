"""Order without one sorted task: rows dealt out by ranges of their sort key, each knowing its range.

Ranges are sampled, so the dealt rows are checkpointed: everything that reads them, sums of ranges and rows alike, sees the same
ranges, also after an executor is lost. The folder is the cluster's spark.checkpoint.dir; a local one is made only where none is set.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    shared = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="tabfidelity-checkpoint-"))


def by_ranges(df: DataFrame, *columns: str) -> DataFrame:
    """df with `_range`, from 0, ascending in the columns' order."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    return df.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *columns).withColumn("_range", F.spark_partition_id()).checkpoint()

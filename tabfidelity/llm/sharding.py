"""Contiguous, byte-balanced shards by global prefix sums.

Rows are range-partitioned by the ordering key (narrow rows only: key, size, checksum), each partition sums its own
sizes, an exclusive prefix sum over the per-partition totals (one row per partition) gives each partition its global
offset, and the cuts fall at equal byte targets. No task ever sees more than one range partition.

Defined results: null text has size 1 and the checksum of no bytes; null keys come first; rows that tie on the key are
ordered by size and checksum; an empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

THIN = "doc_id long, size long, text_crc32 long"


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the place and the byte prefix inside this partition, which arrives sorted."""
    part, rank, before = TaskContext.get().partitionId(), 0, 0
    for b in batches:
        n = b.num_rows
        sizes = b.column("size").to_numpy(zero_copy_only=False).astype(np.int64)
        ends = before + np.cumsum(sizes)
        yield pa.RecordBatch.from_arrays(
            [*b.columns, pa.array(np.full(n, part, np.int32)), pa.array(np.arange(rank, rank + n, dtype=np.int64)), pa.array(ends - sizes)],
            names=[*b.schema.names, "slice", "rank", "prefix"],
        )
        if n:
            rank, before = rank + n, int(ends[-1])


def shard_by_bytes(docs: DataFrame, n_shards: int = 8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard for each row of docs.

    size is the text's UTF-8 bytes plus 1. shard = floor(prefix * n_shards / total), so shards are contiguous in key
    order and differ from the equal target by at most one document. slot counts from 0 inside each shard in key order.
    grown_shard is null: the law is `bytes`, under which another shard moves every cut.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")
    scratch = Scratch(docs.sparkSession, "sharding")
    body = F.coalesce(docs[text].cast("string"), F.lit(""))
    thin = docs.select(docs[key].cast("long").alias("doc_id"), (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"))
    thin = scratch.table(thin, "thin")  # the range sampler and the shuffle read these few bytes a row, not the texts
    order = ["doc_id", "size", "text_crc32"]
    placed = scratch.table(thin.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_running, f"{THIN}, slice int, rank long, prefix long"), "placed")
    scratch.drop("thin")

    totals = placed.groupBy("slice").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    earlier = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition of `placed`
    everything = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select("slice", F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("byte_offset"), F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("row_offset"), F.sum("bytes").over(everything).alias("total"))

    # An exact quotient of whole numbers: a product of bytes and shards may be wider than a long.
    located = placed.join(F.broadcast(offsets), "slice").withColumn("before", F.col("byte_offset") + F.col("prefix")).select(
        "doc_id", "size", "text_crc32",
        F.expr(f"CAST((CAST(before AS DECIMAL(28,0)) * {n_shards}) div CAST(total AS DECIMAL(28,0)) AS INT)").alias("shard"),
        (F.col("row_offset") + F.col("rank")).alias("place"),
    )
    firsts = located.groupBy("shard").agg(F.min("place").alias("first"))  # n_shards rows
    return located.join(F.broadcast(firsts), "shard").select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("place") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))

"""Exact deduplication with keyed streaming state, with DataFrame functions only.

Rows arrive on a stream as (digest, identifier, content locator). The state, in RocksDB on the executors' disks and
in the shared folder's checkpoint, has no expiry: one entry per digest with the largest identifier seen, its locator and
the number of rows. Each micro-batch sums its own rows per digest before the shuffle, so a text that fills a third of
the input is a few rows there. A digest that several rows have is a hit; the full bytes of every hit are compared, and
rows whose bytes differ under one digest are grouped again by digest and bytes.

Texts are equal when identical after lower-casing A-Z only; null counts as empty. Of equal texts the row with the
largest identifier stays (a null identifier is smaller than any other); of rows that repeat an identifier too, the one
with the largest locator stays, so one row of each group stays always. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, lower_ascii, maybe_broadcast

STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # a store per partition: each would set megabytes aside
    "spark.sql.streaming.metricsEnabled": "false",
}


def sha256_of(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def dedup_stream(arrivals: DataFrame, state_dir: str, groups_dir: str) -> None:
    """Run a stream of (digest binary, doc_id, locator) to the end of what is there, from the state kept in state_dir.

    Each micro-batch writes the entries that it changed to groups_dir/batch=N; the entry of the largest N holds.
    A later call with the same folders goes on from the state, so rows that have arrived since are judged against all
    that came before.
    """
    spark = arrivals.sparkSession
    kept = {k: spark.conf.get(k, None) for k in STATE_CONF}
    state = arrivals.groupBy("digest").agg(F.max(F.struct("doc_id", "locator")).alias("keeper"), F.count("*").alias("group_size"))

    def changed(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{groups_dir}/batch={number}")

    try:
        for k, v in STATE_CONF.items():
            spark.conf.set(k, v)
        query = state.writeStream.outputMode("update").option("checkpointLocation", state_dir).trigger(availableNow=True).foreachBatch(changed).start()
        query.awaitTermination()
    finally:
        for k, v in kept.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def latest_groups(spark: SparkSession, groups_dir: str) -> DataFrame:
    """digest, keeper and group_size as of the last micro-batch."""
    schema = "digest binary, keeper struct<doc_id:bigint,locator:struct<part:bigint,row:bigint>>, group_size bigint, batch bigint"
    return spark.read.schema(schema).parquet(groups_dir).groupBy("digest").agg(F.max_by(F.struct("keeper", "group_size"), "batch").alias("g")).select("digest", "g.keeper", "g.group_size")


def exact_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", digest_bits: int = 256, batches: int = 3) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 for each row of docs, and its locator.

    The arrivals come in so many micro-batches, each judged against the state that those before it left; dedup_stream, which this
    calls, goes on from a state of earlier calls too. digest_bits under 256 makes digests collide, for tests.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "exact-dedup")
    body = lower_ascii(docs[text])
    sha = sha256_of(body)
    row = F.monotonically_increasing_id()
    spot = F.struct(F.shiftright(row, 33).alias("part"), row.bitwiseAND(F.lit((1 << 33) - 1)).alias("row")).alias("locator")
    # The content locator: partition and row of the arrival, fixed from here on, as the arrivals are written.
    arrivals = scratch.table(docs.select(docs[key].cast("long").alias("doc_id"), spot, F.unhex(F.substring(sha, 1, max(2, digest_bits // 4))).alias("digest"), sha.alias("text_sha256")), "arrivals")

    files = sum(1 for f in scratch.files("arrivals") if f.endswith(".parquet"))
    stream = spark.readStream.schema(arrivals.schema).option("maxFilesPerTrigger", max(1, -(-files // batches)))
    dedup_stream(stream.parquet(scratch.path("arrivals")).select("digest", "doc_id", "locator"), scratch.path("state"), scratch.path("groups"))
    groups = scratch.table(latest_groups(spark, scratch.path("groups")), "latest") if scratch._fs.exists(spark._jvm.org.apache.hadoop.fs.Path(scratch.path("groups"))) else arrivals.select("digest", F.struct("doc_id", "locator").alias("keeper"), F.lit(0).cast("long").alias("group_size"))
    scratch.drop("state", "groups")

    # Full bytes of every hit. Least and greatest text of a digest are equal exactly if all its texts are.
    hits = groups.where("group_size > 1").select("digest")
    probe = docs.select(F.unhex(F.substring(sha, 1, max(2, digest_bits // 4))).alias("digest"), body.alias("body"))
    span = probe.join(maybe_broadcast(hits, hits.count(), 200_000), "digest", "left_semi").groupBy("digest").agg(F.min("body").alias("least"), F.max("body").alias("greatest"))
    clashes = scratch.table(span.where("least <> greatest").select("digest"), "clashes")

    plain = arrivals.join(groups, "digest").select("doc_id", "locator", "digest", "text_sha256", F.col("keeper.doc_id").alias("keep_id"), (F.col("keeper.locator") == F.col("locator")).alias("kept"), "group_size")
    if clashes.isEmpty():
        return plain.drop("digest")
    # Different bytes under one digest: these rows are grouped by digest and bytes, and the rest stands.
    spread = docs.select(docs[key].cast("long").alias("doc_id"), spot, F.unhex(F.substring(sha, 1, max(2, digest_bits // 4))).alias("digest"), sha.alias("text_sha256"), body.alias("body")).join(clashes, "digest", "left_semi")
    true_groups = spread.groupBy("digest", "body").agg(F.max(F.struct("doc_id", "locator")).alias("keeper"), F.count("*").alias("group_size"))
    apart = spread.join(true_groups, ["digest", "body"]).select("doc_id", "locator", "digest", "text_sha256", F.col("keeper.doc_id").alias("keep_id"), (F.col("keeper.locator") == F.col("locator")).alias("kept"), "group_size")
    return plain.join(clashes, "digest", "left_anti").unionByName(apart).drop("digest")

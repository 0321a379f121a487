"""A training corpus from raw documents in five stages, each written as Parquet and read again by the next.

quality classifier, exact dedup, MinHash near-dedup, substring dedup, best-fit packing.

Stages decide by row, not by identifier alone: rows may share an identifier or have none. A stage's working tables go once its decisions
are written; what its result still reads (identifiers that go, places of repeated runs, lengths of pieces) is narrow and goes when the application ends.
An empty table gives no rows in any stage. Extra columns come through unchanged, whatever their names, up to the last stage, whose rows are pieces.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabfidelity.llm import exact_dedup, minhash, packing, quality, substring_dedup, tokens
from tabfidelity.llm.common import Scratch, free_name, lower_ascii, maybe_broadcast, tracked


@contextlib.contextmanager
def _working() -> Iterator[None]:
    """Removes the working tables that operators make inside."""
    with tracked() as made:
        yield
    for scratch in made:
        scratch.remove()


def _written(gone: DataFrame, keep: Scratch) -> DataFrame:
    """The distinct (gone_id, gone_version) of a table (doc_id, version), written."""
    return keep.table(gone.select(F.col("doc_id").cast("long").alias("gone_id"), F.col("version").alias("gone_version")).distinct(), "gone")


def _without(docs: DataFrame, gone: DataFrame, version: Column) -> DataFrame:
    """docs without the rows whose identifier, null or not, and version are in gone (gone_id, gone_version)."""
    return docs.join(maybe_broadcast(gone, gone.count()), docs["doc_id"].cast("long").eqNullSafe(gone["gone_id"]) & version.eqNullSafe(gone["gone_version"]), "left_anti")


def _digest(docs: DataFrame) -> Column:
    """64 bits of the digest that exact_dedup gives a text; within one identifier they tell texts apart."""
    return F.xxhash64(exact_dedup.sha256_of(lower_ascii(docs["text"])))


def _one_each(docs: DataFrame, by: list[Column]) -> DataFrame:
    """One row of each group of rows, the greatest in JSON, summed before the shuffle."""
    row = F.struct(*(docs[c] for c in docs.columns))
    return docs.groupBy(*by).agg(F.max_by(row, F.to_json(row)).alias("row")).select("row.*")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling towards the good labels draws.

    A null or empty text has log weight 0 and is judged by that; rows with one identifier and one text, and rows that tie at the cut, are
    drawn or left together; rows that share an identifier but no text are judged by themselves.
    """
    keep = Scratch(spark, "pipeline-quality")
    with _working():
        judged = quality.quality_sample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), version=True)
        gone = _written(judged.where(~F.col("selected")), keep)
    return _without(docs, gone, F.xxhash64(docs["text"].cast("string")))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, also where rows repeat an identifier or have none.

    The greatest identifier stays, any other before a null one; null counts as empty; of rows that repeat the identifier too, the greatest in JSON.
    """
    keep = Scratch(spark, "pipeline-exact")
    with _working():
        judged = exact_dedup.exact_dedup(docs).select("doc_id", F.xxhash64("text_sha256").alias("version"), "kept")
        dropped = keep.table(judged.groupBy("doc_id", "version").agg(F.max("kept").alias("keeps"), F.min("kept").alias("all")).where(~F.col("all")), "dropped")
    out = _without(docs, _written(dropped, keep), _digest(docs))
    # Rows that repeat the identifier of the one that stays: any one of them, as their texts are equal.
    torn = dropped.where("keeps").select(F.col("doc_id").alias("torn_id"), F.col("version").alias("torn_version"))
    n = torn.count()
    if not n:
        return out
    rows = docs.join(maybe_broadcast(torn, n), docs["doc_id"].cast("long").eqNullSafe(torn["torn_id"]) & _digest(docs).eqNullSafe(torn["torn_version"]), "left_semi")
    return out.unionByName(_one_each(rows, [rows["doc_id"], _digest(rows)]))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, also where rows repeat an identifier or have none.

    The least identifier stays. The operator takes rows with one identifier for one document, so such rows, and those without one, get identifiers
    made from their texts here, above the others'; of rows that repeat identifier and text the greatest in JSON is one. Documents without
    words are near to nothing and stay.
    """
    keep = Scratch(spark, "pipeline-near")
    shared = keep.table(docs.groupBy(F.col("doc_id").cast("long").alias("shared_id")).count().where("count > 1 OR shared_id IS NULL").select("shared_id"), "shared")
    n = shared.count()
    if not n:
        with _working():
            gone = _written(minhash.near_duplicates(docs).where(~F.col("kept")).select("doc_id", F.lit(0).alias("version")), keep)
        return _without(docs, gone, F.lit(0))
    same = docs["doc_id"].cast("long").eqNullSafe(shared["shared_id"])
    few = docs.join(maybe_broadcast(shared, n), same, "left_semi")
    few = _one_each(few, [few["doc_id"], F.xxhash64(few["text"])])
    made = F.xxhash64("doc_id", "text").bitwiseAND(F.lit((1 << 61) - 1)).bitwiseOR(F.lit(1 << 62))  # above usual identifiers, so that those stay
    name = free_name(docs.columns, "row_id")
    alone = docs.join(maybe_broadcast(shared, n), same, "left_anti").withColumn(name, F.col("doc_id").cast("long"))
    rows = keep.table(alone.unionByName(few.withColumn(name, made)), "rows")
    with _working():
        gone = keep.table(minhash.near_duplicates(rows, key=name).where(~F.col("kept")).select(F.col("doc_id").alias("gone_id")).distinct(), "gone")
    return rows.join(maybe_broadcast(gone, gone.count()), rows[name] == gone["gone_id"], "left_anti").drop(name)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that repeat an earlier one.

    A null text comes back empty; rows with one identifier and one text are one document and come back alike; a document may be left without text.
    """
    return substring_dedup.dedup_substrings(docs)


def token_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each document's pieces in sequences of 4096 tokens; a document without text is its end id alone, repeated rows are packed each."""
    return packing.pack(docs, tokens.vocabulary("word_bpe_49k.json"), capacity=4096, end_id=1)


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_duplicates),
    ("MinHash near-dedup", near_duplicates),
    ("substring dedup", repeated_passages),
    ("best-fit packing", token_sequences),
]

#: Packing and resampling are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written and read again."""
    scratch = Scratch(spark, "corpus")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = scratch.table(stage(spark, docs, sf_dir), f"stage-{k}")
        if k:
            scratch.drop(f"stage-{k - 1}")
    return docs

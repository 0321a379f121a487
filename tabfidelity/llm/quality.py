"""Quality classifier by importance resampling.

Two generative models over hashed n-grams (tokens and pairs of neighbouring tokens, hashed into `buckets`): one of the
target text, the documents labelled good, and one of the raw text, all documents. A document's log weight is the sum
over its n-grams of the log of the ratio of their smoothed probabilities; a document of the target is scored without its
own counts, as the others are. Documents are sampled without replacement by
Gumbel top-k: the k with the greatest log weight plus Gumbel noise, which is made from a hash of the identifier, so a
rerun draws the same sample on any partitioning.

k is not set by hand. A bounded sample of labelled documents (`max_labelled` by smallest hash of the identifier, both
labels; the only bounded thing here) gives the log weight that best separates good from bad, where a lost good document
counts several times as much as a kept bad one, and k is the number of all documents at or above it. Without any bad labels nothing is rejected.

The noise has scale 1, as the method has it, and log weights are sums over whole documents, so it moves only documents near the cut, short ones for the
most part.

Both models' counts are `buckets` numbers a task and the only thing that is gathered; the k-th greatest key comes from
counts in 4096 equal steps of the key's bits, refined step by step, never from a sort in one place.

Defined results: a null or empty text has log weight 0; rows that tie at the cut, such as repeated rows, are drawn together;
no labels at all give log weights 0 and keep everything; an empty table gives no rows; other columns are not carried.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, claim
from .tokens import each_text, slices

TOKEN = re.compile(r"\w+|[^\w\s]+")
CACHE_TOKENS = 200_000


class _Hashes(dict):
    def __missing__(self, token: str) -> int:
        h = zlib.crc32(token.encode("utf-8", "surrogatepass"))
        if len(self) < CACHE_TOKENS:
            self[token] = h
        return h


def ngram_buckets(text: str | None, buckets: int, hashes: _Hashes) -> np.ndarray:
    """The bucket of each token and each pair of neighbouring tokens of the whole text, case kept. hashes: a task's cache."""
    tokens = TOKEN.findall(text or "")
    h = np.fromiter(map(hashes.__getitem__, tokens), np.uint64, len(tokens))
    mixed = h * np.uint64(0x9E3779B97F4A7C15)
    pairs = (mixed[:-1] ^ (h[1:] + np.uint64(0x7F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((np.concatenate([mixed, pairs]) >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


def _count(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("quality")
        raw, target, hashes = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64), _Hashes()
        for texts, good in each_text(batches, ("text", "good")):
            for text, g in zip(texts, good, strict=True):
                found = ngram_buckets(text, buckets, hashes)
                counts = np.bincount(found, minlength=buckets)
                raw += counts
                if g:
                    target += counts
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(buckets, dtype=np.int32)), pa.array(raw), pa.array(target)], names=["bucket", "raw", "target"])

    return run


@dataclass(frozen=True)
class Models:
    """N-gram counts of the target and of all text."""

    target: np.ndarray
    raw: np.ndarray
    alpha: float

    def weight(self, found: np.ndarray, own: bool) -> float:
        """The sum of log ratios. own: the text is part of the target, whose counts are then taken without it."""
        if not self.target.any():
            return 0.0
        b, n = np.unique(found, return_counts=True)
        t, size, room = self.target[b], self.target.sum(), self.alpha * len(self.raw)
        if own:
            t, size = t - n, size - n.sum()
        return float(n @ (np.log((t + self.alpha) / (size + room)) - np.log((self.raw[b] + self.alpha) / (self.raw.sum() + room))))


def _score(shared, buckets: int, version: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("quality")
        models, hashes = shared.value, _Hashes()
        for b in slices(batches):
            weights = [models.weight(ngram_buckets(t, buckets, hashes), g) for t, g in zip(b.column("text").to_pylist(), b.column("good").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *([b.column("version")] if version else []), pa.array(weights, pa.float64())], names=["doc_id", *(["version"] if version else []), "log_weight"])

    return run


def best_cut(weights: np.ndarray, good: np.ndarray, care: float = 5.0) -> float:
    """The log weight from which on a document counts as good, in the middle of a gap: a lost share of the good costs `care` times as
    much as a kept share of the bad."""
    if not (~good).any() or not good.any():
        return float("-inf")
    order = np.argsort(weights, kind="stable")
    w, g = weights[order], good[order]
    below_bad = np.concatenate([[0], np.cumsum(~g)]) / (~g).sum()
    above_good = 1 - np.concatenate([[0], np.cumsum(g)]) / g.sum()
    edge = np.concatenate([[True], w[1:] > w[:-1], [True]])
    gain = np.where(edge, below_bad + care * above_good, -1)
    i = int(gain.argmax())
    return float("-inf") if i == 0 else float("inf") if i == len(w) else float(w[i - 1] + w[i]) / 2


def gumbel(key: Column, seed: int) -> Column:
    """Standard Gumbel noise from a hash of the key."""
    h = F.shiftrightunsigned(F.xxhash64(F.coalesce(key.cast("long"), F.lit(-1)), F.lit(seed)), 11)
    u = (h.cast("double") + 0.5) / F.lit(float(1 << 53))
    return -F.ln(-F.ln(u))


def _sortable(x: Column) -> Column:
    """A long in the order of the double, in steps of 2**-16."""
    return F.floor(F.greatest(F.least(x, F.lit(1e12)), F.lit(-1e12)) * 65536).cast("long")


def kth_greatest(keys: DataFrame, column: str, k: int) -> int:
    """The k-th greatest value of a long column, from counts per range of 1/4096 of what is left."""
    low, high = keys.agg(F.min(column), F.max(column)).first()
    left = k
    while low < high:
        width = (high - low) // 4096 + 1
        counts = keys.where(F.col(column).between(low, high)).groupBy(F.expr(f"({column} - {low}L) div {width}L").alias("b")).count().collect()
        for b, n in sorted(((r["b"], r["count"]) for r in counts), reverse=True):
            if left <= n:
                low, high = low + b * width, min(high, low + (b + 1) * width - 1)
                break
            left -= n
    return low


def _marks(labels: DataFrame, key: str, good: str) -> DataFrame:
    """doc_id and good; of conflicting labels the worse holds."""
    return labels.groupBy(labels[key].cast("long").alias("doc_id")).agg((F.min(labels[good].cast("int")) > 0).alias("good"))


def _marked(docs: DataFrame, labels: DataFrame, key: str, text: str, good: str) -> DataFrame:
    body = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))
    return body.join(_sized(_marks(labels, key, good)), "doc_id", "left").select("doc_id", "text", F.coalesce("good", F.lit(False)).alias("good"))


def fit(docs: DataFrame, labels: DataFrame, buckets: int = 10_000, alpha: float = 1.0, key: str = "doc_id", text: str = "text", good: str = "quality") -> Models:
    """Both models, counted over all documents and over all that are labelled good."""
    counts = _marked(docs, labels, key, text, good).select("text", "good").mapInArrow(_count(buckets), "bucket int, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect()  # `buckets` rows
    raw, target = np.zeros(buckets), np.zeros(buckets)
    for r in counts:
        raw[r["bucket"]], target[r["bucket"]] = r["raw"], r["target"]
    return Models(target, raw, alpha)


def _sized(marks: DataFrame) -> DataFrame:
    """Labels are broadcast under a million rows (17 MB); a larger set is joined by a shuffle."""
    return F.broadcast(marks) if marks.count() <= 1_000_000 else marks


def score(docs: DataFrame, labels: DataFrame, buckets: int = 10_000, seed: int = 42, max_labelled: int = 20_000, key: str = "doc_id", text: str = "text", good: str = "quality", version: bool = False) -> tuple[DataFrame, float, int | None]:
    """A scratch table (doc_id, log_weight, rank_key), with version the texts' xxhash64 too, the cut, and the rank key of the last document drawn (None: all)."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "quality")
    shared = spark.sparkContext.broadcast(fit(docs, labels, buckets, key=key, text=text, good=good))
    marked = _marked(docs, labels, key, text, good)
    marked = marked.withColumn("version", F.xxhash64("text")) if version else marked
    weighed = marked.mapInArrow(_score(shared, buckets, version), f"doc_id long, {'version long, ' if version else ''}log_weight double")
    scored = scratch.table(weighed.withColumn("rank_key", _sortable(F.col("log_weight") + gumbel(F.col("doc_id"), seed))), "scored")
    marks = _marks(labels, key, good)
    # The bound: about max_labelled labelled documents, by a hash of the identifier.
    n = marks.count()
    some = marks.where(F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1_000_000)) < F.lit(1_000_000 * min(1.0, max_labelled / max(n, 1))))
    sample = scored.join(F.broadcast(some), "doc_id").select("log_weight", "good").collect()
    cut = best_cut(np.array([r[0] for r in sample]), np.array([r[1] for r in sample], bool)) if sample else float("-inf")
    total = scored.count()
    k = scored.where(F.col("log_weight") >= F.lit(cut)).count() if cut != float("-inf") else total
    if k == total:
        return scored, cut, None
    return scored, cut, kth_greatest(scored, "rank_key", k) if k else 1 << 62


def quality_sample(docs: DataFrame, labels: DataFrame, buckets: int = 10_000, seed: int = 42, max_labelled: int = 20_000, version: bool = False) -> DataFrame:
    """doc_id, log_weight, gumbel_key, selected: one row for each row of docs. With version, the text's xxhash64 too, which tells rows with one identifier apart."""
    scored, _, last = score(docs, labels, buckets, seed, max_labelled, version=version)
    return scored.select("doc_id", *(["version"] if version else []), "log_weight", (F.col("rank_key") / 65536).alias("gumbel_key"), (F.lit(True) if last is None else F.col("rank_key") >= F.lit(last)).alias("selected"))

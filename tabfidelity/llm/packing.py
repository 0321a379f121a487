"""Best-fit packing of documents into token sequences after dominance reduction.

How documents pack depends on their lengths alone, and a length is at most the sequence's, so the instance is a
histogram with `capacity` entries at most, whatever the number of documents. It is the only thing that the driver
gets. There,

1. the reduction of Martello and Toth fixes sets that dominate every other choice: a length with its exact complement;
   a length that fits with none of the rest; one that fits with one other at most, with the largest such; one that fits
   with two at most, where one partner is as good as the best pair. What is fixed leaves the instance, which may let more be fixed;
2. best-fit decreasing packs the rest, whole classes of equal bins at a time.

The plan is a list of runs: documents of one length, by their rank among that length, laid out q to a bin over a range
of bins. Every document finds its run by length and rank. The rank comes from a count inside each task plus an
offset per (task, length), so no group of equally long documents ever meets in one task.

Defined results: a null or empty text is its end id alone; an empty table gives no rows; repeated rows are packed each;
other columns of the input are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch
from .tokens import CACHE_PARTS, each_text, encoder

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, rank long"
#: Runs of a plan that are sent to every worker (40 bytes each); a longer plan is joined.
PLAN_ROWS = 500_000


@dataclass
class Plan:
    """Runs (length, first_rank, n, per_bin, first_bin, offset): ranks first_rank .. +n go per_bin to a bin from first_bin on."""

    capacity: int
    bins: int = 0
    fixed_bins: int = 0
    runs: list[tuple[int, int, int, int, int, int]] = field(default_factory=list)
    _next: dict[int, int] = field(default_factory=lambda: defaultdict(int))

    def put(self, length: int, n: int, per_bin: int, first_bin: int, offset: int) -> None:
        self.runs.append((length, self._next[length], n, per_bin, first_bin, offset))
        self._next[length] += n

    def open(self, n: int) -> int:
        first, self.bins = self.bins, self.bins + n
        return first


class _Lengths:
    """The instance: how many items of each length are left, with the lengths in order."""

    def __init__(self, counts: dict[int, int]):
        self.n = {w: c for w, c in counts.items() if c > 0}
        self.order = sorted(self.n)

    def take(self, w: int, n: int) -> None:
        self.n[w] -= n
        if not self.n[w]:
            del self.n[w]
            self.order.pop(bisect_left(self.order, w))

    def smallest(self, n: int, without: int) -> list[int]:
        """The n smallest items, one item of length `without` left out."""
        out: list[int] = []
        for w in self.order:
            out += [w] * min(n - len(out), self.n[w] - (w == without))
            if len(out) >= n:
                break
        return out

    def largest_upto(self, most: int, without: tuple[int, ...] = ()) -> int | None:
        """The largest length up to `most` that has an item besides those in `without`."""
        i = bisect_left(self.order, most + 1) - 1
        while i >= 0:
            if self.n[self.order[i]] > without.count(self.order[i]):
                return self.order[i]
            i -= 1
        return None

    def best_pair(self, most: int, without: int) -> int:
        """The largest sum up to `most` of two items."""
        best = 0
        for a in self.order:
            if 2 * a > most:
                break
            if self.n[a] > (a == without) and (b := self.largest_upto(most - a, (without, a))) is not None:
                best = max(best, a + b)
        return best


def _fix(plan: Plan, left: _Lengths, w: int, partner: int | None, n: int) -> None:
    """n bins with one item of w and one of the partner, or w alone."""
    first = plan.open(n)
    plan.put(w, n, 1, first, 0)
    left.take(w, n)
    if partner is not None:
        plan.put(partner, n, 1, first, w)
        left.take(partner, n)
    plan.fixed_bins += n


def reduce_dominated(plan: Plan, left: _Lengths) -> None:
    """Fix dominating sets until a pass over the lengths, the longest first, fixes no more."""
    c, again = plan.capacity, True
    while again and left.n:
        again = False
        for w in sorted(left.n, reverse=True):
            while w in left.n:
                partner = left.largest_upto(c - w, (w,))
                if partner is None:  # fits with none
                    _fix(plan, left, w, None, left.n[w] if 2 * w > c else 1)
                    again = True
                    continue
                two, three = left.smallest(2, w), left.smallest(3, w)
                one_at_most = len(two) < 2 or w + sum(two) > c
                two_at_most = len(three) < 3 or w + sum(three) > c
                exact = w + partner == c
                if not (exact or one_at_most or two_at_most and partner >= left.best_pair(c - w, w)):
                    break
                # What made this pair dominate still holds for the next items, as fewer are left, while both lengths last.
                n = left.n[w] // 2 if partner == w else min(left.n[w], left.n[partner])
                _fix(plan, left, w, partner, n)
                again = True


def best_fit(plan: Plan, left: _Lengths) -> None:
    """Best-fit decreasing over classes of bins with one residual: the fullest class that the length fits first."""
    c = plan.capacity
    classes: dict[int, list[tuple[int, int]]] = {}
    order: list[int] = []

    def add(residual: int, first: int, n: int) -> None:
        if n and residual:
            if residual not in classes:
                classes[residual] = []
                insort(order, residual)
            classes[residual].append((first, n))

    for w in sorted(left.n, reverse=True):
        m = left.n[w]
        while m:
            at = bisect_left(order, w)
            if at < len(order):
                residual = order[at]
                first, n = classes[residual].pop()
                if not classes[residual]:
                    del classes[residual]
                    order.pop(at)
            else:
                residual, n = c, -(-m // (c // w))
                first = plan.open(n)
            q = residual // w
            full = min(n, m // q)
            if full:
                plan.put(w, full * q, q, first, c - residual)
                add(residual - q * w, first, full)
                m -= full * q
            if full < n and m and m < q:
                plan.put(w, m, m, first + full, c - residual)
                add(residual - m * w, first + full, 1)
                full, m = full + 1, 0
            add(residual, first + full, n - full)
        left.take(w, left.n[w])


def make_plan(counts: dict[int, int], capacity: int) -> Plan:
    plan, left = Plan(capacity), _Lengths(counts)
    if left.n and (left.order[0] < 1 or left.order[-1] > capacity):
        raise ValueError("lengths must be from 1 to the capacity")
    reduce_dominated(plan, left)
    best_fit(plan, left)
    return plan


def _pieces(path: str, capacity: int, end_id: int, cache_parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, task, ranks = encoder(path, cache_parts), TaskContext.get().partitionId(), defaultdict(int)
        for keys, texts in each_text(batches, ("doc_id", "text")):
            out: list[tuple] = []
            for key, found in zip(keys, enc.encode_many(texts), strict=True):
                ids = np.append(found, end_id).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    out.append((key, piece, start, len(part), zlib.crc32(part), task, ranks[len(part)]))
                    ranks[len(part)] += 1
            cols = list(zip(*out, strict=True)) or [()] * 7
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, types, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "rank"])

    return run


def _place(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, firsts, per_bin, bins, offsets = shared.value
        starts = np.searchsorted(lengths, np.arange(lengths[-1] + 2)) if len(lengths) else np.zeros(1, int)
        for b in batches:
            length = b.column("length").to_numpy(zero_copy_only=False)
            rank = b.column("rank").to_numpy(zero_copy_only=False) + b.column("before").to_numpy(zero_copy_only=False)
            at = np.empty(len(length), np.int64)
            for w in np.unique(length):
                mine = length == w
                lo, hi = starts[w], starts[w + 1]
                at[mine] = lo + np.searchsorted(firsts[lo:hi], rank[mine], side="right") - 1
            inside = rank - firsts[at]
            seq = bins[at] + inside // per_bin[at]
            offset = offsets[at] + inside % per_bin[at] * length
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(seq), pa.array(offset)], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, key: str = "doc_id", text: str = "text", cache_parts: int = CACHE_PARTS) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset for each piece.

    A document's ids are its text's and end_id. Only documents longer than the capacity are cut; their full pieces fill a sequence each.
    cache_parts weighs a worker's memory against its time; results are the same.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    pieces = scratch.table(docs.select(docs[key].cast("long").alias("doc_id"), docs[text].cast("string").alias("text")).mapInArrow(_pieces(tokenizer, capacity, end_id, cache_parts), PIECE), "pieces")
    per_task = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # `capacity` rows at most
    plan = make_plan(counts, capacity)
    before = per_task.select("length", "task", F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    ranked = pieces.join(before, ["length", "task"])
    runs = sorted(plan.runs)
    if len(runs) <= PLAN_ROWS:
        cols = [np.array(x, np.int64) for x in zip(*((w, r, q, b, o) for w, r, _, q, b, o in runs), strict=True)] if runs else [np.zeros(0, np.int64)] * 5
        shared = spark.sparkContext.broadcast(cols)
        return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank", "before").mapInArrow(_place(shared), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    table = spark.createDataFrame(runs, "length long, first long, n long, q long, bin long, at long")
    place = F.col("rank") + F.col("before")
    hit = ranked.join(table, (ranked["length"] == table["length"]) & (place >= table["first"]) & (place < table["first"] + table["n"]))
    return hit.select("doc_id", "piece", "start", ranked["length"], "ids_crc32", F.expr("bin + (rank + before - first) div q").alias("sequence_id"), (F.col("at") + (place - F.col("first")) % F.col("q") * ranked["length"]).alias("offset"))

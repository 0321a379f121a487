"""Near-duplicate detection: MinHash signatures, banding, verification and connected components.

1. One pass over the texts makes each document's set of distinct 5-word shingles (64-bit hashes), the set's digest, and
   the minima of `n_hashes` multiply-shift universal hashes over it.
2. Documents with one set are a class, which is one row from here on, as are rows that repeat, so copies cost nothing further. The sets
   of classes that share a band are stored once, for the steps that follow.
3. The signature is cut into bands of `rows` minima. Classes that share a band meet in a bucket, but no pairs are made
   there. A class's weight is the size of all its buckets; its centre is the heaviest class that it meets. It is
   paired with its own centre and those of the classes it meets.
4. A pair is verified twice. Signatures that agree in too few places (`near`, five standard deviations under a similarity of 0.5) part it;
   otherwise the full sets decide: 100 * intersection >= percent * union.
5. A class that is a centre, or linked with its own, is done with. What is left is compared exactly in tiles: the classes that
   are not linked with a centre they are near to, with all that are near to it; and the classes left in a bucket, if they were not all near to
   one centre, with each other. A tile has some hundred classes on either side, so no group meets in one task, and
   what comes out of it is a forest of links, not pairs. Intersections of a tile are one matrix product. A group of n classes of which x ask
   is n * ceil(x / tile) + x * ceil(n / tile) rows.
6. Components of all links, by large-star and small-star.

No link between classes that share a bucket is lost. If x and m are linked and b is x's centre, m was compared with b as
well. If both are near b, they are connected through it or met in its tile. If not, then x and m both are too far from b to
be linked with it, and likewise from m's centre (the triangle inequality holds for this distance), so both are left in the
bucket and met in its tile. With 40 bands of 4, a pair at a similarity of 0.75 shares no bucket with a probability of 2.5e-7.

Words are runs of other characters than blanks and ASCII control white space, after lower-casing A-Z only. Defined results: a
document with fewer words than a shingle has its whole sequence as the one shingle; one without words or text has an empty set, is
linked with nothing and is kept; rows that share an identifier are one node, have one component and are kept together;
a null identifier is linked with nothing, has no component and is kept; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, claim, maybe_broadcast
from .components import components
from .tokens import slices

CACHE_WORDS = 200_000
BLOCK = 1 << 14


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < CACHE_WORDS:
            self[word] = h
        return h


_MULT = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(text: str | None, words: int = 5, hashes: _Words | None = None) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles. hashes: a task's cache of words."""
    hashes = _Words() if hashes is None else hashes
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, ASCII white space only
    if not parts:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, parts), np.uint64, len(parts))
    size = min(words, len(h))
    out = np.full(len(h) - size + 1, size, np.uint64)
    for k in range(size):
        out = (out ^ h[k : len(h) - size + 1 + k]) * _MULT
        out ^= out >> np.uint64(29)
    return np.unique(out)


def hash_family(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, n, dtype=np.uint64)


def signatures(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A row of len(a) minima for each set, none of them empty."""
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    x = np.concatenate(sets)
    out, v = np.empty((len(a), len(sets)), np.uint32), np.empty_like(x)
    for i in range(len(a)):
        np.multiply(x, a[i], out=v)
        np.add(v, b[i], out=v)
        out[i] = np.minimum.reduceat(v, starts) >> np.uint64(32)
    return np.ascontiguousarray(out.T)


def _sign(n_hashes: int, seed: int, words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("minhash")
        a, b = hash_family(n_hashes, seed)
        hashes = _Words()
        for batch in slices(batches):
            sizes, digests, sigs = [], [], []
            block: list[np.ndarray] = []
            held = 0

            def flush(block: list[np.ndarray]) -> None:
                some = [s for s in block if len(s)]
                made = iter(signatures(some, a, b)) if some else iter(())
                sigs.extend(next(made).tobytes() if len(s) else None for s in block)  # noqa: B023

            for text in batch.column("text").to_pylist():
                s = shingle_set(text, words, hashes)
                sizes.append(len(s))
                digests.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                block.append(s)
                held += len(s)
                if held >= BLOCK:
                    flush(block)
                    block, held = [], 0
            flush(block)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("version"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(sigs, pa.binary())], names=["doc_id", "version", "n_shingles", "digest", "sig"])

    return run


def _alike(least: float):
    """Keeps pairs whose signatures agree in at least this share of places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 2000):
            left, right = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint32).reshape(b.num_rows, -1) for c in ("su", "sv"))
            yield b.select(["u", "v"]).filter(pa.array((left == right).mean(axis=1) >= least))

    return run


def _members(words: int):
    """The shingle sets of texts, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("minhash")
        hashes = _Words()
        for b in slices(batches):
            sets = [shingle_set(t, words, hashes).tobytes() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("cid"), pa.array(sets, pa.binary())], names=["cid", "members"])

    return run


def _judge(percent: int):
    """Whether the full sets of each pair are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("minhash")
        for b in slices(batches):
            linked = []
            for x, y in zip(b.column("mu"), b.column("mv"), strict=True):
                s, t = (np.frombuffer(m.as_buffer(), np.uint64) for m in (x, y))
                both = len(np.intersect1d(s, t, assume_unique=True))
                linked.append(100 * both >= percent * (len(s) + len(t) - both))
            yield pa.RecordBatch.from_arrays([b.column("u"), b.column("v"), pa.array(linked, pa.bool_())], names=["u", "v", "linked"])

    return run


def intersections(left: list[np.ndarray], right: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of the intersections of sorted sets, as a product of 0/1 matrices over the members that two sets have, in strips."""
    sizes = [len(s) for s in (*left, *right)]
    members, at, count = np.unique(np.concatenate([*left, *right]), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sizes)), sizes)
    shared = np.flatnonzero(count > 1)
    place = np.full(len(members), -1)
    place[shared] = np.arange(len(shared))
    col = place[at]
    row, col = row[col >= 0], col[col >= 0]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    out = np.zeros((len(left), len(right)), np.float32)
    for lo in range(0, len(shared), width):
        a, b = np.searchsorted(col, (lo, lo + width))
        m = np.zeros((len(sizes), min(width, len(shared) - lo)), np.float32)
        m[row[a:b], col[a:b] - lo] = 1
        out += m[: len(left)] @ m[len(left) :].T
    return out


def _tile(percent: int):
    """Links between the two sides of a tile, as a forest."""

    def run(pdf):
        import pandas as pd

        asks, held = pdf[pdf["asks"]], pdf[~pdf["asks"]]
        if not len(asks) or not len(held):
            return pd.DataFrame({"u": [], "v": []}, dtype="int64")
        us, vs = asks["cid"].to_numpy(), held["cid"].to_numpy()
        left, right = ([np.frombuffer(m, np.uint64) for m in side["members"]] for side in (asks, held))
        both = intersections(left, right)
        total = np.array([len(s) for s in left])[:, None] + np.array([len(s) for s in right])[None, :]
        linked = (100 * both >= percent * (total - both)) & (us[:, None] != vs[None, :])
        root = {c: c for c in {*us.tolist(), *vs.tolist()}}

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        out = []
        for i, j in zip(*np.nonzero(linked), strict=True):
            u, v = int(us[i]), int(vs[j])
            if (a := find(u)) != (b := find(v)):
                root[a] = b
                out.append((u, v))
        return pd.DataFrame(out, columns=["u", "v"], dtype="int64")

    return run


class _Search:
    """The tables of one run. A class has a number cid, rep, the least doc_id of its documents, n, the size of its set, and sig."""

    def __init__(self, docs: DataFrame, scratch: Scratch, n_hashes: int, rows: int, words: int, percent: int, near: float, tile: int, seed: int):
        self.tile, self.names = tile, ["signed"]
        self.docs, self.scratch, self.words, self.percent, self.near = docs.withColumn("version", F.xxhash64("text")), scratch, words, percent, near
        self.rows, self.bands, self.step = rows, n_hashes // rows, 0
        self.signed = scratch.table(self.docs.mapInArrow(_sign(n_hashes, seed, words), "doc_id long, version long, n_shingles long, digest binary, sig binary"), "signed")

    def table(self, df: DataFrame, what: str) -> DataFrame:
        self.step += 1
        self.names.append(f"{what}-{self.step}")
        return self.scratch.table(df, self.names[-1])

    def classes(self) -> None:
        real = self.signed.where("digest IS NOT NULL AND doc_id IS NOT NULL")
        least = self.table(real.groupBy("digest").agg(F.min(F.struct("doc_id", "version")).alias("first")).select("digest", F.col("first.doc_id").alias("rep"), F.col("first.version").alias("version"), F.monotonically_increasing_id().alias("cid")), "least")
        self.class_of = self.table(real.select("doc_id", "digest").join(least.select("digest", "rep"), "digest").select("doc_id", "rep").where("doc_id <> rep").distinct(), "class-of")
        rows = real.select(F.col("doc_id").alias("rep"), "version", "sig").dropDuplicates(["rep", "version"])  # one of rows that repeat, dealt as the join needs it
        self.reps = self.table(rows.join(least.select("rep", "version", "cid"), ["rep", "version"]).select("cid", "rep", "version", "sig"), "reps")

    def buckets(self) -> DataFrame:
        """(bucket, cid) of buckets with several classes, and the sets of these classes."""
        width = 4 * self.rows
        band = F.explode(F.transform(F.sequence(F.lit(0), F.lit(self.bands - 1)), lambda i: F.xxhash64(i, F.substring(F.col("sig"), i * width + 1, F.lit(width)))))
        rows = self.reps.select("cid", band.alias("bucket"))
        several = rows.groupBy("bucket").agg(F.count("*").alias("k"), F.min("cid").alias("a"), F.max("cid").alias("b")).where("a <> b").select("bucket")
        meets = self.table(rows.join(several, "bucket", "left_semi").distinct(), "meets")
        met = self.table(meets.select("cid").distinct().join(self.reps.select("cid", "rep", "version"), "cid").select("cid", F.col("rep").alias("doc_id"), "version"), "met")
        found = self.docs.join(maybe_broadcast(met, met.count()), ["doc_id", "version"]).select("cid", "text").dropDuplicates(["cid"])
        self.sets = self.table(found.mapInArrow(_members(self.words), "cid long, members binary"), "sets")
        return meets

    def judge(self, pairs: DataFrame) -> DataFrame:
        """Distinct pairs (u, v) that pass the signatures, with `linked` by their full sets."""
        one = self.reps.select(F.col("cid").alias("u"), F.col("sig").alias("su"))
        two = self.reps.select(F.col("cid").alias("v"), F.col("sig").alias("sv"))
        alike = self.table(pairs.join(one, "u").join(two, "v").select("u", "v", "su", "sv").mapInArrow(_alike(self.near), "u long, v long"), "alike")
        mu, mv = self.sets.select(F.col("cid").alias("u"), F.col("members").alias("mu")), self.sets.select(F.col("cid").alias("v"), F.col("members").alias("mv"))
        return self.table(alike.join(mu, "u").join(mv, "v").select("u", "v", "mu", "mv").mapInArrow(_judge(self.percent), "u long, v long, linked boolean"), "judged")

    def tiles(self, groups: DataFrame) -> DataFrame:
        """Links in groups (kind, key, cid, asks): of the classes that ask, with all of their group."""
        n = groups.groupBy("kind", "key").agg(F.count("*").alias("n"), F.count_if("asks").alias("x")).where("n > 1 AND x > 0")
        n = self.table(n.select("kind", "key", F.ceil(F.col("x") / self.tile).alias("across"), F.ceil(F.col("n") / self.tile).alias("down")), "cuts")
        dealt = groups.join(n, ["kind", "key"])
        own = lambda cuts: F.pmod(F.xxhash64("cid"), F.col(cuts))
        all_of = lambda cuts: F.explode(F.sequence(F.lit(0).cast("long"), F.col(cuts) - 1))
        asking = dealt.where("asks").select("kind", "key", "cid", F.lit(True).alias("asks"), own("across").alias("i"), all_of("down").alias("j"))
        held = dealt.select("kind", "key", "cid", F.lit(False).alias("asks"), all_of("across").alias("i"), own("down").alias("j"))
        laid = asking.unionByName(held).join(self.sets, "cid")
        return self.table(laid.groupBy("kind", "key", "i", "j").applyInPandas(_tile(self.percent), "u long, v long"), "tiled")

    def links(self, live: DataFrame) -> DataFrame:
        """Verified links between classes (u, v)."""
        # Sums by bucket are tables of their own, so that the planner can split a bucket that a third of all classes are in.
        sizes = self.table(live.groupBy("bucket").agg(F.count("*").alias("k")), "bucket-sizes")
        weights = live.join(sizes, "bucket").groupBy("cid").agg(F.sum("k").alias("w"))
        heavy = self.table(live.join(self.table(weights, "weights"), "cid"), "heavy")
        tops = self.table(heavy.groupBy("bucket").agg(F.max(F.struct("w", (-F.col("cid")).alias("c"))).alias("top")), "tops")
        centres = self.table(heavy.join(tops, "bucket").groupBy("cid").agg(F.max("top").alias("top")).select("cid", (-F.col("top.c")).alias("b")), "centres")
        seen = live.join(centres, "cid").select("bucket", "b").distinct()
        pairs = self.table(live.join(seen, "bucket").where("cid <> b").select(F.col("cid").alias("u"), F.col("b").alias("v")).distinct(), "pairs")
        judged = self.judge(pairs)

        around = judged.select(F.lit("centre").alias("kind"), F.col("v").alias("key"), F.col("u").alias("cid"), (~F.col("linked")).alias("asks"))
        done = centres.where("cid = b").select("cid").union(judged.where("linked").join(centres, (F.col("u") == F.col("cid")) & (F.col("v") == F.col("b"))).select("cid"))
        left = self.table(live.join(done, "cid", "left_anti"), "left")
        k = left.groupBy("bucket").agg(F.count("*").alias("k"))
        near = left.join(judged.select(F.col("u").alias("cid"), F.col("v").alias("b")).distinct(), "cid").groupBy("bucket", "b").agg(F.count("*").alias("n")).groupBy("bucket").agg(F.max("n").alias("n"))
        open_ = k.join(near, "bucket", "left").where((F.col("k") > 1) & (F.coalesce("n", F.lit(0)) < F.col("k"))).select("bucket")
        inside = left.join(open_, "bucket", "left_semi").select(F.lit("bucket").alias("kind"), F.col("bucket").alias("key"), "cid", F.lit(True).alias("asks"))
        return judged.where("linked").select("u", "v").union(self.tiles(self.table(around.unionByName(inside).distinct(), "groups")))


def near_duplicates(docs: DataFrame, n_hashes: int = 160, rows: int = 4, words: int = 5, percent: int = 75, near: float = 0.30, tile: int = 256, seed: int = 7, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of docs."""
    body = docs.select(docs[key].cast("long").alias("doc_id"), F.coalesce(docs[text].cast("string"), F.lit("")).alias("text"))
    search = _Search(body, Scratch(docs.sparkSession, "minhash"), n_hashes, rows, words, percent, near, tile, seed)
    search.classes()
    links = search.links(search.buckets())
    ids = search.reps.select("cid", "rep")
    edges = links.join(ids.toDF("u", "ru"), "u").join(ids.toDF("v", "rv"), "v").select(F.col("ru").alias("u"), F.col("rv").alias("v"))
    roots = components(edges.union(search.class_of.toDF("u", "v")), search.scratch, "roots")
    sizes = search.scratch.table(search.signed.select("doc_id", "n_shingles"), "sizes")
    search.scratch.drop(*search.names)  # signatures, sets and pairs are done with
    out = sizes.join(roots, F.col("doc_id") == F.col("node"), "left")
    return out.select("doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("component_id"), F.coalesce(F.coalesce("root", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"))

"""Substring dedup, near-duplicates, exact dedup and the quality classifier against brute force, with edge cases."""

import hashlib
import math
import random
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabfidelity.llm import components, exact_dedup, minhash, quality, substring_dedup
from tabfidelity.llm.common import Scratch

SCHEMA = "doc_id long, text string"


def prose(rng, n, words=400):
    vocab = [f"w{i}" for i in range(words)]
    out, start = [], True
    for _ in range(n):
        w = rng.choice(vocab)
        out.append(w.capitalize() if start else w)
        start = rng.random() < 0.12
        if start:
            out[-1] += "."
    return " ".join(out)


@pytest.fixture(scope="module")
def corpus():
    """Documents with exact and near copies, shared passages, nulls, empties, short and long ones."""
    rng = random.Random(4)
    texts = [prose(rng, rng.randint(40, 200)) for _ in range(60)]
    passage = prose(rng, 70)
    texts += [f"{prose(rng, 40)}. {passage}. {prose(rng, 40)}" for _ in range(8)]
    for base in (texts[3], texts[7]):
        for k in range(12):
            w = base.split()
            for _ in range(k % 5):
                w[rng.randrange(len(w))] = f"new{rng.random()}"
            texts.append(" ".join(w))
    texts += [texts[5], texts[5].upper(), texts[5] + " ", "", None, "one two", "one two", "ONE two", "   ", prose(rng, 6000)]
    return list(enumerate(texts))


# -- exact dedup


def exact_want(docs):
    groups = defaultdict(list)
    for d, t in docs:
        groups[(t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))].append(d)
    return {d: (max(g), len(g), d == max(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for d in g}


@pytest.mark.parametrize("options", [{}, {"batches": 1}, {"batches": 99}, {"digest_bits": 8}])
def test_exact_dedup(spark, corpus, options):
    df = spark.createDataFrame(corpus, SCHEMA).repartition(3)
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in exact_dedup.exact_dedup(df, **options).collect()}
    assert got == exact_want(corpus)


def test_exact_dedup_odd_rows(spark):
    df = spark.createDataFrame([(1, "a", 9), (1, "a", 9), (None, "a", 9), (None, "b", 9)], "doc_id long, text string, digest int")
    out = exact_dedup.exact_dedup(df).collect()
    assert sum(r["kept"] for r in out if r["keep_id"] == 1) == 1 and [r["kept"] for r in out if r["keep_id"] is None] == [True]
    assert exact_dedup.exact_dedup(df.where("false")).count() == 0


def test_state_outlives_a_run(spark):
    scratch = Scratch(spark, "test-state")
    schema = "digest binary, doc_id long, locator struct<part:long,row:long>"
    row = lambda i, k: spark.createDataFrame([(bytearray(k), i, (0, i))], schema)
    for i, k in ((1, b"x"), (5, b"y"), (3, b"x")):
        row(i, k).write.mode("append").parquet(scratch.path("in"))
        exact_dedup.dedup_stream(spark.readStream.schema(schema).parquet(scratch.path("in")), scratch.path("state"), scratch.path("groups"))
    got = {bytes(r["digest"]): (r["keeper"]["doc_id"], r["group_size"]) for r in exact_dedup.latest_groups(spark, scratch.path("groups")).collect()}
    assert got == {b"x": (3, 2), b"y": (5, 1)}


# -- near duplicates


def near_want(docs, percent=75):
    sets = {}
    for d, t in docs:
        w = (t or "").encode().lower().split()
        sets[d] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sets, 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {d: (len(sets[d]), find(d), find(d) == d) for d in sets}


def near_got(df, **options):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(df, **options).collect()}


@pytest.mark.parametrize("tile", [2, 256])
def test_near_duplicates(spark, corpus, tile):
    assert near_got(spark.createDataFrame(corpus, SCHEMA).repartition(3), tile=tile) == near_want(corpus)


def test_near_duplicates_in_chains_and_clusters(spark):
    """Chains, where most links are far from any one centre, and a cluster with many members beyond the threshold from its base."""
    rng = random.Random(9)
    docs = []
    for _ in range(4):
        w = prose(rng, 120).split()
        for _ in range(14):
            docs.append(" ".join(w))
            w = w.copy()
            for _ in range(2):
                w[rng.randrange(len(w))] = f"x{rng.random()}"
    base = prose(rng, 150).split()
    for k in range(60):
        w = base.copy()
        for _ in range(k % 12):
            w[rng.randrange(len(w))] = f"y{rng.random()}"
        docs.append(" ".join(w))
    docs = list(enumerate(docs))
    rng.shuffle(docs)
    assert near_got(spark.createDataFrame(docs, SCHEMA)) == near_want(docs)


def test_links_away_from_the_centre(spark):
    """Pairs that are similar to each other and share a heavy centre that neither is similar enough to."""
    rng = random.Random(11)
    base = prose(rng, 100, 5000).split()
    docs = [" ".join(base)] * 1 + [" ".join(base[:-1] + [f"e{i}"]) for i in range(6)]
    for k in range(5):
        w = base.copy()
        for at in rng.sample(range(100), 4):
            w[at] = f"far{k}-{at}"
        docs += [" ".join(w), " ".join(w[:-1] + [f"z{k}"]), " ".join([f"q{k}", *w[1:]])]
    docs = list(enumerate(docs))
    assert near_got(spark.createDataFrame(docs, SCHEMA)) == near_want(docs)


def test_near_duplicates_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(50))
    df = spark.createDataFrame([(1, text, "c"), (1, text, "c"), (1, "other words here now ok", "c"), (2, text + " more", "c"), (None, text, "c"), (3, None, "c"), (4, "", "c"), (5, "a b", "c"), (6, "A  b", "c")], "doc_id long, text string, cid string")
    got = sorted((tuple(r)[:4] for r in minhash.near_duplicates(df).collect()), key=str)
    assert sorted(r[2] for r in got if r[0] in (1, 2)) == [1, 1, 1, 1] and [r for r in got if r[0] is None] == [(None, 46, None, True)]
    assert {r[0]: r[1:] for r in got if r[0] in (3, 4, 5, 6)} == {3: (0, 3, True), 4: (0, 4, True), 5: (1, 5, True), 6: (1, 5, False)}
    assert minhash.near_duplicates(df.where("false")).count() == 0


def test_many_rows_that_repeat(spark):
    """A hundred copies each of the rows of two near copies: work goes with rows, not with pairs of them."""
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text)] * 100 + [(2, text + " more")] * 100 + [(3, "something else that stands alone here")]
    got = near_got(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert got == {1: (56, 1, True), 2: (57, 1, False), 3: (2, 3, True)}
    search = minhash._Search(spark.createDataFrame(rows, SCHEMA), Scratch(spark, "repeats"), 160, 4, 5, 75, 0.30, 256, 7)
    search.classes()
    search.buckets()
    assert search.reps.count() == 3 and search.sets.count() == 2


def test_tiles_are_cut_by_the_side_that_asks(spark):
    """One class that asks in a group of 40: the others are in one tile each, whatever the size of a tile."""
    rng = random.Random(21)
    docs = [(i, prose(rng, 30, 5000)) for i in range(40)]
    search = minhash._Search(spark.createDataFrame(docs, SCHEMA), Scratch(spark, "tiles"), 160, 4, 5, 75, 0.30, 4, 7)
    search.sets = search.table(search.docs.select(F.col("doc_id").alias("cid"), "text").mapInArrow(minhash._members(5), "cid long, members binary"), "sets")
    groups = spark.createDataFrame([("g", 1, i, i == 7) for i in range(40)], "kind string, key long, cid long, asks boolean")
    assert search.tiles(groups).count() == 0
    cuts = search.scratch.read([n for n in search.names if n.startswith("cuts")][0], spark.createDataFrame([], "kind string, key long, across long, down long")).collect()
    assert [(r["across"], r["down"]) for r in cuts] == [(1, 10)]


def test_intersections():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 300, rng.integers(0, 200))).astype(np.uint64) for _ in range(30)]
    want = [[len(np.intersect1d(a, b)) for b in sets[12:]] for a in sets[:12]]
    assert minhash.intersections(sets[:12], sets[12:], width=7).tolist() == want


def test_signatures_estimate_similarity():
    a, b = minhash.hash_family(400, 1)
    x, y = np.arange(1000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), np.arange(200, 1200, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    s = minhash.signatures([x, y], a, b)
    assert abs((s[0] == s[1]).mean() - 800 / 1200) < 0.1


def test_signatures_band_by_band():
    """A pair at the threshold shares a band: the probability that it shares none of 40 bands of 4 is under 1e-6."""
    assert (1 - 0.75**4) ** 40 < 1e-6


@pytest.mark.parametrize("kind", ["path", "star", "mixed"])
def test_components(spark, kind):
    edges = {"path": [(i, i + 1) for i in range(60)], "star": [(100, i) for i in range(50)], "mixed": [(1, 2), (2, 3), (3, 1), (9, 8), (7, 7), (8, 9)]}[kind]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "u long, v long"), Scratch(spark, "cc"), "t").collect()}
    want = {"path": {i: 0 for i in range(1, 61)}, "star": {i: 0 for i in [*range(1, 50), 100]}, "mixed": {2: 1, 3: 1, 9: 8}}[kind]
    assert got == want


# -- substring dedup


def substring_want(docs, run=3, least=8, least_words=substring_dedup.LEAST_WORDS):
    first, gone = {}, defaultdict(set)
    pieces = {d: substring_dedup.sentences(t) for d, t in docs}
    for d, _ in sorted(docs, key=lambda x: x[0]):
        parts = [" ".join(x.decode() for x in s.encode().lower().split()) for s in pieces[d]]
        k = min(run, len(parts))
        for i in range(len(parts) - k + 1 if parts else 0):
            r = tuple(parts[i : i + k])
            if sum(len(x.split()) for x in r) < least:
                continue
            if r in first:
                gone[d].update(range(i, i + k))
            else:
                first[r] = (d, i)
    for d, dead in gone.items():
        for i in sorted(dead):
            if i - 1 not in dead:
                stretch = {j for j in dead if j >= i and all(m in dead for m in range(i, j))}
                if sum(len(pieces[d][j].encode().split()) for j in stretch) < least_words:
                    dead -= stretch
    return {d: "".join(s for i, s in enumerate(pieces[d]) if i not in gone[d]) for d, t in docs}


def test_substring_dedup(spark, corpus):
    out = substring_dedup.dedup_substrings(spark.createDataFrame(corpus, SCHEMA).repartition(3))
    want = substring_want(corpus)
    assert {r["doc_id"]: r["text"] for r in out.collect()} == want
    assert sum(len(t or "") for _, t in corpus) > sum(map(len, want.values()))


def test_planted_passages_go_and_others_stay(spark):
    rng = random.Random(8)
    passages = [prose(rng, rng.randint(55, 90), 3000) for _ in range(12)]
    docs, planted = [], {}
    for i in range(120):
        head, tail = prose(rng, rng.randint(20, 80), 3000), prose(rng, rng.randint(20, 80), 3000)
        p = passages[i % 24] if i % 24 < 12 else None
        docs.append((i, f"{head}.\n{p} {tail}" if p else f"{head}. {tail}"))
        planted[i] = (p, i >= 24)
    out = {r["doc_id"]: r["text"] for r in substring_dedup.dedup_substrings(spark.createDataFrame(docs, SCHEMA)).collect()}
    for i, (p, later) in planted.items():
        if p is None or not later:
            assert out[i] == docs[i][1]
        else:
            assert p not in out[i] and len(docs[i][1]) - len(out[i]) > 0.5 * len(p)


def repeats(docs, n=50):
    """By brute force: identifiers and the stretches of n words or more, as (from, to), that an earlier place has."""
    seen, found = set(), {}
    for d, t in sorted(docs):
        w, mine = (t or "").encode().lower().split(), []
        for i in range(len(w) - n + 1):
            g = hash(tuple(w[i : i + n]))
            if g in seen:
                if mine and i <= mine[-1][1]:
                    mine[-1][1] = i + n
                else:
                    mine.append([i, i + n])
            seen.add(g)
        if mine:
            found[d] = mine
    return found


def test_against_all_stretches_of_fifty_words(spark):
    """What the operator takes and leaves, held against a search for every stretch of 50 or more words that repeats."""
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    found = repeats(docs)
    got = {r["doc_id"]: r for r in substring_dedup.dedup_substrings(spark.createDataFrame(docs, SCHEMA), counts=True).collect()}
    assert np.mean([got[d]["n_removed"] > 0 for d in found]) >= 0.99
    clean = [d for d, _ in docs if d not in found]
    assert np.mean([got[d]["n_removed"] == 0 for d in clean]) >= 0.965
    gone = [len((t or "").split()) - len(got[d]["text"].split()) for d, t in docs if d in found]
    long = [sum(b - a for a, b in x) for d, x in sorted(found.items())]
    assert sum(gone) >= 0.9 * sum(long)


def caught(spark, pairs):
    """The number of words removed from the second of each pair of documents, all in one run."""
    docs = [(2 * i + k, t) for i, pair in enumerate(pairs) for k, t in enumerate(pair)]
    out = {r["doc_id"]: r["text"] for r in substring_dedup.dedup_substrings(spark.createDataFrame(docs, SCHEMA)).collect()}
    assert all(out[2 * i] == a for i, (a, _) in enumerate(pairs))
    return [len(b.split()) - len(out[2 * i + 1].split()) for i, (_, b) in enumerate(pairs)]


@pytest.mark.parametrize("n", [51, 60, 78])
def test_passages_of_two_sentences_and_in_mid_sentence(spark, n):
    rng = random.Random(n)
    words = lambda k: " ".join(f"u{rng.randrange(10**6)}" for _ in range(k))
    two = lambda: f"{words(n // 2).capitalize()}. {words(n - n // 2).capitalize()}."
    own = [tuple(f"{words(30)}.\n{p}\n{words(30)}." for _ in range(2)) for p in (two() for _ in range(30))]
    mid = [tuple(f"{words(a)} {p} {words(b)}." for a, b in ((33, 25), (18, 40))) for p in (words(n) for _ in range(30))]
    got = caught(spark, own + mid)
    assert np.mean([x >= 30 for x in got]) >= (0.97 if n > 51 else 0.9) and all(x == 0 or x >= 30 for x in got)


def test_short_lines_that_repeat(spark):
    rng = random.Random(12)
    words = lambda k: " ".join(f"u{rng.randrange(10**6)}" for _ in range(k))
    lists = ["\n".join(words(k) for _ in range(60 // k)) for k in (1, 2) for _ in range(10)]
    assert min(caught(spark, [tuple(f"{words(30)}.\n{x}\n{words(30)}." for _ in range(2)) for x in lists])) >= 30


def test_short_stretches_stay(spark):
    """A licence line of twenty words in many documents is not a copied passage."""
    rng = random.Random(5)
    words = lambda k: " ".join(f"u{rng.randrange(10**6)}" for _ in range(k))
    line = words(20).capitalize() + "."
    assert caught(spark, [tuple(f"{words(50)}.\n{line}\n{words(50)}." for _ in range(2)) for _ in range(1)] * 1) == [0]


def test_covered_stretches():
    ends = [10, 20, 30, 40, 50, 60]
    assert substring_dedup.covered(ends, [0, 3], 2, 20) == {0, 1, 3, 4}
    assert substring_dedup.covered(ends, [0, 3], 2, 21) == set()
    assert substring_dedup.covered(ends, [0, 2], 2, 40) == {0, 1, 2, 3} and substring_dedup.covered(ends, [5], 3, 10) == {5}


def test_sentences_join_to_the_text():
    rng = random.Random(2)
    for _ in range(300):
        t = "".join(rng.choice(["a ", "b. ", "\n", "  ", "!", "? ", "w" * 9 + " ", ".", "\n\n"]) for _ in range(rng.randint(0, 200)))
        assert "".join(substring_dedup.sentences(t)) == t
    assert substring_dedup.sentences(None) == []


def test_long_texts_without_stops(spark):
    """A passage is found though neither text has a full stop."""
    rng = random.Random(3)
    words = lambda n: " ".join(f"v{rng.randrange(10**6)}" for _ in range(n))
    p = words(200)
    docs = [(1, f"{words(90)} {p} {words(90)}"), (2, f"{words(131)} {p} {words(40)}")]
    out = {r["doc_id"]: r["text"] for r in substring_dedup.dedup_substrings(spark.createDataFrame(docs, SCHEMA)).collect()}
    assert out[1] == docs[0][1] and len(docs[1][1]) - len(out[2]) > 0.6 * len(p)


def test_substring_dedup_odd_rows(spark):
    s = " ".join(f"Alpha{i} beta{i} gamma{i} delta{i}." for i in range(10))
    df = spark.createDataFrame([(1, s, 7, 3), (1, s, 7, 3), (1, "short", 7, 3), (None, s, 7, 3), (2, None, 7, 3)], "doc_id long, text string, n_chars long, place int")
    out = substring_dedup.dedup_substrings(df, counts=True)
    assert out.columns == ["doc_id", "text", "n_chars", "place", "n_removed"]
    got = sorted(((r["doc_id"], r["text"], r["n_chars"]) for r in out.collect()), key=str)
    assert (2, "", 0) in got and (1, "short", 5) in got
    assert sorted(len(t) for d, t, _ in got if t != "short" and d != 2) in ([0, 0, len(s)], [0, len(s), len(s)])
    assert substring_dedup.dedup_substrings(df.where("false")).count() == 0


# -- quality


def test_quality_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    known = labels.where("doc_id % 2 = 0")
    out = quality.quality_sample(docs, known).join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    good = [r["selected"] for r in out if r["quality"] == 1]
    bad = [r["selected"] for r in out if r["quality"] == 0]
    assert np.mean(good) > 0.95 and (not bad or np.mean(bad) < 0.4)


def quality_want(docs, labels, buckets, seed, noise):
    """Counts, weights and the draw, in plain Python."""
    import zlib

    good = {}
    for d, q in labels:
        good[d] = min(good.get(d, 1), q)

    def grams(text):
        h = [zlib.crc32(x.encode()) for x in quality.TOKEN.findall(text or "")]
        m = 1 << 64
        mixed = [x * 0x9E3779B97F4A7C15 % m for x in h]
        pairs = [(a ^ (b + 0x7F4A7C15)) * 0xBF58476D1CE4E5B9 % m for a, b in zip(mixed, h[1:])]
        return Counter((x >> 33) % buckets for x in mixed + pairs)

    raw, target = Counter(), Counter()
    for d, t in docs:
        raw += grams(t)
        if good.get(d):
            target += grams(t)
    weights = []
    for d, t in docs:
        g, own = grams(t), target if not good.get(d) else target - grams(t)
        p = lambda c, b: math.log((c[b] + 1) / (sum(c.values()) + buckets))
        weights.append(sum(n * (p(own, b) - p(raw, b)) for b, n in g.items()))
    pairs = [(w, bool(good[d])) for (d, _), w in zip(docs, weights) if d in good]
    cut = quality.best_cut(np.array([w for w, _ in pairs]), np.array([g for _, g in pairs]))
    k = sum(w >= cut for w in weights)
    keys = [math.floor((w + noise[d]) * 65536) for (d, _), w in zip(docs, weights)]
    last = sorted(keys, reverse=True)[k - 1] if 0 < k < len(docs) else -math.inf if k else math.inf
    return weights, [x >= last for x in keys]


def test_quality_against_plain_python(spark):
    rng = random.Random(31)
    fine, poor = [f"fine{i}" for i in range(60)], [f"poor{i}" for i in range(60)]
    text = lambda i: " ".join(rng.choice(fine if i % 3 else poor if rng.random() < 0.8 else fine) for _ in range(rng.randint(0, 12)))
    docs = [(i, text(i)) for i in range(150)] + [(150, None), (151, ""), (3, "fine1 fine2"), (3, "fine1 fine2")]
    labels = [(i, int(i % 3 > 0)) for i in range(0, 120)] + [(4, 0), (4, 1)]
    df = spark.createDataFrame(docs, SCHEMA)
    noise = {r[0]: r[1] for r in df.select("doc_id", quality.gumbel(F.col("doc_id"), 42)).collect()}
    weights, drawn = quality_want(docs, labels, 500, 42, noise)
    got = quality.quality_sample(df.repartition(3), spark.createDataFrame(labels, "doc_id long, quality int"), buckets=500).collect()
    want = sorted((d, round(w, 6), s) for (d, _), w, s in zip(docs, weights, drawn, strict=True))
    assert sorted((r["doc_id"], round(r["log_weight"], 6) + 0.0, r["selected"]) for r in got) == want
    assert 0 < sum(drawn) < len(docs)


def test_quality_ties_at_the_cut(spark):
    """Repeated rows have one key and are drawn, or not, together."""
    docs = [(i % 5, f"good words number {i % 5}" if i % 5 < 3 else f"bad things {i % 5}") for i in range(40)]
    out = quality.quality_sample(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame([(0, 1), (1, 1), (4, 0)], "doc_id long, quality int")).collect()
    assert len(out) == 40 and all(len({r["selected"] for r in out if r["doc_id"] == d}) == 1 for d in range(5))


def test_quality_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None), (2, "a b")], SCHEMA)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [(r["log_weight"], r["selected"]) for r in quality.quality_sample(docs, none).collect()] == [(0.0, True)] * 3
    assert quality.quality_sample(docs.where("false"), none).count() == 0


def test_gumbel_top_k_is_repeatable(spark):
    df = spark.range(5000).withColumnRenamed("id", "doc_id")
    a = sorted(r[0] for r in df.select(quality.gumbel(F.col("doc_id"), 1)).collect())
    b = sorted(r[0] for r in df.repartition(7).select(quality.gumbel(F.col("doc_id"), 1)).collect())
    assert a == b and abs(np.mean(a) - 0.5772) < 0.06


@pytest.mark.parametrize("k", [1, 17, 500, 1000])
def test_kth_greatest(spark, k):
    rng = random.Random(k)
    x = [rng.choice([rng.randrange(-(10**12), 10**12), rng.randrange(5)]) for _ in range(1000)]
    assert quality.kth_greatest(spark.createDataFrame([(v,) for v in x], "v long"), "v", k) == sorted(x, reverse=True)[k - 1]


def test_best_cut():
    assert quality.best_cut(np.array([-5.0, -3, 1, 2]), np.array([False, False, True, True])) == -1.0
    assert quality.best_cut(np.array([1.0, 2]), np.array([True, True])) == float("-inf")

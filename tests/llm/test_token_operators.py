"""Token, packing, media, url and sharding operators against brute force and round trips, and the pipeline."""

import json
import math
import random
import struct
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabfidelity.llm import packing, queries, sentencepiece_nbest, sharding, tiff, token_files, tokens, url_filter
from tabfidelity.llm.common import Scratch

WORDS, PIECES = tokens.vocabulary("word_bpe_49k.json"), tokens.vocabulary("piece_bpe_32k.model")
TEXTS = ["Hello, world.", "", None, "don't <|endoftext|> stop", "  tabs\tand\nlines ", "ÉCOLE naïve İstanbul Ǆ", "e\u0301 H\u0331 x", "a" * 300, "漢字 😀 ٣٤ x1y", "..., --- foo.) 's", "word " * 2000]


def library_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORDS)
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_encoder_equals_library():
    rng = random.Random(1)
    bits = ["H\u0331", "h", "İ", " ", "\n", "\t", "'s", "don't", "...", "a,b", "x.", "!!,", "foo,", "Σ", "ΑΣ", "é", "É", "<|endoftext|>", "12", "\x1c", "\x85", "漢字", "😀", "ß", ".", ",", "abc.", "K", "a-b", "it'", "\u2028"]
    texts = [*TEXTS, *("".join(rng.choice(bits) for _ in range(rng.randint(1, 12))) for _ in range(3000))]
    enc = tokens.Encoder(WORDS)
    assert enc._by_part
    assert [x.tolist() for x in enc.encode_many(texts)] == library_ids(texts)


def test_full_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_PARTS", 5)
    assert [x.tolist() for x in tokens.Encoder(WORDS).encode_many(TEXTS * 3, block=2)] == library_ids(TEXTS * 3)


# -- packing


def check_plan(counts, capacity):
    plan = packing.make_plan(counts, capacity)
    bins, ranks = Counter(), {w: set() for w in counts}
    spans = {}
    for w, first, n, q, b, off in plan.runs:
        for r in range(n):
            assert first + r not in ranks[w]
            ranks[w].add(first + r)
            spans.setdefault(b + r // q, []).append((off + r % q * w, w))
            bins[b + r // q] += w
    assert {w: set(range(c)) for w, c in counts.items()} == ranks
    for s in spans.values():
        end = 0
        for off, w in sorted(s):
            assert off == end
            end += w
        assert end <= capacity
    assert set(bins) == set(range(plan.bins))
    return plan


def fewest(items, capacity):
    """The least number of bins by search."""
    items = sorted(items, reverse=True)
    best = len(items)

    def go(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(items):
            best = len(bins)
            return
        for i in {b: i for i, b in enumerate(bins)}.values():
            if bins[i] >= items[k]:
                bins[i] -= items[k]
                go(k + 1, bins)
                bins[i] += items[k]
        go(k + 1, [*bins, capacity - items[k]])

    go(0, [])
    return best


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=9))
def test_reduction_keeps_the_optimum(items):
    """Bins that are fixed, and the best for what is left, are as few as the best for all."""
    counts = dict(Counter(items))
    check_plan(counts, 20)
    plan, left = packing.Plan(20), packing._Lengths(counts)
    packing.reduce_dominated(plan, left)
    rest = [w for w, n in left.n.items() for _ in range(n)]
    assert plan.fixed_bins + fewest(rest, 20) == fewest(items, 20)


def test_large_plans():
    rng = random.Random(5)
    plan = check_plan(dict(Counter(min(4096, int(rng.lognormvariate(6, 1)) + 1) for _ in range(20000))), 4096)
    total = sum(w * n for w, _, n, *_ in plan.runs)
    assert plan.bins <= -(-total // 4096) * 1.01 + 1
    assert check_plan({4096: 7, 1: 3}, 4096).bins == 8
    assert check_plan({}, 4096).bins == 0
    hot = check_plan({1000: 100_001, 96: 25_000}, 4096)
    assert hot.bins == 25_001
    with pytest.raises(ValueError):
        packing.make_plan({5000: 1}, 4096)


def test_pack(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").unionByName(spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string"))
    rows = docs.collect()
    want = {}
    for r, ids in zip(rows, library_ids([r["text"] for r in rows]), strict=True):
        every = np.array([*ids, 1], "<u4")
        for k, at in enumerate(range(0, len(every), 512)):
            want[r["doc_id"], k] = (at, len(every[at : at + 512]), zlib.crc32(every[at : at + 512].tobytes()))
    for limit in (packing.PLAN_ROWS, 0):
        old, packing.PLAN_ROWS = packing.PLAN_ROWS, limit
        try:
            got = packing.pack(docs, WORDS, 512, 1).collect()
        finally:
            packing.PLAN_ROWS = old
        assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in got} == want
        used = {}
        for r in got:
            used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        for parts in used.values():
            end = 0
            for off, n in sorted(parts):
                assert off == end
                end += n
            assert end <= 512
        assert len(used) <= -(-sum(r["length"] for r in got) // 512) + 3


# -- token files


def test_token_files(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").unionByName(spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string"), allowMissingColumns=True)
    rows = sorted(docs.collect(), key=lambda r: r["doc_id"])
    want, start = {}, 0
    for r, ids in zip(rows, library_ids([r["text"] for r in rows]), strict=True):
        every = np.array([*ids, 2], "<u4")
        want[r["doc_id"]] = (start, len(every), zlib.crc32(every.tobytes()))
        start += len(every)
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in token_files.token_files(docs, WORDS, 2, seq_len=64).collect()}
    assert got == want


def test_random_access_without_copies(tmp_path):
    """Sequence i and its mask are views of the mapped file: nothing is allocated, by Arrow or by numpy."""
    path, n, width = str(tmp_path / "x.arrow"), 64 * 1000 - 24, 64
    ids = (np.arange(n) % 60_000).astype(np.uint16)
    with pa.OSFile(path, "wb") as sink:
        w = token_files.SequenceWriter(sink, np.dtype("<u2"), width)
        for at in range(0, n, 7001):
            w.add(ids[at : at + 7001])
        w.close()
    with token_files.SequenceFile(path) as f:
        assert len(f) == 1000
        before = pa.total_allocated_bytes()
        for i in (999, 0, 255, 256, 700):
            got, mask = f.sequence(i)
            want = ids[i * width : (i + 1) * width]
            assert np.array_equal(got[: len(want)], want) and mask.sum() == len(want) and mask.dtype == np.uint8
            spot = f._file.get_batch(i // token_files.BATCH)
            for view, c in ((got, "ids"), (mask, "mask")):
                column = spot.column(c)
                buffer = (column.dictionary if c == "mask" else column).flatten().buffers()[1]
                assert buffer.address <= view.__array_interface__["data"][0] < buffer.address + buffer.size
        assert pa.total_allocated_bytes() - before < 4096
        assert np.concatenate(list(f.tokens(100, 500))).tolist() == ids[100:600].tolist()
        with pytest.raises(IndexError):
            f.sequence(1000)
        with pytest.raises(ValueError):
            list(f.tokens(n - 5, 10))
        del got, mask, view


def test_files_are_rolled_and_rows_flushed(spark, sf_dir, monkeypatch):
    """Files and index batches of a few tokens and rows give the same result."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(40).repartition(2)
    docs = Scratch(spark, "few").table(docs, "docs")
    want = sorted(map(tuple, token_files.token_files(docs, WORDS, 2, seq_len=64).collect()))
    scratch = Scratch(spark, "rolled")
    store, base = token_files._open(scratch.path("files"))
    store.create_dir(base, recursive=True)
    monkeypatch.setattr(token_files, "INDEX_ROWS", 3)
    made, out, enc = [], None, tokens.Encoder(WORDS)
    for r in sorted(docs.collect()):
        out = out or token_files._Output(store, base, f"tokens-{len(made):06d}-0000", enc.dtype, 64)
        (ids,) = enc.encode_many([r["text"]])
        out.add(r["doc_id"], np.append(ids, 2).astype(enc.dtype))
        if out.sequences.total > 2000:
            made.append(out.close())
            out = None
    made += [out.close()] if out else []
    manifest = spark.createDataFrame(made, token_files.MANIFEST)
    assert len(made) > 2 and sorted(map(tuple, token_files.read_token_files(manifest, scratch.path("files")).collect())) == want


def test_token_files_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert token_files.token_files(docs, WORDS).count() == 0 and packing.pack(docs, WORDS).count() == 0
    null_key = spark.createDataFrame([(None, "a"), (3, None)], "doc_id long, text string")
    assert [tuple(r)[:3] for r in token_files.token_files(null_key, WORDS).orderBy("start").collect()] == [(None, 0, 2), (3, 2, 1)]


# -- SentencePiece


def lattice_nbest(m, text, n):
    """The n best of the whole lattice by (score, ids): n prefixes kept at each place, in plain Python."""
    ends, found = m.edges(text), [[(0.0, ())]]
    for j in range(1, len(text) + 1):
        found.append(sorted(((a + s, b + p) for i, p, s in ends[j] for a, b in found[i]), key=lambda x: (-x[0], x[1]))[:n])
    return found[-1]


def test_words_before_marks_are_encoded_without_the_whole_tokenizer():
    enc, asked = tokens.Encoder(WORDS), []
    batch = enc._batch
    enc._batch = lambda texts: asked.extend(texts) or batch(texts)
    texts = ["Lorem!! ipsum; dolor?! (sit) amét... x'' y's 3!! <|endoftext|>! a_b", "lorem!! Dolor?! ipsum;"]
    assert [x.tolist() for x in enc.encode_many(texts)] == library_ids(texts)
    assert not {"lorem!!", "ipsum;", "dolor?!", "amét...", "x''"} & set(asked)
    assert len(asked) == len(set(asked))
    every = [f"{w}{a}{b}{c}" for w in ("ab", "É", "the") for a in map(chr, tokens.MARKS) for b in ("", "!", "'", "_") for c in ("", "s", "t", "3", "é", "\u0301")]
    assert [x.tolist() for x in tokens.Encoder(WORDS).encode_many(every)] == library_ids(every)


def test_marks_that_a_vocabulary_joins_to_words_are_not_parted(tmp_path):
    spec = json.load(open(WORDS, encoding="utf-8"))
    spec["added_tokens"].append({"id": 49408, "content": "ab!", "single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": True})
    (tmp_path / "v.json").write_text(json.dumps(spec), encoding="utf-8")
    enc = tokens.Encoder(str(tmp_path / "v.json"))
    assert next(enc.encode_many(["ab! cab!!"])).tolist() == enc._tok.encode("ab! cab!!", add_special_tokens=False).ids


VOCAB = ["the", "cat", "banana", "on", "a", "xyzzy", "==", "====", "===", "naïve", "漢字漢字", "....", "\n", "hello,", "a\nb", "éé", "123", "x漢a漢b", "\x01q", "😀"]


@pytest.mark.parametrize("n", [2, 4, 7])
def test_nbest_against_the_whole_lattice(n):
    """Ids and scores at every rank, in texts of up to 300 words with repeats, where equal scores are the rule."""
    enc, rng = sentencepiece_nbest.Encoder(PIECES, n), random.Random(n)
    texts = ["the cat " * 40, "banana " * 70, " ".join(["the", "cat", "sat"] * 25), "=" * 60 + " " + "=" * 60, "  a  ", "😀"]
    for _ in range(120):
        some = rng.sample(VOCAB, rng.randint(1, 6))
        texts.append(" ".join(rng.choice(some) for _ in range(rng.choice([1, 2, 3, 5, 20, 60, 300]))))
    for t in texts:
        got = [(s, tuple(np.frombuffer(ids, "<u4").tolist())) for s, ids in enc.nbest(t)]
        assert got == lattice_nbest(enc.model, enc.model.normalise(t), n)


def test_first_and_second_scores():
    m = sentencepiece_nbest.Encoder(PIECES, 2).model
    for t in {f"▁{w}" for w in VOCAB} | {"▁" + "=" * k for k in range(1, 40)}:
        want = lattice_nbest(m, t, 2)
        assert m.best(t) == (want[0][1], want[0][0], want[0][0] - want[1][0] if len(want) > 1 else float("inf"))


def test_long_segments_take_linear_time():
    """A line of fifty thousand rulings, and one of as many characters that no piece joins."""
    import time

    enc = sentencepiece_nbest.Encoder(PIECES, 4)
    began = time.process_time()
    assert len(enc.nbest("=" * 50_000)) == 4 and len(enc.nbest("漢字" * 25_000)) >= 1
    assert time.process_time() - began < 60


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=40))
def test_decoding_gives_the_text_again(text):
    import sentencepiece

    enc = sentencepiece_nbest.encoder(PIECES, 3)
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for _, raw in enc.nbest(text):
        ids = np.frombuffer(raw, "<u4").tolist()
        assert enc.model.decode(ids) == text
        if "▁" not in text:
            assert lib.decode(ids) == text


def test_sentencepiece_frames(spark):
    docs = spark.createDataFrame([(1, "Hello world\nagain"), (2, None), (3, ""), (None, "x" * 3000)], "doc_id long, text string")
    rows = sentencepiece_nbest.encode_nbest(docs, PIECES, 2)
    back = {(r["doc_id"], r["rank"]): r["text"] for r in sentencepiece_nbest.decode_ids(rows, PIECES).collect()}
    assert back[1, 0] == back[1, 1] == "Hello world\nagain" and back[2, 0] == "" and (2, 1) not in back and back[None, 0] == "x" * 3000
    out = sentencepiece_nbest.nbest_digests(docs, PIECES, 2).collect()
    assert all(r["round_trip"] for r in out if r["rank"] == 0) and sentencepiece_nbest.nbest_digests(docs.where("false"), PIECES).count() == 0


# -- TIFF


@settings(max_examples=80, deadline=None)
@given(st.binary(max_size=700))
def test_codecs_round_trip(data):
    assert tiff.packbits_decode(tiff.packbits_encode(data), len(data)) == data
    assert tiff.lzw_decode(tiff.lzw_encode(data), len(data)) == data


def test_lzw_beyond_a_full_table():
    rng = random.Random(1)
    data = bytes(rng.randrange(256) for _ in range(30_000))
    assert tiff.lzw_decode(tiff.lzw_encode(data), len(data)) == data


def test_known_lzw_code():
    """The example of the format's description: codes of nine bits from 256 on."""
    raw = bytes([7, 7, 7, 8, 8, 7, 7, 6, 6])
    bits = "".join(f"{c:09b}" for c in (256, 7, 258, 8, 8, 258, 6, 6, 257))
    packed = int(bits.ljust(-(-len(bits) // 8) * 8, "0"), 2).to_bytes(-(-len(bits) // 8), "big")
    assert tiff.lzw_encode(raw) == packed and tiff.lzw_decode(packed, len(raw)) == raw


@pytest.mark.parametrize("order", ["<", ">"])
@pytest.mark.parametrize("kind", [tiff.PLAIN, tiff.PACKBITS, tiff.LZW, tiff.DEFLATE])
@pytest.mark.parametrize("predictor", [1, 2])
@pytest.mark.parametrize("layout", [{}, {"rows_per_strip": 7}, {"tile": 16}])
def test_layouts(order, kind, predictor, layout):
    r = np.random.default_rng(3)
    pages = [r.integers(0, 256, (23, 41), dtype=np.uint8), np.tile(np.arange(50, dtype=np.uint8), (20, 1))]
    got = list(tiff.read_pages(tiff.write_tiff(pages, kind, predictor, order=order, **layout)))
    assert [p.error for p in got] == [None, None] and [p.number for p in got] == [0, 1]
    for p, want in zip(got, pages, strict=True):
        assert np.array_equal(p.pixels[:, :, 0], want) and p.tiled == ("tile" in layout)


def test_float_predictor_and_planes():
    """Floats with predictor 3, and two samples a pixel in planes of their own, written by hand."""
    x = np.linspace(-3, 5, 12, dtype=">f4").reshape(3, 4)
    planes = np.ascontiguousarray(x.view(np.uint8).reshape(3, 4, 4).transpose(0, 2, 1)).reshape(3, 16)
    data = np.diff(planes, axis=1, prepend=np.zeros((3, 1), np.uint8)).tobytes()
    tags = [(256, 4), (257, 3), (258, 32), (259, 1), (273, 8), (277, 1), (278, 3), (279, len(data)), (317, 3), (339, 3)]
    buf = struct.pack("<2sHI", b"II", 42, 8 + len(data)) + data + struct.pack("<H", len(tags)) + b"".join(struct.pack("<HHII", t, 4, 1, v) for t, v in tags) + b"\0\0\0\0"
    (page,) = tiff.read_pages(buf)
    assert page.error is None and np.array_equal(page.pixels[:, :, 0], x.astype("<f4"))
    a, b = bytes(range(12)), bytes(range(100, 112))
    spot = 8 + 24
    tags = [(256, 4, 1), (257, 3, 1), (258, 8, 1), (259, 1, 1), (273, spot, 2), (277, 2, 1), (278, 3, 1), (279, spot + 8, 2), (284, 2, 1)]
    buf = struct.pack("<2sHI", b"II", 42, spot + 16) + a + b + struct.pack("<IIII", 8, 20, 12, 12) + struct.pack("<H", len(tags)) + b"".join(struct.pack("<HHII", t, 4, n, v) for t, v, n in tags) + b"\0\0\0\0"
    (page,) = tiff.read_pages(buf)
    assert page.error is None and page.pixels[:, :, 0].tobytes() == a and page.pixels[:, :, 1].tobytes() == b


def test_media_of_nonsense_give_rows():
    """No bytes end the reader: headers changed at random, counts of nothing, and sizes that no strip could hold."""
    rng, r = random.Random(1), np.random.default_rng(2)
    files = [tiff.write_tiff([r.integers(97, 110, (40, 64), dtype=np.uint8) for _ in range(2)], kind, predictor, order=order, **({"tile": 16} if tiled else {"rows_per_strip": 16})) for kind, predictor, tiled in tiff.LAYOUTS for order in "<>"]
    for _ in range(1500):
        b = bytearray(rng.choice(files))
        for _ in range(rng.randint(1, 6)):
            at = rng.choice([rng.randrange(16), len(b) - rng.randrange(1, 300), rng.randrange(len(b))])
            b[at] = rng.choice([0, 255, rng.randrange(256), 1, 2, 3])
        b = b[: rng.randrange(len(b))] if rng.random() < 0.2 else b
        b[2:4] = b"+\0" if rng.random() < 0.1 else b[2:4]
        assert all((p.pixels is None) == (p.error is not None) and p.width < 1 << 31 for p in tiff.read_pages(bytes(b)))
    head = lambda *tags: struct.pack("<2sHIH", b"II", 42, 8, len(tags)) + b"".join(struct.pack("<HHII", t, 4, n, v) for t, n, v in tags) + b"\0" * 20
    for tags in (((256, 0, 5), (257, 1, 5)), ((256, 1, 100_000), (257, 1, 2_000_000), (258, 1, 8), (273, 1, 8), (279, 1, 20)), ((256, 1, 1 << 31), (257, 1, 1), (258, 1, 8))):
        (page,) = tiff.read_pages(head(*tags))
        assert page.error and page.pixels is None


def test_stored_layouts_and_features(spark):
    """Every layout is used by the query's texts, and the features are those of the payload."""
    rng = random.Random(3)
    texts = ["".join(rng.choice("abc dé") for _ in range(rng.choice([0, 5, 700, 12_000]))) for _ in range(120)]
    rows = tiff.texts_to_tiff(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    pages = [p for r in rows for p in tiff.read_pages(bytes(r["media"]))]
    assert {(p.compression, p.predictor) for p in pages} == {(k, q) for k, q, _ in tiff.LAYOUTS} and {p.tiled for p in pages} == {True, False}
    got = {r["doc_id"]: r["feature"] for r in tiff.media_digests(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, t in enumerate(texts):
        raw = t.encode()
        payload = raw + b"\xff" * (-len(raw) % 576 or (0 if raw else 576))
        n = Counter(payload)
        entropy = -sum(c / len(payload) * math.log2(c / len(payload)) for c in n.values())
        found = dict(x.split("=") for x in got[i].split(";"))
        assert (int(found["pages"]), int(found["levels"])) == (-(-len(payload) // (576 * 64)), len(n))
        assert abs(float(found["mean"]) - sum(payload) / len(payload)) < 1e-3 and abs(float(found["entropy"]) - entropy) < 1e-3


def test_broken_media(spark):
    good = tiff.write_tiff([np.zeros((4, 4), np.uint8)])
    ring = bytearray(good)
    struct.pack_into("<I", ring, len(ring) - 4, struct.unpack_from("<I", good, 4)[0])
    rows = [(1, None), (2, b""), (3, b"no media"), (4, good[: len(good) - 30]), (5, bytes(ring)), (6, good), (6, good)]
    got = tiff.tiff_pages(spark.createDataFrame([(k, None if m is None else bytearray(m)) for k, m in rows], "doc_id long, media binary")).collect()
    errors = {k: [r["error"] for r in got if r["doc_id"] == k] for k in range(1, 7)}
    assert errors[1] == errors[2] == [] and all(errors[3]) and any(errors[4]) and errors[5][0] is None and "ring" in errors[5][1] and errors[6] == [None, None]
    for cut in range(0, len(good), 3):
        list(tiff.read_pages(good[:cut]))  # no exception


def test_media_digests(spark):
    import hashlib

    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)] + [(99, TEXTS[0]), (None, "x")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in tiff.media_digests(docs).collect()}
    for i, t in enumerate(TEXTS):
        raw = (t or "").encode()
        padded = raw + b"\xff" * (-len(raw) % 576 or (0 if raw else 576))
        r = got[i]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-32:]))
    assert tuple(got[0])[1:] == tuple(got[99])[1:] and tiff.media_digests(docs.where("false")).count() == 0


# -- urls


def url_want(url, rules, default="allow"):
    host, path = "", ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, rest = "".join(c.lower() if c.isascii() else c for c in rest[:cut]), rest[cut:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    best = None
    for r, v in rules:
        h, _, p = r.partition("/")
        p = "/" + p if "/" in r else ""
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or (len(r), v) > (len(best[0]), best[1])):
            best = (r, v)
    return (host, path, best[0] if best else None, best[1] if best else default)


def test_url_filter(spark):
    rng = random.Random(6)
    rules = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"), ("a.example.net/", "block"), ("example.net/en/x/", "block"), ("example.com", "allow"), ("b.org/fr/q", "block"), ("b.org/fr/qq", "allow"), ("a.b.org/", "block")]
    hosts = ["example.net", "a.example.net", "x.a.example.net", "notexample.net", "example.com", "www.example.com", "b.org", "a.b.org", "zb.org", "net", "localhost", "", "a..net", "EXAMPLE.com"]
    paths = ["", "/", "/en/", "/en/x/y", "/de/1", "/de", "/fr/q", "/fr/qqz", "/fr/", "/EN/", "/en/?a=/de/", "?x://y/", "#t", "/é"]
    urls = [f"{rng.choice(['http', 'https', 'x'])}://{rng.choice(hosts)}{rng.choice(paths)}" for _ in range(400)] + [None, "", "nothing", "://", "a://b://c/d", "http://h\nost.net/"]
    rows = list(enumerate(urls)) + [(0, urls[0]), (None, urls[1])]
    df = spark.createDataFrame(rows, "page_id long, url string")
    got = sorted((tuple(r) for r in url_filter.filter_urls(df, rules).collect()), key=str)
    assert got == sorted(((i, *url_want(u, rules)) for i, u in rows), key=str)
    assert {r["verdict"] for r in url_filter.filter_urls(df, [], "block").collect()} == {"block"} and url_filter.filter_urls(df.where("false"), rules).count() == 0


def test_broken_and_very_long_urls(spark):
    """A host of ten thousand dots is as many rows in the sweep as rules have depths."""
    rules = [("net/", "block"), ("example.net/en/", "allow"), ("a.b.c.d.net/", "block")]
    urls = ["http://" + "." * 10_000 + "net/x", "http://" + "a." * 5_000 + "example.net/en/" + "y" * 50_000, "http://localhost/", "http://.", None]
    got = sorted(tuple(r) for r in url_filter.filter_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules).collect())
    assert got == [(i, *url_want(u, rules)) for i, u in enumerate(urls)]


def test_many_nested_rules(spark):
    rules = [("h.org/" + "a" * k, "block" if k % 2 else "allow") for k in range(60)]
    df = spark.createDataFrame([(k, f"http://x.h.org/{'a' * k}b") for k in range(70)], "page_id long, url string")
    got = {r["page_id"]: r["rule"] for r in url_filter.filter_urls(df, rules).collect()}
    assert got == {k: "h.org/" + "a" * min(k, 59) for k in range(70)}


# -- sharding


@pytest.mark.parametrize("n", [1, 8, 500])
def test_shards(spark, n):
    rng = random.Random(n)
    docs = [(i * 3, rng.choice([None, "", "é" * rng.randrange(200), "x" * rng.randrange(3000)])) for i in range(400)] + [(0, "dup"), (None, "null key")]
    rng.shuffle(docs)
    got = sharding.shard_by_bytes(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), n).collect()
    size = lambda t: len((t or "").encode()) + 1
    order = sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0, size(r[1]), zlib.crc32((r[1] or "").encode())))
    total, at, want, seen = sum(size(t) for _, t in docs), 0, [], Counter()
    for d, t in order:
        s = min(n - 1, at * n // total)
        want.append((d, size(t), zlib.crc32((t or "").encode()), "bytes", s, seen[s], None))
        seen[s] += 1
        at += size(t)
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_shards_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert sharding.shard_by_bytes(docs).count() == 0
    with pytest.raises(ValueError):
        sharding.shard_by_bytes(docs, 0)


# -- queries and pipeline


def test_scratch_is_shared(spark):
    s = Scratch(spark, "t")
    assert s.table(spark.range(3), "x").count() == 3
    s.drop("x")


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_next_to_sql(spark, sf_dir, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df = queries.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    rel = con.sql(queries.ORACLE_SQL[name])
    assert sorted(rel.columns) == columns
    at = [rel.columns.index(c) for c in columns]
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str) == sorted((tuple(r[i] for i in at) for r in rel.fetchall()), key=str)


def test_pipeline(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = [docs.count()]
    scratch = Scratch(spark, "test-pipeline")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf_dir)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            docs = scratch.table(out, f"s{k}")
            kept.append(docs.count())
            assert docs.where("n_chars <> length(text)").count() == 0 or k < 3
    assert kept[0] > kept[1] > 0 and kept[1] >= kept[2] >= kept[3] == kept[4]
    packed = out.groupBy("sequence_id").agg({"length": "sum"}).toDF("s", "n")
    assert packed.where("n > 4096").count() == 0 and out.select("doc_id").distinct().count() == kept[-1]
    n = out.count()  # the next run removes the working tables of this one
    assert corpus_pipeline.run(spark, sf_dir).count() == n


def test_words_are_cut_before_signs_and_matched_pieces_give_the_same_best():
    enc, rng = sentencepiece_nbest.Encoder(PIECES, 4), random.Random(3)
    m = enc.model
    assert m.words("▁the▁cat,▁(sat)▁on▁▁it's.\n▁x!!y") == ["▁the", "▁cat", ",", "▁(sat", ")", "▁on", "▁▁it", "'s", ".", "\n", "▁x", "!!y"]
    for _ in range(300):
        text = "".join(rng.choice("thean▁\n,.!'—²漢😀") for _ in range(rng.randint(1, 14)))
        assert "".join(m.words(text)) == text
        assert m.best(text) == m._best_with_bytes(text)
        assert enc.nbest_of(text) == [(s, struct.pack(f"<{len(i)}I", *i)) for s, i in m.nbest(text, 4)]

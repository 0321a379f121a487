"""Token ids by a public vocabulary file, with a bounded cache of words.

Both the normaliser and the splitting pattern of the vocabularies used here treat white space as a border that no
piece crosses, so a text's ids are those of its parts between ASCII white space, one after another. The parts repeat, and
a bounded cache in each Python worker encodes most of them once and is asked once a block of texts. `check_border_safe` verifies this for the vocabulary
file at hand; a file that fails it is encoded whole.
"""

from __future__ import annotations

import gc
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import claim

#: Parts of a generation of a worker's cache; 250,000 take a quarter less time and up to 300 MB more a worker.
CACHE_PARTS = 120_000
#: ASCII marks that may follow a word.
MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum())
COMBINING = re.compile("[\u0300-\u036f\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20ff\ufe20-\ufe2f]")
#: How byte-level vocabularies write each byte but the space, which parts words here.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_CHARS = {b: b for b in _SHOWN} | {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _SHOWN)} | {32: 32}
SEPARATE = ("WhitespaceSplit", "BertPreTokenizer", "Whitespace")


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def check_border_safe(spec: dict) -> bool:
    """Whether no piece of this tokenizer reaches over white space."""
    pre = spec.get("pre_tokenizer") or {}
    steps = pre.get("pretokenizers", [pre])
    first = steps[0] if steps else {}
    added = all(not any(c.isspace() for c in t["content"]) and not t.get("lstrip") and not t.get("rstrip") and not t.get("single_word") for t in spec.get("added_tokens", []))
    norms = spec.get("normalizer") or {}
    known = {"NFC", "Lowercase", "Replace"}
    plain = all(n["type"] in known and (n["type"] != "Replace" or n["pattern"].get("Regex") == r"\s+") for n in norms.get("normalizers", [norms] if norms else []))
    splits = first.get("type") in SEPARATE or (first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") is True and " ?" not in first["pattern"].get("Regex", " ?") and r"\s+" not in first["pattern"].get("Regex", r"\s+"))
    return added and plain and splits and not any(s.get("add_prefix_space") for s in steps)


def id_type(path: str) -> np.dtype:
    """The least unsigned type, of two or four bytes, for the ids of a vocabulary file."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    most = max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec.get("added_tokens", []))], default=0)
    return np.dtype("<u2") if most < 1 << 16 else np.dtype("<u4")


class Encoder:
    """encode_many(texts) gives each text's ids as a numpy array of the least unsigned type that holds every id.

    Parts of texts are cached in two generations: a full young one becomes the old one, from which parts that come
    again are taken back, so frequent words stay and memory is bounded. Parts that are new are encoded together. A new part of Latin
    letters, alone or before ASCII marks, is a word or a word and its marks; many words are encoded as one text, whose
    ids are parted at the vocabulary's word ends, and as many ends as words must come back.
    """

    def __init__(self, path: str, parts: int | None = None):
        for name, value in (("RAYON_NUM_THREADS", "1"), ("TOKENIZERS_PARALLELISM", "false")):  # a task has one core
            os.environ.setdefault(name, value)
        from tokenizers import Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.parts = parts or CACHE_PARTS
        self._tok = Tokenizer.from_file(path)
        self.size = self._tok.get_vocab_size(with_added_tokens=True)
        self.dtype = id_type(path)
        self._by_part = check_border_safe(spec)
        norms = spec.get("normalizer") or {}
        self._lower = any(n["type"] == "Lowercase" for n in norms.get("normalizers", [norms] if norms else []))
        suffix = spec["model"].get("end_of_word_suffix") or ""
        self._ends = np.zeros(self.size, bool)
        if suffix:
            self._ends[[i for piece, i in spec["model"]["vocab"].items() if piece.endswith(suffix)]] = True
        byte_level = any(x.get("type") == "ByteLevel" for x in (spec.get("pre_tokenizer") or {}).get("pretokenizers", [spec.get("pre_tokenizer") or {}]))
        if self._ends.any():
            # The same model for words alone: spaces part them, and nothing is left to normalise. Bytes become characters before.
            self._plain = Tokenizer.from_file(path)
            self._plain.normalizer = None
            self._plain.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
            self._chars = BYTE_CHARS if byte_level else None
            if not self._lower:
                self._ends[:] = False
        self._marks = self._own_marks([t["content"] for t in spec.get("added_tokens", [])])
        self._young: dict[bytes, bytes] = {b"": b""}
        self._old: dict[bytes, bytes] = {}

    def _own_marks(self, added: list[str]) -> bytes:
        """The marks whose runs this vocabulary encodes apart from a word before them; none if a special token may be a word and marks."""
        if any(_is_word(t.encode().rstrip(MARKS) or b"a") for t in added):
            return b""
        runs = [r for m in MARKS for r in (chr(m), chr(m) * 2)]
        word, *ids = self._batch(["ab", *runs, *("ab" + r for r in runs)])
        good = [word + one == two for one, two in zip(ids[: len(runs)], ids[len(runs) :], strict=True)]
        return bytes(m for m, a, b in zip(MARKS, good[::2], good[1::2], strict=True) if a and b)

    def _batch(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype=self.dtype).tobytes() for e in self._tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[bytes]) -> list[bytes]:
        """Each word's ids; words are Latin letters only. A few thousand go as one text, without the steps that do nothing to lower-case letters."""
        found = []
        if self._ends.any():
            texts = [b" ".join(words[i : i + 2000]).decode().lower() for i in range(0, len(words), 2000)]
            if self._chars:
                texts = [t.encode().decode("latin-1").translate(self._chars) for t in texts]
            found = self._plain.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.array([i for e in found for i in e.ids], dtype=self.dtype)
        cuts = (np.flatnonzero(self._ends[ids]) + 1) * self.dtype.itemsize
        if len(cuts) != len(words):
            return self._batch([w.decode("utf-8", "surrogatepass") for w in words])
        raw, starts = ids.tobytes(), [0, *cuts.tolist()]
        return [raw[i:j] for i, j in zip(starts, starts[1:], strict=False)]

    def _learn(self, parts: set[bytes]) -> None:
        """Put the ids of parts that the young generation lacks into it."""
        young, old = self._young, self._old
        young.update([(p, old[p]) for p in parts.intersection(old)])
        parts = parts.difference(old)
        words = set(filter(bytes.isalpha, parts))
        marked, rest, marks = [], [], set()
        for p in parts.difference(words):
            if p[-1] in self._marks and _is_word(w := p.rstrip(self._marks)):
                mark = p[len(w) :]
                marked.append((p, w, mark))
                marks.add(mark)
                if w in old:
                    young[w] = old[w]
                elif w not in young:
                    words.add(w)
            elif _is_word(p):
                words.add(p)
            else:
                rest.append(p)
        new = list(words)
        young.update(zip(new, self._words(new), strict=True))
        rest += marks.difference(young)
        young.update(zip(rest, self._batch([r.decode("utf-8", "surrogatepass") for r in rest]), strict=True))
        for p, w, mark in marked:
            young[p] = young[w] + young[mark]

    def _raw(self, text: str | None) -> bytes:
        """The text in UTF-8. A-Z are lowered here where the vocabulary does it and no combining mark follows."""
        if not text:
            return b""
        raw = text.encode("utf-8", "surrogatepass")
        if self._lower and (len(raw) == len(text) or not COMBINING.search(text)):
            raw = raw.lower()
        return raw

    def encode_many(self, texts: list[str | None], block: int = 500) -> Iterator[np.ndarray]:
        for at in range(0, len(texts), block):
            some = texts[at : at + block]
            if not self._by_part:
                yield from (np.frombuffer(raw, self.dtype) for raw in self._batch([t or "" for t in some]))
                continue
            gc.disable()  # nothing here makes cycles, and there are many objects to look through
            try:
                made = self._block([self._raw(t) for t in some])
            finally:
                gc.enable()
            yield from made

    def _block(self, raws: list[bytes]) -> list[np.ndarray]:
        """The ids of texts that are cut at ASCII white space. Arrow cuts them and numbers their parts, so a part is looked up once a block."""
        if len(self._young) > self.parts:
            self._young, self._old = {b"": b""}, self._young
        young = self._young
        cut = pc.ascii_split_whitespace(pa.array(raws, pa.large_binary()).view(pa.large_string()))
        coded = cut.values.dictionary_encode()
        which = coded.indices.to_numpy()
        parts = coded.dictionary.view(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()
        self._learn(set(parts).difference(young))
        found = list(map(young.__getitem__, parts))
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // self.dtype.itemsize
        each = sizes[which]
        upto = np.concatenate([[0], np.cumsum(each)])
        shift = (np.cumsum(sizes) - sizes)[which] - upto[:-1]  # from a place among the ids here to that among the parts' ids
        at = np.repeat(shift, each)
        at += np.arange(len(at))
        ids = np.frombuffer(b"".join(found), self.dtype)[at]
        ends = upto[cut.offsets.to_numpy()].tolist()
        return [ids[i:j] for i, j in zip(ends, ends[1:], strict=False)]


def _is_word(part: bytes) -> bool:
    """Latin letters only, whose lower case is letters only too: the dotted capital I gets a combining mark."""
    if part.isascii():
        return part.isalpha()
    text = part.decode("utf-8", "surrogatepass")
    return text.isalpha() and max(text) < "\u0250" and "\u0130" not in text


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str, parts: int | None = None) -> Encoder:
    """The worker's encoder for this file, with so many parts a generation; its cache lives as long as the worker."""
    claim("tokens", _ENCODERS.clear)
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path, parts)
    _ENCODERS[path].parts = parts or CACHE_PARTS
    return _ENCODERS[path]


#: Rows, and bytes of texts, of an Arrow batch that are Python objects at one time.
SLICE, SLICE_BYTES = 500, 8 << 20


def _sizes(batch: pa.RecordBatch) -> np.ndarray:
    """Bytes of the texts of each row."""
    total = np.zeros(batch.num_rows, np.int64)
    for c in batch.columns:
        if pa.types.is_string(c.type) or pa.types.is_binary(c.type) or pa.types.is_large_string(c.type) or pa.types.is_large_binary(c.type):
            total += pc.fill_null(pc.binary_length(c), 0).to_numpy(zero_copy_only=False)
    return total


def slices(batches: Iterator, rows: int = SLICE, size: int = SLICE_BYTES) -> Iterator:
    """Arrow batches in slices of some rows and bytes, or of one longer row, so that a worker never holds a whole batch as Python objects."""
    for b in batches:
        upto = np.cumsum(_sizes(b))
        at = 0
        while at < b.num_rows:
            most = int(np.searchsorted(upto, (upto[at - 1] if at else 0) + size, "right"))
            to = max(at + 1, min(at + rows, most))
            yield b.slice(at, to - at)
            at = to


def each_text(batches: Iterator, columns: tuple[str, ...], rows: int = SLICE) -> Iterator[list]:
    """The named columns of slices of Arrow batches as Python lists."""
    for b in slices(batches, rows):
        yield [b.column(c).to_pylist() for c in columns]

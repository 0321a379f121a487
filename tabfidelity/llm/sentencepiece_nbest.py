"""SentencePiece encoding and decoding with the N best segmentations.

The lattice of a text has an edge for each vocabulary piece that matches at a character, and for a character that no
piece covers, one edge of its UTF-8 byte pieces. A forward Viterbi pass gives every node the best score of reaching it, and the edge
by which it is reached. These scores are the exact cost of what is left for a search that walks back from the end, so A*
takes complete paths off its queue in order of their scores, and stops after N. The step whose cost equals that of the path in hand is
taken at once, so each path taken off the queue is a whole one, and the queue never holds more than the paths that are still asked for.

Equal scores are ordered by their pieces' ids, at every size: the forward pass keeps, of equal edges, the one whose path has the least ids, and
equal paths on the queue are told apart where they part. The paths of the forward pass are a tree, and where two of them part
is found with one jump pointer a node, so a line of one character a hundred thousand times costs what its length asks for.

No piece reaches over two neighbours that stand side by side in no piece, so a text's lattice is a chain of smaller ones:
of words, which start at space marks (checked when a model is loaded; a model without this has its texts searched
whole) and at signs that no piece has after a letter, and of segments in words. A forward pass with the two best scores of each node gives a segment's best path and the
loss of its next one, once while a bounded cache holds it. The N best of a chain are among the sums of its parts' N best, and only
the N - 1 parts with the least first losses can matter: for these alone A* is run. Of parts with equal first losses, those matter whose change
moves the ids down and that stand first, and those whose change moves the ids up and that stand last.

Scores of a BPE model are its merge ranks; the best path is then the best by that sum, which isn't always that of its merges. Pieces of
no use in a text (control, unknown, unused, byte) match nothing in the lattice but the byte edges above.

Defined results: a null or empty text has one segmentation without pieces and score 0; a text with fewer than N
segmentations has all of them; repeated rows are encoded each; an empty table gives no rows; extra columns are not carried.
"""

from __future__ import annotations

import heapq
import gc
import re
import struct
import zlib
from collections.abc import Callable, Iterator
from operator import add, itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import claim
from .tokens import each_text

MARK = "▁"
# Fixed values of the model format: kinds of pieces, and their type numbers.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BYTE_LOSS = -1e6
CACHE_WORDS = 300_000
INF = float("inf")
_FIRST_TWO = itemgetter(0, 1)


def _fields(buf: bytes) -> Iterator[tuple[int, object]]:
    """Number and value of each field of a message in the protocol buffers' wire format."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = buf[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(buf):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        elif kind == 2:
            n = varint()
            yield tag >> 3, buf[at : at + n]
            at += n
        else:
            n = {1: 8, 5: 4}[kind]
            yield tag >> 3, struct.unpack("<d" if n == 8 else "<f", buf[at : at + n])[0]
            at += n


class _Prefixes:
    """The best ways to the nodes of a lattice: a tree with an edge (start, ids, score) into each node, and a pointer that jumps up."""

    def __init__(self, n: int):
        self.edge: list = [None] * (n + 1)
        self.up, self.jump, self.depth = [0] * (n + 1), [0] * (n + 1), [0] * (n + 1)

    def add(self, j: int, edge: tuple) -> None:
        i = edge[0]
        self.edge[j], self.up[j], self.depth[j] = edge, i, self.depth[i] + 1
        far = self.jump[i]
        self.jump[j] = self.jump[far] if self.depth[i] - self.depth[far] == self.depth[far] - self.depth[self.jump[far]] else i

    def _lift(self, a: int, depth: int) -> int:
        while self.depth[a] > depth:
            a = self.jump[a] if self.depth[self.jump[a]] >= depth else self.up[a]
        return a

    def parted(self, i: int, x: tuple[int, ...], k: int, y: tuple[int, ...]) -> tuple[tuple[int, ...], tuple[int, ...]]:
        """The ids of the edges by which the way to i and on by x, and that to k and on by y, part."""
        if self.depth[i] > self.depth[k]:
            other, one = self.parted(k, y, i, x)
            return one, other
        if self.depth[k] > self.depth[i]:
            below = self._lift(k, self.depth[i] + 1)
            y, k = self.edge[below][1], self.up[below]
        if i == k:
            return x, y
        while self.up[i] != self.up[k]:
            i, k = (self.jump[i], self.jump[k]) if self.jump[i] != self.jump[k] else (self.up[i], self.up[k])
        return self.edge[i][1], self.edge[k][1]

    def before(self, i: int, x: tuple[int, ...], k: int, y: tuple[int, ...]) -> bool:
        one, other = self.parted(i, x, k, y)
        return one < other

    def offer(self, queue: list, new: tuple, room: int) -> None:
        """Put a path where it belongs in a queue of `room` paths."""
        at = len(queue)
        while at and self._sooner(new, queue[at - 1]):
            at -= 1
        if at < room:
            queue.insert(at, new)
            del queue[room:]

    def _sooner(self, a: tuple, b: tuple) -> bool:
        if a[0] != b[0]:
            return a[0] > b[0]
        one, other = self.parted(a[1], a[2], b[1], b[2])
        if one != other:
            return one < other
        p, q = a[3], b[3]  # the same way there: told apart by what follows
        while p is not q and p[0] == q[0]:
            p, q = p[1], q[1]
        return p is not q and p[0] < q[0]


class Model:
    """The pieces of a model file with the normaliser's settings that matter here."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            raw = f.read()
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.kinds: list[int] = []
        self.prefix, self.squeeze, rules = True, True, b""
        for number, value in _fields(raw):
            if number == 1:
                got = {1: b"", 2: 0.0, 3: NORMAL} | dict(_fields(value))
                self.pieces.append(got[1].decode())
                self.scores.append(got[2])
                self.kinds.append(got[3])
            elif number == 3:
                got = dict(_fields(value))
                self.prefix, self.squeeze, rules = bool(got.get(3, 1)), bool(got.get(4, 1)), got.get(2, b"")
        if rules:
            raise ValueError("models with a table of character rules are not read")
        self.ids = {p: i for i, p in enumerate(self.pieces) if self.kinds[i] in (NORMAL, USER)}
        self.byte_ids = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if self.kinds[i] == BYTE}
        self.unknown = next((i for i, k in enumerate(self.kinds) if k == UNKNOWN), 0)
        # By characters: what follows, and the ids and score of the piece that ends here, if one does.
        self.trie: dict[str, tuple] = {}
        for p, k in sorted(self.ids.items()):
            node = self.trie
            for c in p[:-1]:
                if c not in node:
                    node[c] = ({}, None, 0.0)
                node = node[c][0]
            node[p[-1]] = (node[p[-1]][0] if p[-1] in node else {}, (k,), self.scores[k])
        # All pieces that match in a text, by the place where they end, for texts whose characters are all pieces themselves.
        self._matches = ahocorasick.Automaton()
        for p, k in self.ids.items():
            self._matches.add_word(p, (len(p), self.scores[k], k))
        if self.ids:
            self._matches.make_automaton()
        self._covered = {p for p in self.ids if len(p) == 1}
        # Neighbours inside pieces: between other neighbours no piece reaches over.
        self.inside = {p[k : k + 2] for p in self.ids for k in range(len(p) - 1)}
        self.by_word = not any(x[0] != MARK and x[1] == MARK for x in self.inside)
        feed = not any("\n" in x for x in self.ids)
        # Signs that no piece has right after a character that is neither such a sign nor a mark: words are cut before a run of them.
        signs = {c for x in self.inside for c in x if not c.isalpha() and not c.isdecimal()} - {MARK, "\n"}
        while apart := {x[1] for x in self.inside if x[1] in signs and x[0] not in signs and x[0] != MARK}:
            signs -= apart
        self.signs = "".join(sorted(signs))
        word, line = f"[^{MARK}{re.escape(self.signs)}" + r"\n" * feed + "]", r"|\n" * feed
        run = f"[{re.escape(self.signs)}]"
        self._cut = re.compile(f"{MARK}+{run}*{word}*|{run}+{word}*|{word}+{line}" if signs else f"{MARK}+{word}*|{word}+{line}")
        # What a piece stands for, and those that need more than that: control pieces and bytes of longer characters.
        self._plain = [chr(int(p[3:5], 16)) if k == BYTE else p for p, k in zip(self.pieces, self.kinds, strict=True)]
        self._apart = np.array([k == CONTROL or k == BYTE and int(p[3:5], 16) > 127 for p, k in zip(self.pieces, self.kinds, strict=True)])

    def normalise(self, text: str | None) -> str:
        if not text:
            return ""
        if self.squeeze:
            text = " ".join(x for x in text.split(" ") if x)
        text = text.replace(" ", MARK)
        return MARK + text if self.prefix and text else text

    def bytes_of(self, char: str) -> tuple[tuple[int, ...], float]:
        """Ids and score of the edge for a character that no piece is."""
        raw = char.encode("utf-8", "surrogatepass")
        return tuple(self.byte_ids[b] for b in raw) if self.byte_ids else (self.unknown,), BYTE_LOSS * len(raw)

    def edges(self, text: str) -> list[list[tuple[int, tuple[int, ...], float]]]:
        """For each place where an edge ends: (start, ids, score) of each that ends there."""
        n = len(text)
        ends: list[list[tuple[int, tuple[int, ...], float]]] = [[] for _ in range(n + 1)]
        root = self.trie
        for i in range(n):
            node, j, single = root, i, False
            while j < n and (step := node.get(text[j])) is not None:
                node, ids, score = step
                j += 1
                if ids is not None:
                    ends[j].append((i, ids, score))
                    single = single or j == i + 1
            if not single:
                ends[i + 1].append((i, *self.bytes_of(text[i])))
        return ends

    def best(self, text: str) -> tuple[tuple[int, ...], float, float]:
        """The best ids of a lattice, their score, and the loss of the next best (infinite if there is none): the forward pass with two scores a node."""
        if not self._covered.issuperset(text):
            return self._best_with_bytes(text)
        n = len(text)
        # By the last character of a way; what is before the first character stands at the end, which is place -1.
        first, second, back = [-INF] * n + [0.0], [-INF] * (n + 1), [None] * n
        for j, (size, score, k) in self._matches.iter(text):  # whatever reaches a place before j has been seen
            i = j - size
            v = first[i] + score
            if v > first[j]:
                w = second[i] + score
                second[j] = first[j] if first[j] > w else w
                first[j], back[j] = v, (i, k)
            elif v > second[j]:
                second[j] = v
        top, next_ = first[n - 1], second[n - 1]
        if next_ >= top:
            return self._told_apart(text)
        way, j = [], n - 1
        while j >= 0:
            j, k = back[j]
            way.append(k)
        way.reverse()
        return tuple(way), top, top - next_

    def _told_apart(self, text: str) -> tuple[tuple[int, ...], float, float]:
        """Like best, for equal scores, which are told apart by ids."""
        (score, ids), *more = self.nbest(text, 2)
        return ids, score, score - more[0][0]

    def _best_with_bytes(self, text: str) -> tuple[tuple[int, ...], float, float]:
        """Like best, where some characters are no pieces."""
        n, root = len(text), self.trie
        first, second, back = [-INF] * (n + 1), [-INF] * (n + 1), [None] * (n + 1)
        first[0] = 0.0
        for i in range(n):  # whatever reaches i has been seen
            top, next_ = first[i], second[i]
            node, j, single = root, i, False
            while j < n and (step := node.get(text[j])) is not None:
                node, ids, score = step
                j += 1
                if ids is not None:
                    v = top + score
                    if v > first[j]:
                        second[j] = max(first[j], next_ + score)
                        first[j], back[j] = v, (i, ids)
                    else:
                        second[j] = max(second[j], v)
                    single = single or j == i + 1
            if not single:
                ids, score = self.bytes_of(text[i])
                j = i + 1
                if top + score > first[j]:
                    second[j] = max(first[j], next_ + score)
                    first[j], back[j] = top + score, (i, ids)
                else:
                    second[j] = max(second[j], top + score)
        if second[-1] >= first[-1]:
            return self._told_apart(text)
        way, j = [], n
        while j:
            j, ids = back[j]
            way.append(ids)
        return tuple(k for ids in reversed(way) for k in ids), first[-1], first[-1] - second[-1]

    def nbest(self, text: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The n best (score, ids) of one lattice, best first: Viterbi forward, A* backward."""
        if not text:
            return [(0.0, ())]
        ends = self.edges(text)
        best, tree = [0.0], _Prefixes(len(text))
        for j in range(1, len(text) + 1):
            top, edge = -INF, None
            for e in ends[j]:
                v = best[e[0]] + e[2]
                if v > top or v == top and tree.before(e[0], e[1], edge[0], edge[1]):
                    top, edge = v, e
            best.append(top)
            tree.add(j, edge)
        # Paths not taken yet, the next one first: (score, start and ids of the edge that parts it from a path taken, (ids, the rest) from there on).
        queue: list[tuple[float, int, tuple[int, ...], tuple | None]] = []
        out: list[tuple[float, tuple[int, ...]]] = []
        score, j, after, rest = best[-1], len(text), 0.0, None
        while True:
            # The path in hand: the forward pass's way to j, and `rest`, whose score is `after`.
            room = n - len(out) - 1
            v, tail, cost = j, rest, after
            while v:
                taken = tree.edge[v]
                for e in ends[v]:
                    if e is not taken:
                        f = cost + e[2] + best[e[0]]
                        if room and (len(queue) < room or f >= queue[-1][0]):
                            tree.offer(queue, (f, e[0], e[1], (e[1], tail), cost + e[2]), room)
                cost += taken[2]
                tail = (taken[1], tail)
                v = taken[0]
            ids: list[int] = []
            while tail is not None:
                ids += tail[0]
                tail = tail[1]
            out.append((score, tuple(ids)))
            if len(out) == n or not queue:
                return out
            score, j, _, rest, after = queue.pop(0)

    def words(self, text: str) -> list[str]:
        """The parts of a normalised text that no piece reaches over: marks and what follows them, signs and what follows them, and line feeds."""
        return self._cut.findall(text) if self.by_word else [text] if text else []

    def segments(self, word: str) -> list[str]:
        """A word cut wherever no piece reaches over."""
        inside = self.inside
        cuts = [k for k, two in enumerate(map(add, word, word[1:]), 1) if two not in inside]
        return [word[a:b] for a, b in zip([0, *cuts], [*cuts, len(word)])] if cuts else [word]

    def decode(self, ids: list[int] | np.ndarray) -> str:
        ids = np.asarray(ids, np.int64)
        if not self._apart[ids].any():
            text = "".join(map(self._plain.__getitem__, ids.tolist()))
        else:
            out, raw = [], bytearray()
            for i in ids.tolist():
                if self.kinds[i] == BYTE:
                    raw.append(int(self.pieces[i][3:5], 16))
                    continue
                if raw:
                    out.append(raw.decode("utf-8", "replace"))
                    raw.clear()
                if self.kinds[i] != CONTROL:
                    out.append(self.pieces[i])
            out.append(raw.decode("utf-8", "replace"))
            text = "".join(out)
        text = text.replace(MARK, " ")
        return text[1:] if self.prefix and text.startswith(" ") else text


#: The best ids of a word or segment as bytes, their score, and the least loss of another segmentation.
Best = tuple[bytes, float, float]
#: The n best of a word or segment: loss, ids as bytes, and the place among them by ids alone.
Options = list[tuple[float, bytes, int]]


def _moves(options: Options) -> tuple[bool, bool]:
    """Whether a change of least loss moves a part's ids down, and whether one moves them up."""
    least = [o[2] < options[0][2] for o in options[1:] if o[0] == options[1][0]]
    return any(least), not all(least)


def _chain(losses: tuple[float, ...], parts: list[str], options: Callable[[str], Options], n: int) -> list[tuple[float, tuple[int, ...], tuple[tuple[int, bytes], ...]]]:
    """The n best of a chain of parts, best first: (loss, what orders them by ids, (place, ids) of the parts that are not at their best).

    losses: each part's first loss. options: a part's n best.
    """
    every = np.array(losses)
    cut = np.partition(every, n - 2)[n - 2] if len(every) >= n else INF
    few = np.flatnonzero(every < cut).tolist()
    even = np.flatnonzero(every == cut).tolist() if cut < INF else []
    if len(few) + len(even) >= n:
        moves = {x: _moves(options(x)) for x in {parts[i] for i in even}}
        down = [i for i in even if moves[parts[i]][0]][: n - 1]
        even = list({*down, *[i for i in even if moves[parts[i]][1]][1 - n :]})
    sums: list[tuple[float, tuple[int, ...], tuple[tuple[int, bytes], ...]]] = [(0.0, (), ())]
    for i in sorted(few + even):
        (_, _, first), *others = options(parts[i])
        longer = [(loss, (*key, first), picks) for loss, key, picks in sums]
        longer += [(loss + o[0], (*key, o[2]), (*picks, (i, o[1]))) for loss, key, picks in sums for o in others]
        longer.sort(key=_FIRST_TWO)
        sums = longer[:n]
    return sums


class _Cache:
    """Two generations: a full young one becomes the old one, from which keys that come again are taken back."""

    def __init__(self, make, size: int):
        self.young: dict = {}
        self._old: dict = {}
        self._make, self._size = make, size

    def get(self, key: str):
        if (got := self.young.get(key)) is None:
            got = self._old.get(key)
            if got is None:
                got = self._make(key)
            if len(key) <= 64:
                self.young[key] = got
            if len(self.young) > self._size:
                self.young, self._old = {}, self.young
        return got

    def each(self, keys: list[str]) -> list:
        made = list(map(self.young.get, keys))
        if None in made:
            get = self.get
            made = [get(k) if f is None else f for k, f in zip(keys, made)]
        return made


class Encoder:
    def __init__(self, path: str, n: int):
        self.model, self.n = Model(path), n
        self._words, self._segments = _Cache(self._word, CACHE_WORDS), _Cache(self._segment, CACHE_WORDS)
        self._all, self._parts = _Cache(self._choices, CACHE_WORDS // 10), _Cache(self._segment_choices, CACHE_WORDS // 10)

    def _segment(self, segment: str) -> Best:
        ids, score, loss = self.model.best(segment) if segment else ((), 0.0, INF)
        return struct.pack(f"<{len(ids)}I", *ids), score, loss

    def _cut(self, word: str) -> list[str]:
        return self.model.segments(word) if self.model.by_word else [word]

    def _word(self, word: str) -> Best:
        segments = self._cut(word)
        if len(segments) == 1:
            return self._segment(word)
        ids, scores, losses = zip(*self._segments.each(segments))
        return b"".join(ids), sum(scores), min(losses)

    def _segment_choices(self, segment: str) -> Options:
        found = self.model.nbest(segment, self.n)
        place = {ids: k for k, ids in enumerate(sorted(ids for _, ids in found))}
        return [(found[0][0] - s, struct.pack(f"<{len(ids)}I", *ids), place[ids]) for s, ids in found]

    def _choices(self, word: str) -> Options:
        """A word's n best, which are among the sums of its segments' n best."""
        segments = self._cut(word)
        if len(segments) == 1:
            return self._segment_choices(word)
        ids, _, losses = zip(*self._segments.each(segments))
        found = _chain(losses, segments, self._parts.get, self.n)
        place = {key: k for k, key in enumerate(sorted(key for _, key, _ in found))}
        return [(loss, _swapped(ids, picks), place[key]) for loss, key, picks in found]

    def nbest(self, text: str | None) -> list[tuple[float, bytes]]:
        """(score, little-endian 32-bit ids) of the text's best segmentations, best first."""
        return self.nbest_of(self.model.normalise(text))

    def nbest_of(self, normal: str) -> list[tuple[float, bytes]]:
        words = self.model.words(normal)
        if not words:
            return [(0.0, b"")]
        ids, scores, losses = zip(*self._words.each(words))
        total = sum(scores)
        if self.n == 1:
            return [(total, b"".join(ids))]
        return [(total - loss, _swapped(ids, picks)) for loss, _, picks in _chain(losses, words, self._all.get, self.n)]


def _swapped(ids: tuple[bytes, ...], picks: tuple[tuple[int, bytes], ...]) -> bytes:
    if not picks:
        return b"".join(ids)
    swapped = list(ids)
    for i, other in picks:
        swapped[i] = other
    return b"".join(swapped)


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, n: int) -> Encoder:
    claim("sentencepiece", _ENCODERS.clear)
    if (path, n) not in _ENCODERS:
        _ENCODERS[path, n] = Encoder(path, n)
    return _ENCODERS[path, n]


NBEST = "doc_id long, rank int, score double, n_pieces long, ids_crc32 long, round_trip boolean"


def _digest(path: str, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, n)
        for keys, texts in each_text(batches, ("doc_id", "text")):
            rows = []
            gc.disable()  # nothing here makes cycles, and there are many objects to look through
            for key, text in zip(keys, texts, strict=True):
                normal = enc.model.normalise(text)
                want = normal.replace(MARK, " ")
                want = want[1:] if enc.model.prefix and want.startswith(" ") else want
                for rank, (score, ids) in enumerate(enc.nbest_of(normal)):
                    back = enc.model.decode(np.frombuffer(ids, "<u4")) == want if rank == 0 else None
                    rows.append((key, rank, score, len(ids) // 4, zlib.crc32(ids), back))
            gc.enable()
            types = [pa.int64(), pa.int32(), pa.float64(), pa.int64(), pa.int64(), pa.bool_()]
            cols = list(zip(*rows, strict=True)) or [()] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["doc_id", "rank", "score", "n_pieces", "ids_crc32", "round_trip"])

    return run


def encode_nbest(docs: DataFrame, model: str, n: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, rank and ids (array<int>), score: the n best segmentations of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(model, n)
        for keys, texts in each_text(batches, ("doc_id", "text")):
            rows = [(k, r, s, np.frombuffer(ids, "<i4")) for k, t in zip(keys, texts, strict=True) for r, (s, ids) in enumerate(enc.nbest(t))]
            cols = list(zip(*rows, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int64(), pa.int32(), pa.float64(), pa.list_(pa.int32())], strict=True)], names=["doc_id", "rank", "score", "ids"])

    return docs.select(docs[key].cast("long").alias("doc_id"), docs[text].cast("string").alias("text")).mapInArrow(run, "doc_id long, rank int, score double, ids array<int>")


def decode_ids(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id, rank and text of each row of ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = encoder(model, 1).model
        for b in batches:
            texts = [m.decode(x or []) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("rank"), pa.array(texts, pa.string())], names=["doc_id", "rank", "text"])

    return encoded.select("doc_id", "rank", "ids").mapInArrow(run, "doc_id long, rank int, text string")


def nbest_digests(docs: DataFrame, model: str, n: int = 4) -> DataFrame:
    """Each text's n best segmentations, digested, with the best decoded again and compared with the text."""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_digest(model, n), NBEST)

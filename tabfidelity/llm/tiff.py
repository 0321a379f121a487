"""TIFF media columns: a file's image directories become rows, one per page, with decoded samples.

The reader walks the chain of image directories of a classic or a big TIFF of either byte order, decodes strips or tiles that are stored
plain, as PackBits, LZW or deflate, and undoes horizontal (2) and floating-point (3) predictors. The writer makes
pages of 8-bit grey samples in any of these layouts.

Defined results: null or empty media give no pages from `tiff_pages`; bytes that are no TIFF, or whose directories or data
break off or make no sense, give one row for the page at fault, with `error` set and no samples, whatever the bytes. A page's size is held against
the bytes of its strips before anything is allocated, and one of more than 1 GiB of samples is at fault, as a row can't hold
more than 2. Other columns of the input are not carried; repeated rows are decoded each; an empty table gives no rows.

The query stores a text's bytes in the layout that their digest picks of `LAYOUTS`, so that every codec, predictor and layout is on its way
back.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, claim
from .tokens import each_text

# Fixed values of the file format: tags, codes of compression, and bytes of each field type.
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, STRIPS, SAMPLES, ROWS, STRIP_BYTES, PLANAR, PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILES, TILE_BYTES, FORMAT = 256, 257, 258, 259, 262, 273, 277, 278, 279, 284, 317, 322, 323, 324, 325, 339
PLAIN, LZW, DEFLATE, PACKBITS, OLD_DEFLATE = 1, 5, 8, 32773, 32946
FIELD = {1: "B", 2: "B", 3: "H", 4: "I", 6: "b", 7: "B", 8: "h", 9: "i", 11: "f", 12: "d", 13: "I", 16: "Q", 17: "q", 18: "Q"}


#: Bytes that a byte of compressed data becomes at most: a PackBits pair 128, an LZW code of 9 bits a whole string of 4096, a deflate block 1032.
MOST = {PLAIN: 1, PACKBITS: 64, LZW: 3641, DEFLATE: 1032, OLD_DEFLATE: 1032}
MOST_BYTES = 1 << 30


#: Two to 128 equal bytes.
REPEATS = re.compile(rb"(.)\1{1,127}", re.DOTALL)


class TiffError(ValueError):
    pass


#: What reading bytes that make no sense may raise.
BROKEN = (TiffError, struct.error, KeyError, IndexError, TypeError, ValueError, OverflowError, MemoryError)


def packbits_encode(data: bytes) -> bytes:
    out, at, n = bytearray(), 0, len(data)
    for start, end in chain((m.span() for m in REPEATS.finditer(data)), ((n, n),)):
        for i in range(at, start, 128):
            j = min(i + 128, start)
            out.append(j - i - 1)
            out += data[i:j]
        if end > start:
            out += bytes((257 - end + start, data[start]))
        at = end
    return bytes(out)


def packbits_decode(data: bytes, size: int) -> bytes:
    out, i = bytearray(), 0
    while len(out) < size and i < len(data):
        n = data[i]
        if n < 128:
            out += data[i + 1 : i + 2 + n]
            i += n + 2
        else:
            if n > 128:
                out += data[i + 1 : i + 2] * (257 - n)
            i += 1 + (n > 128)
    return bytes(out)


#: Bits of the k-th LZW code after a clearing one: as many as the code of the writer's next free entry needs, 12 at most.
LZW_BITS = np.array([9] * 254 + [10] * 512 + [11] * 1024 + [12] * 4096)
LZW_FULL = 254 + 512 + 1024
#: Codes that are unpacked at once.
LZW_BLOCK = 512


def lzw_encode(data: bytes) -> bytes:
    codes, table, size = [256], {}, 258
    if data:
        word = data[0]
        for x in data[1:]:
            longer = word << 8 | x
            code = table.get(longer)
            if code is not None:
                word = code
                continue
            codes.append(word)
            table[longer] = size
            size += 1
            word = x
            if size == 4094:
                codes.append(256)
                table.clear()
                size = 258
        codes.append(word)
    codes.append(257)
    c = np.array(codes)
    clears = np.flatnonzero(c == 256)
    place = np.arange(len(c))
    bits = LZW_BITS[place - np.append(0, clears + 1)[np.searchsorted(clears, place)]]
    each = np.unpackbits((c << 16 - bits).astype(">u2").view(np.uint8)).reshape(-1, 16)
    return np.packbits(each[np.arange(16) < bits[:, None]]).tobytes()


def lzw_decode(data: bytes, size: int) -> bytes:
    first = [bytes((i,)) for i in range(256)] + [b"", b""]
    table, out, total, last = list(first), [], 0, b""
    raw = np.frombuffer(data + b"\0\0\0", np.uint8).astype(np.uint32)
    at = k = 0  # the bit to read next, and codes since the table was cleared
    while total < size:
        bits = LZW_BITS[k : k + min(LZW_BLOCK, (8 * len(data) - at) // 9 + 1)]
        ends = at + np.cumsum(bits)
        n = int(np.searchsorted(ends, 8 * len(data), "right"))
        if not n:
            raise TiffError("LZW data break off")
        bits, ends = bits[:n], ends[:n]
        spot, shift = np.divmod(ends - bits, 8)
        codes = (raw[spot] << 16 | raw[spot + 1] << 8 | raw[spot + 2]) >> (24 - shift - bits) & (1 << bits) - 1
        signs = np.flatnonzero(codes >> 1 == 128)
        n = int(signs[0]) if len(signs) else n
        for code in codes[:n].tolist():
            try:
                word = table[code]
            except IndexError:
                if not last or code != len(table):
                    raise TiffError("LZW code out of range") from None
                word = last + last[:1]
            if last:
                table.append(last + word[:1])
            out.append(word)
            last = word
            total += len(word)
            if total >= size:
                break
        else:
            if not len(signs):
                at, k = int(ends[-1]), min(k + n, LZW_FULL)
            elif codes[n] == 257:
                break
            else:
                at, k, table, last = int(ends[n]), 0, list(first), b""
    return b"".join(out)


def _decode(kind: int, data: bytes, size: int) -> bytes:
    if kind == PLAIN:
        got = data
    elif kind == PACKBITS:
        got = packbits_decode(data, size)
    elif kind == LZW:
        got = lzw_decode(data, size)
    elif kind in (DEFLATE, OLD_DEFLATE):
        try:
            got = zlib.decompressobj().decompress(data, size) if size else b""
        except zlib.error as e:
            raise TiffError(str(e)) from None
    else:
        raise TiffError(f"compression {kind} is not known")
    if len(got) < size:
        raise TiffError("a strip or tile breaks off")
    return got[:size]


@dataclass
class Page:
    number: int
    width: int
    height: int
    samples: int
    bits: int
    compression: int
    predictor: int
    tiled: bool
    pixels: np.ndarray | None = None
    error: str | None = None


def _entries(buf: bytes, order: str, big: bool, at: int) -> tuple[dict[int, tuple], int]:
    count_fmt, entry, off, next_fmt = ("Q", 20, "Q", "Q") if big else ("H", 12, "I", "I")
    (n,) = struct.unpack_from(order + count_fmt, buf, at)
    at += struct.calcsize(count_fmt)
    inline = 8 if big else 4
    tags = {}
    for k in range(n):
        spot = at + k * entry
        tag, kind, count = struct.unpack_from(order + ("HHQ" if big else "HHI"), buf, spot)
        if kind not in FIELD:
            continue
        value = spot + entry - inline
        if count * struct.calcsize(FIELD[kind]) > inline:
            (value,) = struct.unpack_from(order + off, buf, value)
        if not count or value + count * struct.calcsize(FIELD[kind]) > len(buf):
            continue  # as good as absent
        tags[tag] = struct.unpack_from(f"{order}{count}{FIELD[kind]}", buf, value)
    (after,) = struct.unpack_from(order + next_fmt, buf, at + n * entry)
    return tags, after


def _unpredict(a: np.ndarray, kind: int, order: str) -> np.ndarray:
    if kind == 2:
        return np.cumsum(a, axis=1, dtype=a.dtype)
    if kind == 3:
        rows, width, samples = a.shape
        size = a.dtype.itemsize
        raw = np.cumsum(a.reshape(rows, width * samples).view(np.uint8).reshape(rows, size * width, samples), axis=1, dtype=np.uint8).reshape(rows, size, width * samples)
        return np.ascontiguousarray(raw.transpose(0, 2, 1)).view(f">f{size}").reshape(rows, width, samples)
    return a


def _pixels(buf: bytes, tags: dict[int, tuple], order: str, p: Page) -> np.ndarray:
    if p.bits not in (8, 16, 32, 64) or len(set(tags.get(BITS, (1,)))) > 1:
        raise TiffError(f"{tags.get(BITS)} bits a sample are not read")
    kind = {1: "u", 2: "i", 3: "f"}.get(tags.get(FORMAT, (1,))[0], "u")
    if p.predictor not in (1, 2, 3) or (p.predictor == 3) > (kind == "f") or kind == "f" and (p.bits == 8 or p.predictor == 2):
        raise TiffError(f"predictor {p.predictor} of {p.bits} bits of format {kind} is not read")
    dtype = np.dtype(f"{order}{kind}{p.bits // 8}" if p.bits > 8 else f"{kind}1")
    planes, depth = (p.samples, 1) if tags.get(PLANAR, (1,))[0] == 2 else (1, p.samples)
    if p.tiled:
        tw, th, starts, sizes = tags[TILE_WIDTH][0], tags[TILE_HEIGHT][0], tags[TILES], tags[TILE_BYTES]
    else:
        tw, th = p.width, min(tags.get(ROWS, (p.height,))[0], p.height)
        starts, sizes = tags[STRIPS], tags[STRIP_BYTES]
    if tw < 1 or th < 1:
        raise TiffError("a strip or tile has no size")
    across, down = -(-p.width // tw), -(-p.height // th)
    if len(starts) < across * down * planes or len(sizes) < across * down * planes:
        raise TiffError("strips or tiles are missing")
    starts, sizes = starts[: across * down * planes], sizes[: across * down * planes]
    if p.compression not in MOST:
        raise TiffError(f"compression {p.compression} is not known")
    if sum(sizes) > len(buf):
        raise TiffError("strips or tiles lie over each other")
    held = p.height * p.width * p.samples * dtype.itemsize
    if held > MOST_BYTES or held > sum(sizes) * MOST[p.compression] or tw * th * depth * dtype.itemsize > MOST_BYTES:
        raise TiffError(f"{p.width} x {p.height} samples are not in {sum(sizes)} bytes")
    out = np.zeros((p.height, p.width, p.samples), dtype.newbyteorder("="))
    for i in range(across * down * planes):
        plane, k = divmod(i, across * down)
        y, x = k // across * th, k % across * tw
        rows = th if p.tiled else min(th, p.height - y)
        if starts[i] + sizes[i] > len(buf):
            raise TiffError("a strip or tile lies beyond the end")
        block = _decode(p.compression, buf[starts[i] : starts[i] + sizes[i]], rows * tw * depth * dtype.itemsize)
        a = _unpredict(np.frombuffer(block, dtype).reshape(rows, tw, depth), p.predictor, order)
        h, w = min(rows, p.height - y), min(tw, p.width - x)
        out[y : y + h, x : x + w, plane if planes > 1 else slice(None)] = a[:h, :w, 0] if planes > 1 else a[:h, :w]
    return out


def read_pages(buf: bytes | None) -> Iterator[Page]:
    """The pages of a file in the order of its directories."""
    if not buf:
        return
    number = 0
    try:
        order = {b"II": "<", b"MM": ">"}.get(bytes(buf[:2]))
        if order is None:
            raise TiffError("not a TIFF")
        (magic,) = struct.unpack_from(order + "H", buf, 2)
        if magic not in (42, 43):
            raise TiffError("not a TIFF")
        (at,) = struct.unpack_from(order + ("I" if magic == 42 else "Q"), buf, 4 if magic == 42 else 8)
        seen = set()
        while at:
            if at in seen:
                raise TiffError("the directories form a ring")
            seen.add(at)
            tags, at = _entries(buf, order, magic == 43, at)
            yield _page(buf, tags, order, number)
            number += 1
    except BROKEN as e:
        yield Page(number, 0, 0, 0, 0, 0, 0, False, None, str(e) or type(e).__name__)


def _page(buf: bytes, tags: dict[int, tuple], order: str, number: int) -> Page:
    head = [tags.get(t, (d,))[0] for t, d in ((WIDTH, 0), (HEIGHT, 0), (SAMPLES, 1), (BITS, 1), (COMPRESSION, PLAIN), (PREDICTOR, 1))]
    if not all(isinstance(x, int) and 0 < x < 1 << 31 for x in head):
        return Page(number, 0, 0, 0, 0, 0, 0, False, None, "a page has no size, or its numbers make no sense")
    p = Page(number, *head, TILES in tags)
    try:
        p.pixels = _pixels(buf, tags, order, p)
    except BROKEN as e:
        p.error = str(e) or type(e).__name__
    return p


def write_tiff(pages: list[np.ndarray], compression: int = DEFLATE, predictor: int = 1, tile: int | None = None, rows_per_strip: int | None = None, order: str = "<") -> bytes:
    """A classic TIFF with one page of 8-bit grey samples per array of height x width. tile, if set, is a multiple of 16."""
    out = bytearray(struct.pack(order + "2sHI", b"II" if order == "<" else b"MM", 42, 0))
    link = 4
    for a in pages:
        h, w = a.shape
        if tile:
            whole = np.pad(a, ((0, -h % tile), (0, -w % tile)))
            blocks = [whole[y : y + tile, x : x + tile] for y in range(0, h, tile) for x in range(0, w, tile)]
        else:
            step = rows_per_strip or h
            blocks = [a[y : y + step] for y in range(0, h, step)]
        starts, sizes = [], []
        for b in blocks:
            if predictor == 2:
                b = np.hstack((b[:, :1], b[:, 1:] - b[:, :-1]))
            raw = np.ascontiguousarray(b).tobytes()
            data = {PLAIN: lambda r: r, PACKBITS: packbits_encode, LZW: lzw_encode, DEFLATE: lambda r: zlib.compress(r, 1)}[compression](raw)
            starts.append(len(out))
            sizes.append(len(data))
            out += data + b"\0" * (len(data) % 2)
        tags = [(WIDTH, w), (HEIGHT, h), (BITS, 8), (COMPRESSION, compression), (PHOTOMETRIC, 1), (SAMPLES, 1)]
        tags += [(TILE_WIDTH, tile), (TILE_HEIGHT, tile), (TILES, starts), (TILE_BYTES, sizes)] if tile else [(STRIPS, starts), (ROWS, rows_per_strip or h), (STRIP_BYTES, sizes)]
        tags += [(PREDICTOR, predictor)] * (predictor != 1)
        entries = b""
        for tag, value in sorted(tags):
            values = value if isinstance(value, list) else [value]
            kind = 3 if tag in (BITS, COMPRESSION, PHOTOMETRIC, SAMPLES, PREDICTOR) else 4
            packed = struct.pack(f"{order}{len(values)}{FIELD[kind]}", *values)
            if len(packed) > 4:
                spot = len(out)
                out += packed
                packed = struct.pack(order + "I", spot)
            entries += struct.pack(order + "HHI", tag, kind, len(values)) + packed.ljust(4, b"\0")
        out += b"\0" * (len(out) % 2)
        struct.pack_into(order + "I", out, link, len(out))
        out += struct.pack(order + "H", len(tags)) + entries
        link = len(out)
        out += b"\0\0\0\0"
    return bytes(out)


def _digest_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for keys, media in each_text(batches, ("doc_id", "media")):
        rows = [(k, p.number, p.width, p.height, p.samples, p.bits, p.compression, p.predictor, p.tiled, None if p.pixels is None else p.pixels.tobytes(), p.error) for k, m in zip(keys, media, strict=True) for p in read_pages(m)]
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.binary(), pa.string()]
        cols = list(zip(*rows, strict=True)) or [()] * len(types)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["doc_id", "page", "width", "height", "samples", "bits", "compression", "predictor", "tiled", "pixels", "error"])


PAGE = "doc_id long, page int, width long, height long, samples int, bits int, compression int, predictor int, tiled boolean, pixels binary, error string"


def tiff_pages(media: DataFrame, key: str = "doc_id", column: str = "media") -> DataFrame:
    """A row per page of each media value, with its samples in row order."""
    return media.select(media[key].cast("long").alias("doc_id"), media[column].alias("media")).mapInArrow(_digest_pages, PAGE)


UNIT, WIDE, TALL, STRIP, TILE = 576, 576, 64, 16, 16
#: Compression, predictor, and whether pages of TILE rows and more are cut into tiles.
LAYOUTS = [(kind, predictor, tiled) for kind in (PLAIN, PACKBITS, LZW, DEFLATE) for predictor in (1, 2) for tiled in (False, True)]


def layout_of(payload: bytes, height: int) -> dict:
    """How the pages of a payload are stored; equal payloads are stored alike."""
    kind, predictor, tiled = LAYOUTS[hashlib.sha256(payload).digest()[0] % len(LAYOUTS)]
    return {"compression": kind, "predictor": predictor} | ({"tile": TILE} if tiled and height >= TILE else {"rows_per_strip": STRIP})


def _encode_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Payloads as pages of WIDE x up to TALL samples."""
    claim("tiff")
    for keys, texts in each_text(batches, ("doc_id", "text")):
        media, lengths = [], []
        for text in texts:
            raw = (text or "").encode()
            lengths.append(len(raw))
            payload = raw + b"\xff" * (-len(raw) % UNIT or (0 if raw else UNIT))
            rows = np.frombuffer(payload, np.uint8).reshape(-1, WIDE)
            media.append(write_tiff([rows[y : y + TALL] for y in range(0, len(rows), TALL)], **layout_of(payload, len(rows))))
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(lengths, pa.int64()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])


def texts_to_tiff(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes and media: each text's bytes, padded with 255 to a positive multiple of 576, as grey pages."""
    return docs.select(docs[key].cast("long").alias("doc_id"), docs[text].cast("string").alias("text")).mapInArrow(_encode_texts, "doc_id long, n_bytes long, media binary")


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for keys, sizes, media in each_text(batches, ("doc_id", "n_bytes", "media")):
        rows = []
        for key, n, m in zip(keys, sizes, media, strict=True):
            pages = list(read_pages(m))
            if bad := next((p.error for p in pages if p.error), None):
                raise TiffError(bad)
            payload = b"".join(p.pixels.tobytes() for p in pages)
            counts = np.bincount(np.frombuffer(payload, np.uint8), minlength=256)
            share = counts[counts > 0] / len(payload)
            mean = float(counts @ np.arange(256)) / len(payload)
            feature = f"pages={len(pages)};mean={mean:.4f};entropy={-(share * np.log2(share)).sum():.4f};levels={len(share)}"
            rows.append((key, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(m), hashlib.sha256(m).hexdigest(), feature))
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        cols = list(zip(*rows, strict=True)) or [()] * len(types)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])


def media_digests(docs: DataFrame) -> DataFrame:
    """Stores each text as TIFF, reads the stored bytes back and digests what was decoded."""
    scratch = Scratch(docs.sparkSession, "tiff")
    stored = scratch.table(texts_to_tiff(docs), "media", compression="zstd")  # some layouts are plain
    return stored.mapInArrow(_features, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")

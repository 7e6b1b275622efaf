"""GIF media columns: LZW code streams, palettes, disposal, transparency, timed frames, colour histograms.

``store`` keeps a text's UTF-8 bytes as the palette indices of a GIF, ``decode`` reads any GIF back, and
``frames`` explodes a binary column of GIFs to one row per composited frame. Everything is row-wise
(``mapInArrow``): no shuffle, memory bounded by an Arrow batch.

Defined results: null text = empty text (64 zero bytes are stored); an empty or broken GIF yields no frames and its
``error``; equal texts give equal rows; null and repeated ids are kept as they come; extra columns of the input are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import documents

#: Width of the stored image and rows of one frame: a frame holds at most 64 x 1024 samples.
WIDTH, ROWS, DELAY_CS = 64, 1024, 10
MAX_CODE = 4096
#: Larger canvases and frames are refused as broken: a header of a few bytes can claim 4 billion pixels.
MAX_PIXELS = 1 << 24


def _widths(n: int, min_bits: int) -> np.ndarray:
    """Bits of the i-th code after a clear code, as a decoder knows them: an entry is added from the second code on."""
    size = (1 << min_bits) + 2 + np.maximum(np.arange(n) - 1, 0)
    return np.clip(np.floor(np.log2(size)).astype(np.int64) + 1, min_bits + 1, 12)


_W8 = _widths(MAX_CODE + 2, 8)


def lzw_encode(data: bytes, min_bits: int = 8) -> bytes:
    """GIF LZW: clear code, codes of growing width, end code. The table is cleared when it is full."""
    clear = 1 << min_bits
    codes: list[int] = [clear]
    starts = [1]  # index of the first code after each clear
    table: dict[int, int] = {}
    get, put = table.get, codes.append
    nxt = clear + 2
    if data:
        w = data[0]
        for b in data[1:]:
            key = w << 8 | b
            c = get(key)
            if c is not None:
                w = c
            else:
                put(w)
                w = b
                if nxt < MAX_CODE:
                    table[key] = nxt
                    nxt += 1
                else:
                    put(clear)
                    starts.append(len(codes))
                    table.clear()
                    nxt = clear + 2
        put(w)
    put(clear + 1)
    arr = np.array(codes, dtype=np.int64)
    at = np.array(starts)
    idx = np.arange(len(arr)) - np.repeat(np.r_[0, at], np.diff(np.r_[0, at, len(arr)]))
    idx[0] = 0
    per = _W8 if min_bits == 8 else _widths(MAX_CODE + 2, min_bits)
    width = per[np.minimum(idx, len(per) - 1)]
    bits = (arr[:, None] >> np.arange(12)) & 1
    return np.packbits(bits[np.arange(12) < width[:, None]].astype(np.uint8), bitorder="little").tobytes()


def lzw_decode(stream: bytes, min_bits: int, expect: int) -> bytes:
    """Decode a GIF LZW stream to at most ``expect`` bytes; a code beyond the table is an error."""
    clear, end = 1 << min_bits, (1 << min_bits) + 1
    raw = np.frombuffer(stream + b"\0" * 4, dtype=np.uint8).astype(np.uint32)
    total_bits = len(stream) * 8
    per = _W8 if min_bits == 8 else _widths(MAX_CODE + 2, min_bits)
    offset = np.r_[0, np.cumsum(per)]
    base = [bytes([i]) for i in range(clear)] + [b"", b""]
    out: list[bytes] = []
    size, bit, table, prev, n = 0, 0, list(base), b"", 0  # n: codes since the last clear
    while size < expect and bit + min_bits + 1 <= total_bits:
        if n < len(per):
            k = len(per) - n
            pos = bit + offset[n : n + k] - offset[n]
            width = per[n:]
        else:
            k = 4096
            pos = bit + 12 * np.arange(k)
            width = np.full(k, 12)
        fits = int(np.searchsorted(pos + width, total_bits, side="right"))
        if not fits:
            break
        pos, width = pos[:fits], width[:fits]
        at = pos >> 3
        word = raw[at] | raw[at + 1] << 8 | raw[at + 2] << 16
        codes = (word >> (pos & 7).astype(np.uint32)) & ((1 << width) - 1).astype(np.uint32)
        stops = np.flatnonzero((codes == clear) | (codes == end))
        stop = int(stops[0]) if len(stops) else fits
        for c in codes[:stop].tolist():
            if n:
                if c < len(table):
                    s = table[c]
                elif c == len(table) and c < MAX_CODE:
                    s = prev + prev[:1]
                else:
                    raise ValueError(f"LZW code {c} beyond the table of {len(table)}")
                if len(table) < MAX_CODE:
                    table.append(prev + s[:1])
            elif c < clear:
                s = base[c]
            else:
                raise ValueError(f"LZW stream begins with code {c}")
            out.append(s)
            size += len(s)
            prev = s
            n += 1
        if stop < fits:
            bit = int(pos[stop] + width[stop])
            if codes[stop] == end:
                break
            table, prev, n = list(base), b"", 0
        else:
            bit = int(pos[-1] + width[-1])
    return b"".join(out)[:expect]


@dataclass
class Frame:
    index: np.ndarray  # palette indices of the frame's own rectangle, rows x columns
    canvas: np.ndarray  # RGBA of the whole image after this frame is drawn
    delay_ms: int
    left: int
    top: int


_GREY = bytes(v for i in range(256) for v in (i, i, i))


def _blocks(data: bytes) -> bytes:
    return b"".join(bytes([len(data[i : i + 255])]) + data[i : i + 255] for i in range(0, len(data), 255)) + b"\0"


def encode_gif(samples: bytes, width: int = WIDTH, rows: int = ROWS, delay_cs: int = DELAY_CS) -> bytes:
    """A grey GIF89a whose palette indices are ``samples`` (a multiple of ``width``), in timed frames of ``rows`` lines."""
    lines = len(samples) // width
    head = b"GIF89a" + struct.pack("<HHBBB", width, min(lines, rows), 0xF7, 0, 0) + _GREY
    parts = [head]
    for top in range(0, lines, rows):
        part = samples[top * width : (top + rows) * width]
        parts.append(b"\x21\xf9\x04\x04" + struct.pack("<HBB", delay_cs, 0, 0))
        parts.append(b"\x2c" + struct.pack("<HHHHB", 0, 0, width, len(part) // width, 0) + b"\x08" + _blocks(lzw_encode(part)))
    return b"".join(parts) + b"\x3b"


def decode_gif(data: bytes, composite: bool = True) -> list[Frame]:
    """All frames: global and local palettes, interlacing, transparency and the four disposal methods.
    Raises ValueError on a stream that breaks the format."""
    if data[:6] not in (b"GIF87a", b"GIF89a") or len(data) < 13:
        raise ValueError("not a GIF")
    width, height, flags, background, _ = struct.unpack_from("<HHBBB", data, 6)
    if width * height > MAX_PIXELS:
        raise ValueError(f"canvas of {width} x {height} is too large")
    at = 13

    def palette(flag: int) -> np.ndarray:
        nonlocal at
        n = 2 << (flag & 7)
        p = np.frombuffer(data, np.uint8, 3 * n, at).reshape(n, 3)
        at += 3 * n
        return p

    def sub_blocks() -> bytes:
        nonlocal at
        parts = []
        while n := data[at]:
            if at + 1 + n > len(data):
                raise ValueError("truncated block")
            parts.append(data[at + 1 : at + 1 + n])
            at += n + 1
        at += 1
        return b"".join(parts)

    common = palette(flags) if flags & 0x80 else None
    canvas = np.zeros((height, width, 4), np.uint8) if composite else None
    frames: list[Frame] = []
    delay, dispose, clear_index = 0, 0, None
    try:
        while (kind := data[at]) != 0x3B:
            at += 1
            if kind == 0x21:
                label = data[at]
                at += 1
                body = sub_blocks()
                if label == 0xF9:
                    packed, delay, t = struct.unpack_from("<BHB", body)
                    dispose, clear_index = packed >> 2 & 7, t if packed & 1 else None
            elif kind == 0x2C:
                left, top, w, h, packed = struct.unpack_from("<HHHHB", data, at)
                at += 9
                colours = palette(packed) if packed & 0x80 else common
                if colours is None:
                    raise ValueError("no palette")
                bits = data[at]
                at += 1
                if w * h > MAX_PIXELS or not 1 <= bits <= 8:
                    raise ValueError(f"frame of {w} x {h} in {bits} bits")
                flat = np.frombuffer(lzw_decode(sub_blocks(), bits, w * h), np.uint8)
                if len(flat) < w * h:
                    raise ValueError("short frame")
                index = flat.reshape(h, w)
                if packed & 0x40:
                    order = np.r_[0:h:8, 4:h:8, 2:h:4, 1:h:2]
                    index = index[np.argsort(order, kind="stable")]
                if composite:
                    before = canvas.copy() if dispose == 3 else None
                    y, x = min(h, height - top), min(w, width - left)
                    part = index[:y, :x]
                    rgba = np.empty((*part.shape, 4), np.uint8)
                    rgba[..., :3] = colours[np.minimum(part, len(colours) - 1)]
                    rgba[..., 3] = 255
                    area = canvas[top : top + y, left : left + x]
                    area[:] = rgba if clear_index is None else np.where((part == clear_index)[..., None], area, rgba)
                    frames.append(Frame(index, canvas.copy(), delay * 10, left, top))
                    if dispose == 2:
                        area[:] = 0
                    elif dispose == 3:
                        canvas = before
                else:
                    frames.append(Frame(index, colours, delay * 10, left, top))
                delay, dispose, clear_index = 0, 0, None
            else:
                raise ValueError(f"unknown block {kind:#x}")
    except (IndexError, struct.error) as e:
        raise ValueError("truncated GIF") from e
    return frames


def histogram(index: np.ndarray, colours: np.ndarray, bins: int = 16) -> np.ndarray:
    """Luminance histogram of a frame's own pixels, through its palette."""
    counts = np.bincount(index.ravel(), minlength=256)[: len(colours)]
    light = (colours.astype(np.int64) @ np.array([299, 587, 114]) // 1000) * bins // 256
    return np.bincount(light[: len(counts)], weights=counts, minlength=bins).astype(np.int64)


def payload(text: str | None) -> tuple[int, bytes]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return len(raw), raw + b"\0" * (-len(raw) % 64 or (0 if raw else 64))


def stored_row(text: str | None) -> tuple:
    """Store a text as a GIF, read the stored bytes back and describe what was read."""
    n, data = payload(text)
    gif = encode_gif(data)
    frames = decode_gif(gif, composite=False)
    back = b"".join(f.index.tobytes() for f in frames)
    hist = sum(histogram(f.index, f.canvas) for f in frames)
    feature = f"frames={len(frames)};ms={sum(f.delay_ms for f in frames)};hist={','.join(map(str, hist))}"
    return n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-64:]), len(gif), hashlib.sha256(gif).hexdigest(), feature, gif


_ROW = [("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string()), ("media", pa.binary())]
_DDL = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def store(docs: DataFrame, keep_media: bool = True) -> DataFrame:
    """One row per document with its GIF (``media``, if kept), digests of what was read back, and features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0)
            for at in range(0, b.num_rows, 512):  # the media of few texts at a time
                rows = [stored_row(t.as_py()) for t in b.column(1).slice(at, 512)]
                cols = list(zip(*rows, strict=True)) if rows else [[]] * len(_ROW)
                keep = _ROW if keep_media else _ROW[:-1]
                arrays = [pa.array(c, t) for c, (_, t) in zip(cols, keep, strict=False)]
                yield pa.RecordBatch.from_arrays([ids.slice(at, 512), *arrays], names=["doc_id", *(n for n, _ in keep)])

    plain = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    return plain.mapInArrow(run, _DDL + (", media binary" if keep_media else ""))


def frames(media: DataFrame, column: str = "media", key: str = "doc_id") -> DataFrame:
    """One row per composited frame: key, frame, start_ms, delay_ms, width, height, opaque pixels, RGB histogram
    (4 x 4 x 4 bins) and ``error`` (null if the GIF is sound; a broken one gives one row with the error)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for k, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if data is None:
                    continue
                start = 0
                try:
                    for i, f in enumerate(decode_gif(data)):
                        rgb = f.canvas[f.canvas[..., 3] > 0][:, :3] >> 6
                        cell = rgb[:, 0].astype(int) * 16 + rgb[:, 1] * 4 + rgb[:, 2]
                        out.append((k, i, start, f.delay_ms, f.canvas.shape[1], f.canvas.shape[0], len(rgb), np.bincount(cell, minlength=64).tolist(), None))
                        start += f.delay_ms
                except ValueError as e:
                    out.append((k, None, None, None, None, None, None, None, str(e)))
            names = ["key", "frame", "start_ms", "delay_ms", "width", "height", "opaque", "histogram", "error"]
            types = [pa.string(), *[pa.int64()] * 6, pa.list_(pa.int64()), pa.string()]
            cols = list(zip(*out, strict=True)) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

    ddl = "key string, frame long, start_ms long, delay_ms long, width long, height long, opaque long, histogram array<long>, error string"
    return media.selectExpr(f"cast(`{key}` as string) k", f"cast(`{column}` as binary) m").mapInArrow(run, ddl)


def op1_gif_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store(documents(spark, sf_dir), keep_media=False)


QUERIES = {"op1_gif_media": op1_gif_media}
ORACLE: dict[str, str] = {}

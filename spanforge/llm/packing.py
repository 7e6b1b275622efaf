"""Vector bin packing of tokenised examples into training sequences.

A sequence has three limits at once: tokens, segments and loss-bearing tokens. An example goes where the dot product of
its demand and the sequence's remaining room is largest (each dimension as a share of its limit). What fits nowhere
whole is cut to fill the gap, so padding arises only where the segment or loss limit ends a sequence; what a task has
left at its end goes to sequences of a power-of-two length, which need no padding.

Each task packs the rows of its own input partition, streaming Arrow batches with a pool of at most ``pool``
examples: no shuffle, bounded memory, no dependence between tasks, and a lost task's rerun gives the same sequences
(``sequence_id`` = partition number and a running number). Defined results: null text = empty text = the end
token alone; equal rows are packed separately; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import filterfalse

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from .common import _CACHES, claim, documents, small_batches

MAX_TOKENS, MAX_SEGMENTS, MAX_LOSS, POOL = 4096, 128, 4096, 768
END_ID = 2
TOKENIZER = "word_bpe_49k.json"


class WordIds(dict):
    """word bytes (ASCII lower case) -> its ids as little-endian uint32 bytes.

    The tokenizer lower-cases and never joins across ASCII white space, so a text's ids are those of its words in turn. New words
    are encoded many to a call, with a control character between them whose id no word contains; words with
    that character are encoded alone. ``limit`` bounds the kept words: the older half goes first."""

    MARK = "\x01"

    def __init__(self, path: str, limit: int = 1_600_000):
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.limit = limit
        mark = self.tokenizer.encode(self.MARK, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, texts: list[list[bytes]]) -> None:
        """Have the ids of all words of some texts."""
        if len(self) > self.limit:
            for w in list(self)[: self.limit // 2]:
                del self[w]
        new: set[bytes] = set()
        for words in texts:
            new.update(filterfalse(self.__contains__, words))
        self._encode(list(new))

    def _encode(self, new: list[bytes]) -> None:
        for at in range(0, len(new), 2048):
            part = new[at : at + 2048]
            text = f" {self.MARK} ".encode().join(part)
            if self.mark is not None and text.count(self.MARK.encode()) == len(part) - 1:
                ids = np.array(self._ids([text.decode("utf-8", "replace")])[0], dtype="<u4")
                cut = np.flatnonzero(ids == self.mark)
                if len(cut) == len(part) - 1:
                    lo, hi = (np.r_[0, cut + 1] * 4).tolist(), (np.r_[cut, len(ids)] * 4).tolist()
                    self.update(zip(part, map(ids.tobytes().__getitem__, map(slice, lo, hi)), strict=True))
                    continue
            for w, x in zip(part, self._ids([w.decode("utf-8", "replace") for w in part]), strict=True):
                self[w] = np.array(x, dtype="<u4").tobytes()


_IDS: dict[str, WordIds] = {}
_CACHES["packing"] = _IDS.clear


def word_ids(path: str) -> WordIds:
    claim("packing")
    if path not in _IDS:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _IDS[path] = WordIds(path)
    return _IDS[path]


def _table(values) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(values)] = True
    return out


_SPACE, _MARKS, _PLAIN = _table(b" \t\n\v\f\r"), _table(b".,!?;:"), _table(b"abcdefghijklmnopqrstuvwxyz0123456789")
_LEAD, _NEXT = _table(range(0xC3, 0xCA)), _table(range(0x80, 0xC0))


def _split(text: str | None) -> list[bytes]:
    """Words of a text, ASCII lower case. Punctuation that ends a word behind an ASCII letter or digit or a letter of U+00C0 to U+024F is a
    word of its own: the tokenizer parts them too, and so fewer words are new."""
    raw = (text or "").encode("utf-8", "surrogatepass").lower()
    x = np.frombuffer(raw, np.uint8)
    at = np.flatnonzero(_MARKS[x])
    at = at[(at > 1) & _SPACE[x[np.minimum(at + 1, len(x) - 1)]]] if len(at) else at
    if len(at):
        last, lead = x[at - 1], x[at - 2]
        sign = (lead == 0xC3) & ((last == 0x97) | (last == 0xB7))  # the multiplication and division signs
        at = at[_PLAIN[last] | (_LEAD[lead] & _NEXT[last] & ~sign)]
    return (np.insert(x, at, 32).tobytes() if len(at) else raw).split()


def tokenize(texts: list[str | None], path: str, end_id: int = END_ID) -> list[bytes]:
    """Each text's ids and the end id, as little-endian uint32 bytes."""
    ids = word_ids(path)
    split = [_split(t) for t in texts]
    end = np.array([end_id], dtype="<u4").tobytes()
    out = []
    for at in range(0, len(split), 256):
        part = split[at : at + 256]
        ids.learn(part)
        out += [b"".join([*map(ids.__getitem__, w), end]) for w in part]
    return out


class Packer:
    """Streams items (key, n tokens, n leading tokens without loss) to pieces (item, start, end, sequence, offset)."""

    def __init__(self, tokens: int = MAX_TOKENS, segments: int = MAX_SEGMENTS, loss: int = MAX_LOSS, pool: int = POOL):
        self.limit = np.array([tokens, segments, loss], float)
        self.pool_size = pool
        self.items: list = [None] * pool  # key of each slot
        self.start = np.zeros(pool, np.int64)
        self.end = np.zeros(pool, np.int64)
        self.prompt = np.zeros(pool, np.int64)
        self.free = list(range(pool))
        self.sequence = 0

    @staticmethod
    def _loss(start, end, prompt):
        return np.maximum(0, end - np.maximum(start, prompt))

    def add(self, key, n: int, prompt: int = 1) -> Iterator[tuple]:
        """Take an item; yields the pieces of sequences that became complete."""
        start, full = 0, int(self.limit[0])
        while n - start >= full and self._loss(start, start + full, prompt) <= self.limit[2]:
            yield key, start, start + full, self.sequence, 0
            self.sequence += 1
            start += full
        if start == n:
            return
        if not self.free:
            while len(self.free) < self.pool_size // 2:
                yield from self._fill(full)
        i = self.free.pop()
        self.items[i], self.start[i], self.end[i], self.prompt[i] = key, start, n, prompt

    def flush(self) -> Iterator[tuple]:
        while left := int((self.end - self.start).sum()):
            yield from self._fill(min(int(self.limit[0]), 1 << left.bit_length() - 1))

    def _fill(self, target: int) -> Iterator[tuple]:
        """One sequence of ``target`` tokens, or fewer where another limit ends it."""
        room = self.limit.copy()
        room[0] = target
        offset = 0
        while room[0] > 0 and room[1] > 0:
            size = self.end - self.start
            loss = self._loss(self.start, self.end, self.prompt)
            live = size > 0
            fits = live & (size <= room[0]) & (loss <= room[2])
            if room[1] == 1 and (size >= room[0]).any():  # the last segment must fill the rest
                fits &= size == room[0]
            if fits.any():
                dot = size * (room[0] / self.limit[0] ** 2) + loss * (room[2] / self.limit[2] ** 2) + room[1] / self.limit[1] ** 2
                i = int(np.argmax(np.where(fits, dot, -1.0)))
                take = int(size[i])
            elif live.any():
                i = int(np.argmax(size))
                take = int(min(size[i], room[0], room[2] + max(0, int(self.prompt[i] - self.start[i]))))
                if take <= 0:
                    break
            else:
                break
            a = int(self.start[i])
            yield self.items[i], a, a + take, self.sequence, offset
            room -= (take, 1, self._loss(a, a + take, int(self.prompt[i])))
            offset += take
            self.start[i] = a + take
            if self.start[i] == self.end[i]:
                self.items[i] = None
                self.start[i] = self.end[i] = 0
                self.free.append(i)
        self.sequence += 1


_FIELDS = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("loss_tokens", pa.int64())]
_SCHEMA = pa.schema(_FIELDS)
_DDL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss_tokens long"


def pack(docs: DataFrame, path: str | None = None, tokens: int = MAX_TOKENS, segments: int = MAX_SEGMENTS, loss: int = MAX_LOSS, with_ids: bool = False) -> DataFrame:
    """Pieces of packed sequences, one row each; ``with_ids`` adds the piece's ids (little-endian uint32 binary).
    ``loss_tokens`` counts the piece's tokens but a document's first, which nothing predicts."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER)
    small_batches(docs.sparkSession)
    schema = pa.schema([*_FIELDS, ("ids", pa.binary())]) if with_ids else _SCHEMA

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, base = Packer(tokens, segments, loss), TaskContext.get().partitionId() << 40

        def rows(pieces):
            out = []
            for (doc, ids, n), a, b, sequence, offset in pieces:
                part = ids[4 * a : 4 * b]
                out.append((doc, a, b - a, zlib.crc32(part), n, base + sequence, offset, max(0, b - max(a, 1)), *([part] if with_ids else [])))
            cols = list(zip(*out, strict=True)) if out else [[]] * len(schema)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

        for b in batches:
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                ids = tokenize(part.column(1).to_pylist(), path)
                made = []
                for doc, x in zip(part.column(0).to_pylist(), ids, strict=True):
                    made += packer.add((doc, x, len(x) // 4), len(x) // 4)
                yield rows(made)
        yield rows(packer.flush())

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(run, _DDL + (", ids binary" if with_ids else ""))


def op5_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))


QUERIES = {"op5_vector_packing": op5_vector_packing}
ORACLE: dict[str, str] = {}

"""Dedup of repeated byte strings by content-determined triggers and hash grouping, in place of prefix-free parsing's suffix arrays.

Every byte covered by a ``LENGTH``-byte string that also starts earlier (smaller doc_id, or earlier in the same document)
is removed; strings are judged on the input and never cross documents.

A rolling hash cuts texts at triggers: a ``GRAM``-byte string is a trigger if it is the least of some ``LENGTH``-byte window
(leftmost on ties), so each window has exactly one trigger that its own bytes determine, and phrases between triggers
are bounded. Equal windows share the trigger and the bytes around it, so hashes of both are sorted and grouped; no
phrase dictionary, parse, suffix array or suffix order is built. Windows are looked at only where they can matter:

1. Triggers are dealt by their hash and sorted by (trigger, context, position). A later occurrence of the same context is
   a repeat: all its windows go. A trigger with one context cannot start a match elsewhere: its first occurrence stays.
2. Only first occurrences of contexts whose trigger has other contexts are undecided (edges of repeats). Their windows are
   taken in ranges of ``WIDTH`` neighbours: what all windows of a range share is a longer trigger, what they reach a shorter
   context, and step 1 decides most ranges.
3. Windows of ranges that are still undecided are hashed one by one, dealt by hash and sorted by position; all but the
   first go.
4. Documents with decisions are read again, and the covered bytes are dropped.

Scale: one row per trigger (two in ``LENGTH - GRAM`` bytes on average) and per undecided window is shuffled, never a row per byte;
inside a task, repeats of a row it already has are decided there and dealt evenly, so a hot passage or group of copies puts
at most one row per task under its key. Exact copies of whole documents are found by their digest and need no windows.

Defined results: null text = empty text; texts under ``LENGTH`` bytes lose nothing; rows with a null doc_id match nothing and
keep all; rows that repeat a doc_id share its positions (equal rows do not remove each other); other columns are
ignored; hashes have 64 bits, so among n windows that are looked at a false match has odds of about n**2 / 2**65.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_partition, discard, documents, materialize, mix64, signed

LENGTH, GRAM, WIDTH = 100, 24, 11
_BASE = 0x9E3779B97F4A7C15
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if len(_POWERS[0]) < n:
        size = max(n, 1 << 17)
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            x = np.full(size, np.uint64(base))
            x[0] = 1
            _POWERS[i] = np.cumprod(x, dtype=np.uint64)
    return _POWERS[0][:n], _POWERS[1][:n]


class Text:
    """The bytes of a text with prefix hashes."""

    def __init__(self, data: bytes):
        self.data, self.n = data, len(data)
        up, self.down = _powers(self.n + 1)
        self.prefix = np.zeros(self.n + 1, np.uint64)
        np.cumsum(_BYTE[np.frombuffer(data, np.uint8)] * up[: self.n], out=self.prefix[1:])

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.prefix[end] - self.prefix[start]) * self.down[start])

    def triggers(self, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
        """(trigger position of every window, hash of the gram at every position)."""
        at = np.arange(self.n - gram + 1)
        h = self.hashes(at, at + gram)
        low = (h & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
        width, have = length - gram + 1, 1
        while have < width:  # minimum over 1, 2, 4, ... positions
            step = min(have, width - have)
            low = np.minimum(low[:-step], low[step:])
            have += step
        return (low & np.uint64(0xFFFFFFFF)).astype(np.int64), h


def _phrases(data: bytes, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Position, hash and context hash of each trigger."""
    t = Text(data)
    owner, h = t.triggers(length, gram)
    p = owner[np.r_[True, owner[1:] != owner[:-1]]]
    lo, hi = np.maximum(p + gram - length, 0), np.minimum(p + length, t.n)
    context = mix64(t.hashes(lo, hi) ^ ((p - lo).astype(np.uint64) << np.uint64(32)) ^ (hi - lo).astype(np.uint64))
    return p, h[p], context


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


_ROW = ["key", "a", "b", "doc_id", "pos", "repeat"]
_DDL = "key long, a long, b long, doc_id long, pos long, repeat boolean"


def _combined(a: np.ndarray, b: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> pa.RecordBatch:
    """Rows for a shuffle by a: of rows equal in (a, b), the later ones are decided repeats and get keys of their own."""
    order = np.lexsort((pos, doc, b, a))
    a, b, doc, pos = a[order], b[order], doc[order], pos[order]
    again = np.r_[False, (a[1:] == a[:-1]) & (b[1:] == b[:-1])] if len(a) else np.zeros(0, bool)
    again = _later(again, doc, pos)
    key = np.where(again, mix64(doc.astype(np.uint64) ^ (pos.astype(np.uint64) << np.uint64(40))), a)
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (signed(key), signed(a), signed(b), doc, pos, again)], names=_ROW)


def _later(again: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Of sorted rows, those that stand at another place than the first of their group."""
    if not len(again):
        return again
    first = np.maximum.accumulate(np.where(again, 0, np.arange(len(again))))
    return again & ((doc != doc[first]) | (pos != pos[first]))


def _trigger_rows(docs: DataFrame, length: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4000):
                part = batch.slice(at, 4000)
                got = [[], [], [], []]
                for d, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    data = t.encode("utf-8", "surrogatepass")
                    if len(data) >= length:
                        p, h, c = _phrases(data, length, gram)
                        for column, v in zip(got, (h, c, np.full(len(p), d), p), strict=True):
                            column.append(v)
                if got[0]:
                    yield _combined(*map(np.concatenate, got))

    return _plain(docs).filter("doc_id is not null").mapInArrow(run, _DDL)


def _judge_triggers(rows: DataFrame) -> DataFrame:
    """(doc_id, pos, kind): kind 1 repeats an earlier context, kind 2 is undecided."""

    def run(t: pa.Table) -> Iterator[pa.RecordBatch]:
        a, b, doc, pos = (t.column(c).to_numpy() for c in ("a", "b", "doc_id", "pos"))
        known = t.column("repeat").to_numpy(zero_copy_only=False)
        out = [(doc[known], pos[known], np.ones(int(known.sum()), np.int32))]
        a, b, doc, pos = a[~known], b[~known], doc[~known], pos[~known]
        if len(a):
            order = np.lexsort((pos, doc, b, a))
            a, b, doc, pos = a[order], b[order], doc[order], pos[order]
            new_a = np.r_[True, a[1:] != a[:-1]]
            new = new_a | np.r_[True, b[1:] != b[:-1]]
            later = _later(~new, doc, pos)
            group = np.cumsum(new_a) - 1
            undecided = new & (np.bincount(group, weights=new)[group] > 1)
            out += [(doc[later], pos[later], np.ones(int(later.sum()), np.int32)), (doc[undecided], pos[undecided], np.full(int(undecided.sum()), 2, np.int32))]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], names=["doc_id", "pos", "kind"])

    return by_partition(rows.repartition("key"), run, "doc_id long, pos long, kind int")


def _open_windows(text: Text, undecided: list[int], length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, triggers) of the windows of undecided triggers."""
    owner, _ = text.triggers(length, gram)
    s = np.flatnonzero(np.isin(owner, np.array(undecided, np.int64)))
    return s, owner[s]


def _ranges(text: Text, undecided: list[int], length: int, gram: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, hash of what a range's windows share, hash of what they reach); place is trigger * 128 + range."""
    s, p = _open_windows(text, undecided, length, gram)
    place = np.unique(p * 128 + (p - s) // width)
    p, r = place >> 7, place & 127
    near, far = r * width, np.minimum((r + 1) * width, length - gram + 1) - 1  # least and largest offset of the trigger
    shared = mix64(text.hashes(p - near, p - far + length) ^ r.astype(np.uint64))
    lo, hi = np.maximum(p - far, 0), np.minimum(p - near + length, text.n)
    return place, shared, mix64(text.hashes(lo, hi) ^ ((p - lo).astype(np.uint64) << np.uint64(32)) ^ (hi - lo).astype(np.uint64))


def _range_rows(docs: DataFrame, length: int, gram: int, width: int) -> DataFrame:
    """Rows of the ranges of undecided triggers; docs: doc_id, text, undecided (trigger positions)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                got = [[], [], [], []]
                for d, t, open_ in zip(*(c.to_pylist() for c in batch.slice(at, 2000).columns), strict=True):
                    data = t.encode("utf-8", "surrogatepass")
                    if len(data) >= length:
                        place, a, b = _ranges(Text(data), open_, length, gram, width)
                        for column, v in zip(got, (a, b, np.full(len(place), d), place), strict=True):
                            column.append(v)
                if got[0]:
                    yield _combined(*map(np.concatenate, got))

    return docs.mapInArrow(run, _DDL)


def _window_rows(docs: DataFrame, length: int, gram: int, width: int) -> DataFrame:
    """Hashes of the windows of undecided ranges; docs: doc_id, text, undecided (places)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                got = [[], [], [], []]
                for d, t, open_ in zip(*(c.to_pylist() for c in batch.slice(at, 2000).columns), strict=True):
                    data = t.encode("utf-8", "surrogatepass")
                    if len(data) < length:
                        continue
                    text, places = Text(data), np.array(open_, np.int64)
                    s, p = _open_windows(text, np.unique(places >> 7), length, gram)
                    keep = np.isin(p * 128 + (p - s) // width, places)
                    s, p = s[keep], p[keep]
                    for column, v in zip(got, (text.hashes(s, s + length), (p - s).astype(np.uint64), np.full(len(s), d), s), strict=True):
                        column.append(v)
                if got[0]:
                    yield _combined(*map(np.concatenate, got))

    return docs.mapInArrow(run, _DDL)


def _judge_windows(rows: DataFrame) -> DataFrame:
    """(doc_id, pos) of windows that start earlier elsewhere."""

    def run(t: pa.Table) -> Iterator[pa.RecordBatch]:
        a, b, doc, pos = (t.column(c).to_numpy() for c in ("a", "b", "doc_id", "pos"))
        known = t.column("repeat").to_numpy(zero_copy_only=False)
        order = np.lexsort((pos, doc, b, a, known))
        a, b, doc, pos, known = a[order], b[order], doc[order], pos[order], known[order]
        same = np.r_[False, (a[1:] == a[:-1]) & (b[1:] == b[:-1]) & ~known[1:]]
        gone = known | _later(same, doc, pos)
        yield pa.RecordBatch.from_arrays([pa.array(doc[gone]), pa.array(pos[gone])], names=["doc_id", "pos"])

    return by_partition(rows.repartition("key"), run, "doc_id long, pos long")


def _cut(docs: DataFrame, length: int, gram: int, width: int) -> DataFrame:
    """doc_id, n_removed, n_spans, kept (binary); docs: doc_id, text, repeated (trigger positions), ranges (places), windows (starts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                rows = []
                for d, t, repeated, ranges, windows in zip(*(c.to_pylist() for c in batch.slice(at, 1000).columns), strict=True):
                    data = t.encode("utf-8", "surrogatepass")
                    if len(data) < length:
                        rows.append((d, 0, 0, data))
                        continue
                    gone = np.zeros(len(data) - length + 1, bool)
                    if repeated or ranges:
                        owner, _ = Text(data).triggers(length, gram)
                        gone |= np.isin(owner, np.array(repeated or [], np.int64))
                        gone |= np.isin(owner * 128 + (owner - np.arange(len(owner))) // width, np.array(ranges or [], np.int64))
                    gone[np.array(windows or [], np.int64)] = True
                    edge = np.zeros(len(data) + 1, np.int64)
                    edge[:-length] += gone
                    edge[length:] -= gone
                    covered = np.cumsum(edge[:-1]) > 0
                    spans = int(np.count_nonzero(covered & ~np.r_[False, covered[:-1]]))
                    rows.append((d, int(covered.sum()), spans, np.frombuffer(data, np.uint8)[~covered].tobytes()))
                cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, [pa.int64()] * 3 + [pa.binary()], strict=True)], names=["doc_id", "n_removed", "n_spans", "kept"])

    return docs.mapInArrow(run, "doc_id long, n_removed long, n_spans long, kept binary")


def _by_document(judged: DataFrame) -> DataFrame:
    """doc_id, repeated, undecided: the judged places of each document."""
    at = lambda kind: F.collect_list(F.when(F.col("kind") == kind, F.col("pos")))
    return judged.groupBy("doc_id").agg(at(1).alias("repeated"), at(2).alias("undecided"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, width: int = WIDTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row."""
    plain = _plain(docs)
    facts = materialize(plain.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha")), "texts")
    firsts = facts.filter(f"n_bytes >= {length} and doc_id is not null").groupBy("sha").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    copies = materialize(facts.join(firsts, "sha").filter("doc_id > first").select("doc_id", "sha").distinct(), "copies")

    triggers = materialize(_judge_triggers(_trigger_rows(docs, length, gram)), "triggers")
    flags = materialize(_by_document(triggers.join(copies.select("doc_id"), "doc_id", "left_anti")), "flags")
    discard(triggers)

    def with_text(rows: DataFrame) -> DataFrame:
        return plain.join(rows.filter(F.size("undecided") > 0).select("doc_id", "undecided"), "doc_id").select("doc_id", "text", "undecided")

    ranges = materialize(_by_document(_judge_triggers(_range_rows(with_text(flags), length, gram, width))), "ranges")
    windows = _judge_windows(_window_rows(with_text(ranges), length, gram, width))
    windows = materialize(windows.groupBy("doc_id").agg(F.collect_list("pos").alias("windows")), "windows")
    repeated = flags.filter(F.size("repeated") > 0).select("doc_id", "repeated")
    cuts = repeated.join(ranges.filter(F.size("repeated") > 0).select("doc_id", F.col("repeated").alias("ranges")), "doc_id", "full").join(windows, "doc_id", "full")
    cut = _cut(plain.join(cuts, "doc_id").select("doc_id", "text", "repeated", "ranges", "windows"), length, gram, width)
    cut = cut.select("doc_id", F.col("n_removed").alias("cut"), F.col("n_spans").alias("spans"), F.sha2("kept", 256).alias("kept_sha")).dropDuplicates(["doc_id"])
    cut = materialize(cut, "cuts")
    for done in (flags, ranges, windows):
        discard(done)
    out = facts.join(cut, "doc_id", "left").join(copies.select("doc_id", F.col("sha"), F.lit(True).alias("copy")), ["doc_id", "sha"], "left")
    copy = F.coalesce("copy", F.lit(False))
    return out.select(
        "doc_id", "n_bytes", F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("cut", F.lit(0))).alias("n_removed"), F.when(copy, 1).otherwise(F.coalesce("spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha", "sha")).alias("kept_sha256"),
    )


def op8_pfp_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir))


QUERIES = {"op8_pfp_dedup": op8_pfp_dedup}
ORACLE: dict[str, str] = {}

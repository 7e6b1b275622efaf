"""Language-model scoring by a probabilistic suffix tree over words.

States are word contexts. A context is a candidate if it occurs at least ``MIN_CONTEXT`` times in the training corpus; it is a
state if its next-symbol distribution diverges from its suffix's by at least ``MIN_DIVERGENCE`` nats, or if it is a suffix of a
state. A state stores the next symbols seen at least ``MIN_NEXT`` times after it, with ``DISCOUNT`` taken off each count; what is
left goes to its suffix, down to the root, the add-one unigram distribution (the base). Every position is scored by the
longest suffix of its history that is a state. Depth follows the data: a context is extended to the left while several
symbols follow it and it or its suffix diverges; counting ends when nothing is left to extend. So a longer context is missed
only if two lengths in a row before it added nothing.

Scale: every level is counted over the whole training corpus; each task combines its own rows before they are shuffled.
States and stored symbols are distributed tables. As the tree is closed under suffixes, a text's score is a sum of one number
per word sequence in it (``_values``). Those of sequences of at least ``P_JOINT`` of the training tokens (at most 1 / P_JOINT a
length) are broadcast, so no key that is left is hot; all others are looked up in parts by hash, which tasks ask in packed
arrays after a bit filter of bounded size dropped most sequences that have none. From the fourth level on only the parts of
the texts are read that still hold counted contexts.

Defined results: null text = empty text = the end token alone; words and sequences are compared by a 64-bit hash; without training
documents all counts are 0 (base log10(1 / 1) per token with N = V = 0); rows with a null doc_id are scored and train; rows
that repeat a doc_id are scored each on its own.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_mod, discard, documents, materialize, mix64, signed, small_batches

#: Counts and divergence that the tree is made by.
MIN_CONTEXT, MIN_NEXT, DISCOUNT, MIN_DIVERGENCE = 8, 2, 0.5, 0.02
#: Shares of the training tokens from which a context or a sequence is broadcast; they decide where a number is looked up, not what it is.
P_CONTEXT, P_JOINT = 1e-4, 3e-6
#: Depth from which only the parts of texts that still hold counted contexts are read, and the words kept before those (four times as many once a depth needs more).
CUT_FROM, KEPT_WORDS = 4, 16
#: Hash of the end token: the empty word, which no text has.
END = np.uint64(0x2D06800538D394C2)


#: Rounds in which the texts ask the table, each after the one before is answered and its shuffle gone.
ROUNDS = 2
#: Arrow batches of the table that are dealt at a time.
DEALT_BATCHES = 1000
#: Bytes of text that are cut into words at a time.
CHUNK = 1 << 19
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15 - 2  # odd, and 3 modulo 8: its powers differ in low bits
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
_BYTE[0x41:0x5B] = _BYTE[0x61:0x7B]  # A-Z are a-z
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """At least n powers of the base, and of its inverse, modulo 2**64."""
    if len(_POWERS[0]) < n:
        for i, x in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(max(n, CHUNK), np.uint64(x))
            steps[0] = 1
            _POWERS[i] = np.multiply.accumulate(steps)
    return _POWERS


def _words(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts that lie one after another in ``data``, with an end token after each text; tokens by text."""
    begins = np.r_[0, ends[:-1]]
    word = ~_SPACE[data]
    before, after = np.r_[False, word[:-1]], np.r_[word[1:], False]
    full = ends > begins
    before[begins[full]], after[ends[full] - 1] = False, False
    first, last = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after)
    power, inverse = _powers(len(data))
    sums = np.cumsum(_BYTE[data] * power[: len(data)])
    h = mix64((sums[last] - np.where(first > 0, sums[first - 1], np.uint64(0))) * inverse[first]) if len(first) else np.zeros(0, np.uint64)
    n = np.diff(np.searchsorted(first, np.r_[0, ends]))
    out = np.full(len(h) + len(ends), END)
    out[np.arange(len(h)) + np.repeat(np.arange(len(ends)), n)] = h
    return out, n + 1


def _tokens(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(tokens, tokens by text) of runs of texts of about ``CHUNK`` bytes; null is empty."""
    column = pa.concat_arrays([column.fill_null("").cast(pa.large_string())]) if len(column) else column
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK, "right")) - 1)
        yield _words(data[offsets[at] : offsets[to]], offsets[at + 1 : to + 1] - offsets[at])
        at = to


def _places(lens: np.ndarray) -> np.ndarray:
    """Position of each token in its text."""
    return np.arange(lens.sum()) - np.repeat(np.cumsum(lens) - lens, lens)


def _order(x: np.ndarray) -> np.ndarray:
    """Stable argsort of unsigned 64-bit keys: positions are sorted along with the keys' leading bits, which seldom fail to tell them apart."""
    low = np.uint64(max(1, len(x) - 1).bit_length())
    both = np.sort((x >> low << low) | np.arange(len(x), dtype=np.uint64))
    by = (both & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64)
    y = x[by]
    return by if (y[1:] >= y[:-1]).all() else np.argsort(x, kind="stable")


def _runs(x: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.r_[True, x[1:] != x[:-1]]) if len(x) else np.zeros(0, np.int64)


def _count(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    x = np.sort(np.concatenate(keys)) if keys else np.zeros(0, np.uint64)
    first = _runs(x)
    return x[first], np.diff(np.r_[first, len(x)]).astype(np.int64)


def _by_key(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with their numbers summed."""
    by = _order(keys)
    keys, n = keys[by], n[by]
    first = _runs(keys)
    return keys[first], np.add.reduceat(n, first) if len(first) else n


class Counter:
    """Counts keys, folding what it holds when more than ``limit`` keys have come."""

    def __init__(self, limit: int = 4_000_000):
        self.limit, self.new, self.size = limit, [], 0
        self.key, self.n = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def add(self, keys: np.ndarray) -> None:
        self.new.append(keys)
        self.size += len(keys)
        if self.size > self.limit:
            self.fold()

    def fold(self) -> None:
        k, n = _count(self.new)
        self.key, self.n = _by_key(np.concatenate([self.key, k]), np.concatenate([self.n, n]))
        self.new, self.size = [], 0


def _unigrams(train: DataFrame) -> DataFrame:
    """(key, n) of the words of all training texts."""
    parts = _parts(train.sparkSession)[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter()
        for b in batches:
            for tokens, _ in _tokens(b.column(0)):
                counter.add(tokens)
        counter.fold()
        if len(counter.key):
            yield _packed(_dealt(0, counter.key, counter.n, parts))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in _by_part(batches):
            keys, n = _told([blob for _, blob in got], np.int64)
            keys, n = _by_key(keys, n)
            yield from _sliced(pa.RecordBatch.from_arrays([pa.array(signed(keys)), pa.array(n)], names=["key", "n"]))

    return train.mapInArrow(run, _PACKED).repartition("part").mapInArrow(count, "key long, n long")


def _find(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Index of each key in a sorted table, or -1."""
    if not len(table):
        return np.full(len(keys), -1, np.int64)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)


def _turn(x: np.ndarray) -> np.ndarray:
    return (x << np.uint64(23)) | (x >> np.uint64(41))


def _extended(keys: np.ndarray, tokens: np.ndarray, n: int) -> np.ndarray:
    """Keys of the n words before each position, from those of the n - 1 words before it (a cyclic polynomial of the word hashes)."""
    r = 23 * (n - 1) % 64
    far = tokens[: max(len(tokens) - n, 0)]
    out = keys.copy()
    out[n:] ^= (far << np.uint64(r)) | (far >> np.uint64(64 - r)) if r else far
    return out


def _longer(context: Column, symbol: Column) -> Column:
    """The key of a context's sequence with one more symbol; the same in a column as in ``_extended``."""
    return F.shiftleft(context, 23).bitwiseOR(F.shiftrightunsigned(context, 41)).bitwiseXOR(symbol)


def _longs(b: pa.RecordBatch) -> list[np.ndarray]:
    return [b.column(0).to_numpy().view(np.uint64)]


class Index:
    """Finds keys in a table of distinct ones by their leading bits, counted from the least key: a part's keys begin alike."""

    def __init__(self, table: np.ndarray):
        self.place = _order(table)
        self.table = table[self.place]
        self.low = self.table[0] if len(table) else np.uint64(0)
        wide = int(self.table[-1] - self.low).bit_length() if len(table) else 0
        bits = min(22, len(table).bit_length() + 1, wide)
        self.shift, self.slots = np.uint64(wide - bits), 1 << bits
        self.first = np.searchsorted((self.table - self.low) >> self.shift, np.arange(self.slots + 1, dtype=np.uint64)).astype(np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key in the table, or -1."""
        out = np.full(len(keys), -1, np.int64)
        slot = np.minimum((keys - self.low) >> self.shift, np.uint64(self.slots - 1)).astype(np.int32)
        at, end = self.first[slot], self.first[slot + 1]
        left = np.flatnonzero(at < end)
        at, end, keys = at[left], end[left], keys[left]
        while len(left):
            hit = self.table[at] == keys
            out[left[hit]] = self.place[at[hit]]
            more = np.flatnonzero(~hit & (at + 1 < end))
            left, at, end, keys = left[more], at[more] + 1, end[more], keys[more]
        return out


class KeyFilter:
    """One bit per key's leading bits, of bounded size: a fuller filter only passes more. Tasks send the bits of each part of the keys packed."""

    MAX_BITS = 27

    def __init__(self, rows: DataFrame, max_bits: int = MAX_BITS, read=_longs):
        """read: the keys (arrays) in a batch of ``rows``."""
        parts = _parts(rows.sparkSession)[1]

        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            new, size = [], 0
            for b in chain(batches, [None]):
                if b is not None:
                    got = [k >> np.uint64(64 - max_bits) for k in read(b)]
                    new += got
                    size += sum(map(len, got))
                if size > 4_000_000 or (b is None and size):
                    x, n = _count(new)
                    part = (x * np.uint64(parts) >> np.uint64(max_bits)).astype(np.int64)
                    cuts = np.r_[_runs(part), len(part)]
                    yield _packed([(int(part[i]), 0, _pack(n[i:j].sum(keepdims=True), _planes(np.diff(x[i:j], prepend=np.uint64(0)).astype(np.uint32)))) for i, j in zip(cuts[:-1], cuts[1:], strict=True)])
                    new, size = [], 0

        def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = []
            for got in _by_part(batches):
                columns = [_unpack(blob, [np.int64, np.uint8]) for _, blob in got]
                n, x = sum(int(c[0][0]) for c in columns), np.concatenate([np.cumsum(_whole(c[1], np.uint32), dtype=np.uint32) for c in columns])
                x = _count([x])[0]
                low = int(x[0])
                if len(x) * 32 < int(x[-1]) - low:
                    out.append((low, 0, _pack(np.array([n], np.int64), x.view(np.uint8))))
                else:
                    bits = np.zeros(int(x[-1]) - low + 1, bool)
                    bits[x - np.uint32(low)] = True
                    out.append((low, 1, _pack(np.array([n], np.int64), np.packbits(bits))))
            if out:
                yield _packed(out)

        got = rows.mapInArrow(send, _PACKED).repartition("part").mapInArrow(join, _PACKED).toArrow()
        columns = [_unpack(x.as_py(), [np.int64, np.uint8]) for x in got.column("blob")]
        self.size = sum(int(n[0]) for n, _ in columns)
        bits = max(12, min(max_bits, (self.size * 16).bit_length()))
        self.shift = 64 - bits
        self.words = np.zeros(1 << (bits - 6), np.uint64)
        for low, kind, (_, x) in zip(got.column("part").to_pylist(), got.column("kind").to_pylist(), columns, strict=True):
            slot = (np.flatnonzero(np.unpackbits(x)) + low if kind else x.view(np.uint32)).astype(np.uint64) >> np.uint64(max_bits - bits)
            word = (slot >> np.uint64(6)).astype(np.int64)
            first = _runs(word)
            self.words[word[first]] |= np.bitwise_or.reduceat(np.uint64(1) << (slot & np.uint64(63)), first)

    def passes(self, keys: np.ndarray) -> np.ndarray:
        slot = keys >> np.uint64(self.shift)
        return (self.words[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) > 0


class Tree:
    """What tasks know of the suffix tree: counts of frequent words, numbers of frequent sequences, a filter of the others; and
    the frequent states of one and two words, to look into. Symbols are numbered; a state of two words is named by both."""

    def __init__(self, symbols: np.ndarray, counts: np.ndarray, total: int, vocabulary: int):
        self.symbols, self.counts = symbols, counts  # signed hashes in order, and their counts
        self.total, self.vocabulary = total, vocabulary
        self.z = total + vocabulary + 1
        self.depth = 0
        self.keys, self.values = np.zeros(0, np.int64), np.zeros(0)  # of frequent sequences, in order
        self.index: tuple[Index, Index] | None = None
        self.stored: KeyFilter | None = None  # of all sequences that have a number
        self.contexts = [np.zeros(0, np.int64), np.zeros(0, np.int64)]
        self.pairs = [np.zeros(0, np.int64), np.zeros(0, np.int64)]  # context number << 32 | symbol number
        self.logp = [np.zeros(0), np.zeros(0)]
        self.backoff = [np.zeros(0), np.zeros(0)]

    def root(self, symbol: np.ndarray) -> np.ndarray:
        return (self.counts[symbol] + 1.0) / self.z

    def add_level(self, level: int, rows: pa.Table) -> None:
        """rows: context, symbol, suffix, p of frequent sequences of frequent states; what is left of a state is dealt like its suffix."""
        context, symbol, suffix = (rows.column(c).to_numpy().astype(np.int64) for c in ("context", "symbol", "suffix"))
        if level:
            first = (context ^ suffix).view(np.uint64)
            first = (first >> np.uint64(23)) | (first << np.uint64(41))
            name = (_find(self.symbols, signed(first)) << 32) | _find(self.symbols, suffix)
        else:
            name = _find(self.symbols, context)
        symbol, p = _find(self.symbols, symbol), rows.column("p").to_numpy()
        below = self.prob(level - 1, name & 0xFFFFFFFF if level else None, symbol)
        self.contexts[level], number = np.unique(name, return_inverse=True)
        self.backoff[level] = np.log10((1 - np.bincount(number, weights=p)) / (1 - np.bincount(number, weights=below)))
        key = (number << 32) | symbol
        order = np.argsort(key)
        self.pairs[level], self.logp[level] = key[order], np.log10(p)[order]

    def prob(self, level: int, context: np.ndarray | None, symbol: np.ndarray) -> np.ndarray:
        """P(symbol) in the state of each context at a level, else in its suffix."""
        if level < 0:
            return self.root(symbol)
        c = _find(self.contexts[level], context)
        at = _find(self.pairs[level], (c << 32) | symbol)
        below = self.prob(level - 1, context & 0xFFFFFFFF if level else None, symbol)
        return np.where(c < 0, below, np.where(at >= 0, 10 ** (self.logp[level][at] if len(self.logp[level]) else 0.0), 10 ** (self.backoff[level][c] if len(self.backoff[level]) else 0.0) * below))

    def score(self, tokens: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """By text: log10 P, log10 base P and known tokens, of what the task knows; and the keys whose numbers are still to be
        added, with their texts: rare words, and sequences that pass the filter. A sequence has a number only if it has one
        without its first word."""
        begin, text, place = np.cumsum(lens) - lens, np.repeat(np.arange(len(lens)), lens), _places(lens)
        if self.index is None:  # once a worker
            self.index = Index(self.symbols.view(np.uint64)), Index(self.keys.view(np.uint64))
        symbols, sequences = self.index
        s = symbols.find(tokens)
        rare = s < 0
        per = np.where(rare, 0.0, np.log10(self.counts + 1.0)[s]) if len(self.counts) else np.zeros(len(s))
        base = np.add.reduceat(per, begin) - lens * np.log10(self.z)
        known = np.add.reduceat((~rare & (self.counts[s] > 0)).astype(np.int64), begin) if len(self.counts) else np.zeros(len(lens), np.int64)
        out, at = base.copy(), sequences.find(tokens)
        more, whose = [tokens[rare]], [text[rare]]
        if len(self.keys):
            out += np.add.reduceat(np.where(at < 0, 0.0, self.values[at]), begin)
        end = np.arange(len(tokens))
        keys = tokens
        for n in range(2, self.depth + 2):
            end, keys = end[place[end] >= n - 1], keys[place[end] >= n - 1]
            r = np.uint64(23 * (n - 1) % 64)
            far = tokens[end - (n - 1)]
            keys = keys ^ ((far << r) | (far >> (np.uint64(64) - r)) if r else far)
            passed = self.stored.passes(keys)
            end, keys = end[passed], keys[passed]
            if not len(end):
                break
            at = sequences.find(keys)
            hot = at >= 0
            out += np.bincount(text[end[hot]], weights=self.values[at[hot]], minlength=len(lens))
            more.append(keys[~hot])
            whose.append(text[end[~hot]])
        return out, base, known, np.concatenate(more), np.concatenate(whose)


def _begin(tokens: np.ndarray, place: np.ndarray, words: KeyFilter) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, counted, rare) by position of the contexts of one word before it."""
    keys = _extended(np.zeros(len(tokens), np.uint64), tokens, 1)
    rare = ~words.passes(keys)
    return keys, ~rare & (place > 0), rare


def _deepen(tokens: np.ndarray, place: np.ndarray, now: tuple, depth: int, grown: KeyFilter, frequent: KeyFilter) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for contexts of ``depth`` words. grown: the contexts of one word less that are extended; frequent: the sequences of
    the depth that were counted one depth before and are frequent. A context is left out if its suffix is not extended, or if
    it, or what it begins with, was counted and is rare."""
    keys, counted, rare = now
    at = np.flatnonzero(counted)
    longer = _extended(keys, tokens, depth)
    after = at[at + 1 < len(tokens)] + 1
    rare = np.r_[False, rare[:-1]]
    rare[after[~frequent.passes(longer[after])]] = True
    at = at[(place[at] >= depth) & ~rare[at]]
    at = at[grown.passes(keys[at])]
    counted = np.zeros(len(tokens), bool)
    counted[at] = True
    return longer, counted, rare


def _contexts(texts: DataFrame, cut: tuple[DataFrame, int, int] | None):
    """What to read for the contexts of a depth, and how: a function from a batch and the filters to (tokens, place, keys of one word less, keys,
    counted, rare) of its runs of texts. cut: the parts of the texts that are left, the depth they are left for and the words kept before them."""
    if cut is None:

        def read(b: pa.RecordBatch, filters: list) -> Iterator[tuple]:
            for tokens, lens in _tokens(b.column(0)):
                place = _places(lens)
                now, short = _begin(tokens, place, filters[0][1]), np.zeros(len(tokens), np.uint64)
                for depth, (grown, frequent) in enumerate(filters[1:], 2):
                    short, now = now[0], _deepen(tokens, place, now, depth, grown, frequent)
                yield tokens, place, short, *now

        return texts, read

    from_depth = cut[1]

    def again(b: pa.RecordBatch, filters: list) -> Iterator[tuple]:
        for row in b.to_pylist():
            tokens, flags = np.frombuffer(row["tokens"], np.uint64), np.frombuffer(row["flags"], np.uint8)
            place = _places(np.frombuffer(row["lens"], np.int32).astype(np.int64))
            keys = short = np.zeros(len(tokens), np.uint64)
            for depth in range(1, from_depth + 1):
                short, keys = keys, _extended(keys, tokens, depth)
            now = keys, flags & 1 > 0, flags & 2 > 0
            for depth, (grown, frequent) in enumerate(filters[from_depth:], from_depth + 1):
                short, now = now[0], _deepen(tokens, place, now, depth, grown, frequent)
            yield tokens, place, short, *now

    return cut[0], again


def _cut(texts: DataFrame, filters: list, words: int, cut: tuple[DataFrame, int, int] | None = None) -> DataFrame:
    """The parts of the texts, or of an earlier ``cut``, that hold counted contexts of len(filters) words, with so many ``words`` before them."""
    sent, depth = texts.sparkSession.sparkContext.broadcast(filters), len(filters)
    rows, read = _contexts(texts, cut)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for tokens, place, _, _, counted, rare in read(b, sent.value):
                at = np.flatnonzero(counted)
                if not len(at):
                    continue
                edge = np.zeros(len(tokens) + 1, np.int64)
                np.add.at(edge, at - np.minimum(place[at], words), 1)
                np.add.at(edge, at + 1, -1)
                keep = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
                first = np.flatnonzero(np.r_[True, (np.diff(keep) > 1) | (place[keep[1:]] == 0)])
                lens = np.diff(np.r_[first, len(keep)]).astype(np.int32)
                flags = (counted[keep] + 2 * rare[keep].astype(np.uint8)).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (tokens[keep], lens, flags)], names=["tokens", "lens", "flags"])

    assert words > depth
    out = materialize(rows.mapInArrow(run, "tokens binary, lens binary, flags binary"), "lm_cut")
    sent.destroy()
    return out


def _parts(spark: SparkSession) -> tuple[int, int]:
    """Shuffle partitions, and the parts that keys are dealt to: several a partition, of which a task holds one at a time unpacked."""
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return n, 4 * n


def _part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _pack(*columns: np.ndarray) -> bytes:
    return np.array([len(c) for c in columns], np.int64).tobytes() + b"".join(c.tobytes() for c in columns)


def _unpack(blob: bytes, kinds: list) -> list[np.ndarray]:
    sizes, at, out = np.frombuffer(blob, np.int64, len(kinds)), 8 * len(kinds), []
    for n, kind in zip(sizes, kinds, strict=True):
        out.append(np.frombuffer(blob, kind, n, at))
        at += int(n) * np.dtype(kind).itemsize
    return out


def _planes(x: np.ndarray) -> np.ndarray:
    """The bytes of small numbers by their weight, so that the shuffle's compression finds the zeros."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).reshape(-1)


def _whole(planes: np.ndarray, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(width, -1).T).reshape(-1).view(kind)


def _dealt(kind: int, keys: np.ndarray, x: np.ndarray, parts: int) -> list[tuple[int, int, bytes]]:
    """Packed rows of keys in order and a number of each, one a part."""
    part = _part_of(keys, parts)
    cuts = np.r_[_runs(part), len(part)]
    return [(int(part[a]), kind, _pack(_planes(np.diff(keys[a:z], prepend=np.uint64(0))), _planes(x[a:z]))) for a, z in zip(cuts[:-1], cuts[1:], strict=True)]


def _told(blobs: list[bytes], kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The keys and numbers that ``_dealt`` packed."""
    got = [_unpack(blob, [np.uint8, np.uint8]) for blob in blobs]
    keys = [np.cumsum(_whole(k, np.uint64), dtype=np.uint64) for k, _ in got]
    return np.concatenate([np.zeros(0, np.uint64), *keys]), np.concatenate([np.zeros(0, kind), *(_whole(x, kind) for _, x in got)])


def _by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int, bytes]]]:
    """The packed rows (part, kind, blob) of each part of a task."""
    got: dict[int, list] = {}
    for b in batches:
        for part, kind, blob in zip(*(c.to_pylist() for c in b.columns), strict=True):
            got.setdefault(part, []).append((kind, blob))
    while got:
        yield got.popitem()[1]


def _let_go(spark: SparkSession) -> None:
    """Spark deletes the shuffle files of plans that nothing holds any more when the driver's memory is swept, which it seldom needs to be.
    Its event loops hold the last job until there is another."""
    gc.collect()
    spark.range(0, 1, 1, 1).collect()
    spark._jvm.System.gc()


def _sliced(b: pa.RecordBatch, step: int = 100_000) -> Iterator[pa.RecordBatch]:
    for at in range(0, b.num_rows, step):
        yield b.slice(at, step)


_PACKED = "part int, kind int, blob binary"
_PAIRS = [np.uint64, np.uint64, np.int32, np.uint64, np.int64]  # contexts, their suffixes, their pairs; symbols, counts


def _packed(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    part, kind, blob = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(kind, pa.int32()), pa.array(blob, pa.binary())], names=["part", "kind", "blob"])


def _combined(context: np.ndarray, symbol: np.ndarray, suffix: np.ndarray, n: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs (context, symbol) with their counts summed, by context."""
    key = _turn(context) ^ symbol
    order = _order(key)
    key = key[order]
    first = _runs(key)
    n = np.diff(np.r_[first, len(key)]).astype(np.int64) if n is None else np.add.reduceat(n[order], first) if len(first) else n
    at = order[first]
    by = _order(context[at])
    at = at[by]
    return context[at], symbol[at], suffix[at], n[by]


def _followers(texts: DataFrame, filters: list, cut: tuple | None, hot: np.ndarray) -> DataFrame:
    """Of the contexts of len(filters) words: rows (context, suffix, total, followers, seen) with null in symbol and n, and
    the pairs with a symbol seen MIN_NEXT times (context, symbol, suffix, n, total, seen). Contexts are dealt by their hash; the frequent ones,
    hot (sorted), by their pairs', so they have a row for each part, and nulls in their pairs' total and seen."""
    spark = texts.sparkSession
    sent, hot_sent = spark.sparkContext.broadcast(filters), spark.sparkContext.broadcast(hot)
    rows, read = _contexts(texts, cut)
    parts = _parts(spark)[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        new, size = [], 0

        def dealt() -> pa.RecordBatch:
            context, symbol, suffix, n = _combined(*(np.concatenate(x) for x in zip(*new, strict=True)), None)
            is_hot = _find(hot_sent.value, context) >= 0
            out = []
            for which in (~is_hot, is_hot):
                c, s, x, m = (v[which] for v in (context, symbol, suffix, n))
                part = _part_of(_turn(c) ^ s if which is is_hot else c, parts)
                if which is is_hot:
                    by = np.argsort(part, kind="stable")
                    c, s, x, m, part = (v[by] for v in (c, s, x, m, part))
                cuts = np.r_[_runs(part), len(part)]
                for a, z in zip(cuts[:-1], cuts[1:], strict=True):
                    f = _runs(c[a:z])
                    out.append((int(part[a]), 0, _pack(c[a:z][f], x[a:z][f], np.diff(np.r_[f, z - a]).astype(np.int32), s[a:z], m[a:z])))
            return _packed(out)

        for b in batches:
            for tokens, _, short, keys, counted, _ in read(b, sent.value):
                at = np.flatnonzero(counted)
                new.append((keys[at], tokens[at], short[at]))
                size += len(at)
                if size > 3_000_000:
                    yield dealt()
                    new, size = [], 0
        if size:
            yield dealt()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in _by_part(batches):
            columns = [_unpack(blob, _PAIRS) for _, blob in got]
            context, suffix = (np.concatenate([np.repeat(c[i], c[2]) for c in columns]) for i in (0, 1))
            symbol, n = (np.concatenate([c[i] for c in columns]) for i in (3, 4))
            context, symbol, suffix, n = _combined(context, symbol, suffix, n)
            first = _runs(context)
            names, followers = context[first], np.diff(np.r_[first, len(context)])
            total, seen = np.add.reduceat(n, first), np.add.reduceat(np.where(n >= MIN_NEXT, n - DISCOUNT, 0.0), first)
            split = _find(hot_sent.value, names) >= 0
            kept = split | (total >= MIN_CONTEXT)
            pair = np.repeat(kept, followers) & (n >= MIN_NEXT)
            none = np.zeros(int(kept.sum()), np.int64)
            yield from _sliced(pa.RecordBatch.from_arrays([pa.array(signed(names[kept])), pa.array(none, mask=none == 0), pa.array(signed(suffix[first][kept])), pa.array(none, mask=none == 0), pa.array(total[kept]), pa.array(seen[kept]), pa.array(followers[kept])], names=names_of))
            of, open_ = np.repeat(np.arange(len(first)), followers)[pair], np.repeat(split, followers)[pair]
            yield from _sliced(pa.RecordBatch.from_arrays([pa.array(signed(context[pair])), pa.array(signed(symbol[pair])), pa.array(signed(suffix[pair])), pa.array(n[pair]), pa.array(total[of], mask=open_), pa.array(seen[of], mask=open_), pa.array(followers[of], mask=open_)], names=names_of))

    names_of = ["context", "symbol", "suffix", "n", "total", "seen", "followers"]
    out = materialize(rows.mapInArrow(run, _PACKED).repartition("part").mapInArrow(count, "context long, symbol long, suffix long, n long, total long, seen double, followers long"), "lm_followers")
    for done in (sent, hot_sent):
        done.destroy()
    return out


def _level(texts: DataFrame, filters: list, cut: tuple | None, hot: np.ndarray, lower: tuple[DataFrame, DataFrame] | None, root: DataFrame) -> tuple[DataFrame, DataFrame, KeyFilter]:
    """Of one depth: candidate contexts (context, suffix, total, left, diverges, grows), stored symbols (context, symbol, n, p,
    value: log10 of p by back-off's), and a filter of the frequent sequences that were counted. root: symbol, below. Stored
    symbols may be of contexts that are no candidates: those are not used. Joins hash the side whose keys are distinct: they are dealt
    evenly, and the other side needs no sort."""
    got = _followers(texts, filters, cut, hot)
    left = 1 - F.col("seen") / F.col("total")
    whole = got.filter("n is null").groupBy("context").agg(F.min("suffix").alias("suffix"), F.sum("total").alias("total"), (F.sum("followers") > 1).alias("several"), F.sum("seen").alias("seen"))
    contexts = whole.select("context", "suffix", "total", "several", left.alias("left"))
    if lower:
        parent = lower[0].filter("grows").select(F.col("context").alias("suffix"), F.col("diverges").alias("shorter_diverges"))
        contexts = contexts.join(parent.hint("shuffle_hash"), "suffix")  # exactly those whose suffix is extended
    else:
        contexts = contexts.withColumn("shorter_diverges", F.lit(True))
    stored = got.filter("n is not null").select("context", "symbol", "suffix", "n", "total", left.alias("left"))
    if len(hot):  # at most 1 / P_CONTEXT
        split = texts.sparkSession.createDataFrame(pa.table({"context": signed(hot)}))
        split = whole.join(F.broadcast(split), "context", "left_semi").select("context", F.col("total").alias("_total"), left.alias("_left"))
        stored = stored.join(F.broadcast(split), "context", "left").withColumns({"total": F.coalesce("total", "_total"), "left": F.coalesce("left", "_left")}).drop("_total", "_left")
    if lower:
        shorter = lower[1].select(_longer(F.col("context"), F.col("symbol")).alias("shorter"), F.col("p").alias("below"))
        stored = stored.withColumn("shorter", _longer(F.col("suffix"), F.col("symbol"))).join(shorter.hint("shuffle_hash"), "shorter")
    else:
        stored = stored.join(root.hint("shuffle_hash"), "symbol")
    stored = stored.withColumn("p", (F.col("n") - DISCOUNT) / F.col("total") + F.col("left") * F.col("below"))
    stored = materialize(stored.select("context", "symbol", "n", "p", "left", (F.log10("p") - F.log10("below") - F.log10("left")).alias("value")), "lm_stored")
    frequent = KeyFilter(got.filter(F.col("n") >= MIN_CONTEXT).select(_longer(F.col("context"), F.col("symbol"))))
    sums = stored.groupBy("context").agg(F.sum(F.col("p") * F.col("value")).alias("gain"), F.sum("p").alias("p"), F.sum(F.col("p") / F.pow(F.lit(10.0), "value")).alias("below"))
    # p = value * left * below of stored symbols, and left * below of the rest
    divergence = F.col("gain") * float(np.log(10)) + (F.col("p") + F.col("left") - F.col("below")) * F.log("left")
    out = contexts.join(sums.hint("shuffle_hash"), "context", "left").withColumn("diverges", F.coalesce(divergence >= MIN_DIVERGENCE, F.lit(False)))
    out = out.withColumn("grows", F.col("several") & (F.col("diverges") | F.col("shorter_diverges")))
    out = materialize(out.drop("gain", "p", "below", "several", "shorter_diverges"), "lm_level")
    discard(got)
    _let_go(texts.sparkSession)
    return out, stored, frequent


def _values(levels: list[tuple[DataFrame, DataFrame]]) -> tuple[DataFrame | None, list[DataFrame]]:
    """(key, n, value) of every sequence that has a number, or two to be summed (n is its count in both), and the states of each level. A state's number is its log10
    back-off weight; that of a stored symbol's sequence is what it is more probable than by back-off. So the numbers of all
    sequences that end at a position or before it sum up along the suffixes to the probability in the longest state."""
    parts, states, closed = [], [], None
    for contexts, stored in reversed(levels):
        kept = contexts.filter("diverges").select("context")
        if closed is not None:
            kept = kept.unionByName(closed).distinct()
        kept = materialize(contexts.join(kept.hint("shuffle_hash"), "context", "left_semi").select("context", "suffix", "total", "left"), "lm_states")
        closed = kept.select(F.col("suffix").alias("context")).distinct()
        states.insert(0, kept)
        parts.append(kept.select(F.col("context").alias("key"), F.col("total").alias("n"), F.log10("left").alias("value")))
        parts.append(stored.join(kept.select("context").hint("shuffle_hash"), "context", "left_semi").select(_longer(F.col("context"), F.col("symbol")).alias("key"), "n", "value"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out, states


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(keys, n, value) of ``DEALT_BATCHES`` batches at a time."""
    held: list[pa.RecordBatch] = []
    for b in chain(batches, [None]):
        held += [b] if b is not None and b.num_rows else []
        if held and (b is None or len(held) >= DEALT_BATCHES):
            t = pa.Table.from_batches(held).combine_chunks()
            held = []
            yield t.column(0).to_numpy().view(np.uint64), t.column(1).to_numpy(), t.column(2).to_numpy()


def _packed_values(values: DataFrame, hot_from: float) -> DataFrame:
    """The numbers (key, n, value) packed by part; those of sequences that occur ``hot_from`` times are of kind 3, all others of kind 2."""
    parts = _parts(values.sparkSession)[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, n, value in _gathered(batches):
            by = _order(keys)
            keys, value, hot = keys[by], value[by], n[by] >= hot_from
            yield _packed(_dealt(2, keys[~hot], value[~hot], parts) + _dealt(3, keys[hot], value[hot], parts))

    return values.select("key", F.col("n").cast("long").alias("n"), "value").mapInArrow(run, _PACKED)


def train(texts: DataFrame) -> tuple[Tree, DataFrame]:
    """The tree, and the table of what tasks do not know, packed by part: counts of words (kind 1), numbers of sequences (2)."""
    unigrams = materialize(_unigrams(texts), "unigrams")
    total, vocabulary = unigrams.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    total, vocabulary = int(total), int(vocabulary)
    frequent = unigrams.filter(F.col("n") >= P_JOINT * total).toPandas().sort_values("key")
    tree = Tree(frequent["key"].to_numpy(np.int64), frequent["n"].to_numpy(np.int64), total, vocabulary)
    root = unigrams.filter(F.col("n") >= MIN_NEXT).select(F.col("key").alias("symbol"), ((F.col("n") + 1.0) / float(tree.z)).alias("below"))
    levels: list[tuple[DataFrame, DataFrame]] = []
    words = unigrams.filter(F.col("n") >= MIN_CONTEXT)
    filters = [(None, KeyFilter(words.select("key")))]
    split = F.col("n") >= max(MIN_CONTEXT, P_CONTEXT * total)
    hot = words.filter(split & (F.col("key") != int(signed(END.reshape(1))[0]))).select("key")
    cut, cut_size, kept_words = None, 0, KEPT_WORDS
    while not levels or filters[-1][0].size:
        depth = len(levels) + 1
        if depth >= CUT_FROM and (cut is None or depth > cut[2]):
            if cut:
                discard(cut[0])
                kept_words *= 4
            cut, cut_size = (_cut(texts, filters, kept_words), depth, kept_words), filters[-1][0].size
        elif cut and depth < kept_words and 2 * filters[-1][0].size < cut_size:  # few are left
            old, cut = cut, (_cut(texts, filters, kept_words, cut), depth, kept_words)
            cut_size = filters[-1][0].size
            discard(old[0])
        spread = np.sort(hot.toArrow().column("key").to_numpy().view(np.uint64))
        contexts, stored, frequent = _level(texts, filters, cut, spread, levels[-1] if levels else None, root)
        levels.append((contexts, stored))
        hot = stored.filter(split).select(_longer(F.col("context"), F.col("symbol")).alias("key"))
        filters.append((KeyFilter(contexts.filter("grows").select("context")), frequent))
    if cut:
        discard(cut[0])
    values, states = _values(levels)
    values = materialize(_packed_values(values, P_JOINT * total), "lm_values")
    known, number = _by_key(*_told(values.filter("kind = 3").toArrow().column("blob").to_pylist(), np.float64))
    tree.keys, tree.values, tree.depth = signed(known), number, len(levels)
    tree.stored = KeyFilter(values.select("blob"), 28, lambda b: [_told([x.as_py()], np.float64)[0] for x in b.column(0)])
    hot = F.col("n") >= P_JOINT * total
    for level, ((_, stored), kept) in enumerate(zip(levels[:2], states, strict=False)):
        near = stored.filter(hot).join(kept.filter(F.col("total") >= P_CONTEXT * total).select("context", "suffix"), "context")
        tree.add_level(level, near.select("context", "symbol", "suffix", "p").toArrow())
    for done in [*[x for level in levels for x in level], *states]:
        discard(done)
    parts = _parts(texts.sparkSession)[1]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, n, _ in _gathered(batches):
            by = _order(keys)
            yield _packed(_dealt(1, keys[by], n[by], parts))

    rest = unigrams.filter(F.col("n") < P_JOINT * total).select("key", "n", F.lit(0.0).alias("value"))
    table = rest.mapInArrow(deal, _PACKED).unionByName(values.filter("kind = 2"))
    table._spanforge_tables = (unigrams, values)  # of use until the scores are told
    _let_go(texts.sparkSession)
    return tree, table


def _questions(keys: np.ndarray, rows: np.ndarray, base: int, parts: int) -> pa.RecordBatch:
    """What tasks ask of the table: keys, in order, and the numbers of their rows from ``base`` on."""
    by = _order(keys)
    keys, rows = keys[by], rows[by].astype(np.int32)
    part = _part_of(keys, parts)
    cuts = np.r_[_runs(part), len(part)]
    out = []
    for a, z in zip(cuts[:-1], cuts[1:], strict=True):
        out.append((int(part[a]), 0, _pack(np.array([base], np.int64), _planes(np.diff(keys[a:z], prepend=np.uint64(0))), _planes(rows[a:z]))))
    return _packed(out)


def _answers(got: list[tuple[int, bytes]]) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Of one part's questions, by the row they count from: row, known words, what words add and what sequences add."""
    words, counts = _told([blob for kind, blob in got if kind == 1], np.int64)
    keys, values = _told([blob for kind, blob in got if kind == 2], np.float64)
    keys, values = _by_key(keys, values)  # a sequence can be a state and a stored symbol's
    words, keys, logs = Index(words), Index(keys), np.log10(counts + 1.0)
    for kind, blob in got:
        if kind:
            continue
        base, ask, row = _unpack(blob, [np.int64, np.uint8, np.uint8])
        ask, row = np.cumsum(_whole(ask, np.uint64), dtype=np.uint64), _whole(row, np.int32)
        at, on = words.find(ask), keys.find(ask)
        hit = (at >= 0) | (on >= 0)
        at, on, row = at[hit], on[hit], row[hit]
        add = np.where(at >= 0, logs[at], 0.0) if len(logs) else np.zeros(len(at))
        gain = np.where(on >= 0, values[on], 0.0) if len(values) else np.zeros(len(on))
        yield int(base[0]), [row, (at >= 0).astype(np.int64), add, gain]


def _summed(row: np.ndarray, *columns: np.ndarray) -> list[np.ndarray]:
    """The columns summed by row, rows being numbers of texts that ask together."""
    at = np.flatnonzero(np.bincount(row))
    return [at.astype(np.int32), *[np.bincount(row, c)[at] for c in columns]]


_SUMS = [np.int32, np.int32, np.float64, np.float64]  # rows, known words, what words and sequences add


def score(docs: DataFrame, tree: Tree, table: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns and n_tokens, n_known, train_tokens, base_score, score of every row. Rows go with what their tasks know of them through
    the one shuffle that takes the questions to the table's parts. Rows that ask together have one home; what a task answers them
    comes home in packed arrays, a row for each home. The texts go in ``ROUNDS``, by hash."""
    rows = docs.select(*keep, F.col("text").cast("string").alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(tree)
    partitions, parts = _parts(docs.sparkSession)
    kinds = ["row long", "n_tokens long", "known long", "base double", "own double", "home long"]
    numbers = [x.split()[0] for x in kinds]
    kept = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    width = len(keep) + len(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        model, base = sent.value, TaskContext.get().partitionId() << 40
        done = since = size = 0
        new, none = [], []
        names = [*keep, *numbers, "part", "kind", "blob"]

        def asked() -> pa.RecordBatch:
            out = _questions(*(np.concatenate(x) for x in zip(*new, strict=True)), base + since, parts)
            return pa.RecordBatch.from_arrays([*[pa.nulls(out.num_rows, x) for x in none], *out.columns], names=names)

        for b in batches:
            out, first = [], done
            for tokens, lens in _tokens(b.column(len(keep))):
                own, z, known, rare, whose = model.score(tokens, lens)
                out.append((lens, known, z, own))
                new.append((rare, whose + (done - since)))
                size += len(rare)
                done += len(lens)
            if done == first:
                continue
            row = np.arange(first, done) + base
            made = [*b.columns[: len(keep)], pa.array(row), *[pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], pa.array(np.full(len(row), base + since))]
            none = [x.type for x in made]
            yield pa.RecordBatch.from_arrays([*made, pa.array((row % parts).astype(np.int32)), pa.nulls(len(row), pa.int32()), pa.nulls(len(row), pa.binary())], names=names)
            if size > 3_000_000:
                yield asked()
                new, size, since = [], 0, done
        if size:
            yield asked()

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed, types, names = [], None, [*keep, *numbers, "blob"]
        for b in batches:
            types = [x.type for x in b.columns[:width]]
            packed.append(b.select(range(width, width + 3)).filter(b.column(width + 2).is_valid()))
            own = b.filter(b.column(len(keep)).is_valid())
            yield pa.RecordBatch.from_arrays([*own.columns[:width], pa.nulls(own.num_rows, pa.binary())], names=names)
        homes: dict[int, list] = {}
        for got in _by_part(packed):
            for home, sums in _answers(got):
                homes.setdefault(home, []).append(_summed(*sums))
        while homes:
            home, got = homes.popitem()
            row, known, add, gain = _summed(*(np.concatenate(x) for x in zip(*got, strict=True)))
            blob = _pack(_planes(np.diff(row, prepend=row.dtype.type(0))), _planes(known.astype(np.int32)), _planes(add), _planes(gain))
            blank = [pa.nulls(1, x) for x in types]
            blank[width - 1] = pa.array([home])
            yield pa.RecordBatch.from_arrays([*blank, pa.array([blob], pa.binary())], names=names)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told, own = {}, []
        for b in batches:
            is_own = b.column(len(keep)).is_valid()
            own.append(b.filter(is_own).select(range(width)))
            blobs = b.filter(pc.invert(is_own))
            for home, blob in zip(blobs.column(width - 1).to_pylist(), blobs.column(width).to_pylist(), strict=True):
                told.setdefault(home, []).append(blob)
        if not own:
            return
        t = pa.Table.from_batches(own).combine_chunks()
        row, n_tokens, known, base, score, home = (t.column(i).to_numpy() for i in range(len(keep), width))
        known, base, score = known.copy(), base.copy(), score.copy()
        by = np.argsort(row)
        for at, blobs in told.items():
            for x in blobs:
                x = [_whole(c, kind) for c, kind in zip(_unpack(x, [np.uint8] * 4), _SUMS, strict=True)]
                place = by[np.searchsorted(row, np.cumsum(x[0]) + at, sorter=by)]
                known[place] += x[1]
                base[place] += x[2]
                score[place] += x[2] + x[3]
        out = pa.Table.from_arrays([*t.columns[: len(keep)], *map(pa.array, (n_tokens, known, base, score))], names=[*keep, "n_tokens", "n_known", "base_score", "score"])
        yield from out.to_batches(max_chunksize=10_000)

    out = None
    for i in range(ROUNDS):
        asked = rows.filter(F.pmod(F.xxhash64("text"), F.lit(ROUNDS)) == i).mapInArrow(run, f"{kept}, {', '.join(kinds)}, {_PACKED}")
        both = asked.unionByName(table, allowMissingColumns=True)
        told = both.repartition(partitions, "part").mapInArrow(answer, f"{kept}, {', '.join(kinds)}, blob binary")
        told = materialize(told, "lm_rows")
        del asked, both
        _let_go(docs.sparkSession)
        told = told.repartition(partitions, "home").mapInArrow(add_up, f"{kept}, n_tokens long, n_known long, base_score double, score double")
        out = told if out is None else out.unionByName(told)
    sent.destroy()
    for done in getattr(table, "_spanforge_tables", ()):
        discard(done)
    return out.select(*keep, "n_tokens", "n_known", F.lit(tree.total).cast("long").alias("train_tokens"), "base_score", "score")


def language_model(docs: DataFrame) -> DataFrame:
    small_batches(docs.sparkSession)
    held = F.coalesce(crc_mod("doc_id", 7) == 2, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), F.col("text").cast("string").alias("text"))
    tree, table = train(rows.filter(~F.col("held_out")).select("text"))
    return score(rows, tree, table, ["doc_id", "held_out"])


def op4_suffix_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model(documents(spark, sf_dir))


QUERIES = {"op4_suffix_tree_lm": op4_suffix_tree_lm}
ORACLE: dict[str, str] = {}

"""Exact Jaccard self-join of word-shingle sets with PartEnum signatures.

Sets of similar size share a zone of two neighbouring size bands. In a zone, two sets that are similar enough differ in
at most k shingles. The shingle domain is cut into k // 2 + 1 + e first-level partitions of ``CELLS`` second-level ones each. At
least 1 + e first-level partitions then hold one difference at most, so the sets agree there on a subset of ``CELLS`` - 1
second-level partitions; all these subsets are enumerated, and a signature is the hash of what a set has in one. The e extra
partitions make up for those in which a subset is empty: empty subsets are signatures only of sets with more than e such
partitions, so no link is lost and emptiness links nothing.

Equal sets are one node (the set's hash). Then:

1. Signatures are combined inside each task (rows after the first of a signature become links to that first node and
   are not shuffled by signature), then dealt by signature: a bucket's nodes link to its smallest node (a star).
2. Links that pass an exact lower bound of the difference (``BINS`` shingle counts a node) are verified on whole sets;
   verified links give components.
3. Buckets whose nodes are still in several components get stars around ``STARS`` other nodes, verified in the same way. What is still in
   several components is compared in blocks of ``BLOCK`` nodes: pairs of different components that pass the bound are
   verified. So every link is found or already implied.

Defined results: null text, or no words: an empty set, linked with nothing, its own component; rows with a null doc_id
get a null component and link nothing; equal texts share a component; rows that repeat a doc_id are sets of their own, each
with its own component; an empty table gives an empty result; extra columns are ignored. Shingles and sets are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BitFilter, by_partition, discard, distinct, documents, materialize, mix64, shingle_hashes, signed, word_hashes
from .graph import components

WORDS, PERCENT, BLOCK = 4, 85, 512
#: Second-level partitions of a first-level one; counts of a node for stars and for blocks; stars of a bucket before its blocks.
CELLS, BINS, FINE, STARS = 3, 128, 512, 3


def slack(total: np.ndarray | int, percent: int):
    """Largest difference |A - B| + |B - A| that two sets of ``total`` elements together may have."""
    return total - 2 * (-(-percent * total // (100 + percent)))


class Zones:
    """Size bands for a similarity: a set of band i meets its partners in zone i (with band i + 1) and zone i - 1."""

    def __init__(self, percent: int):
        self.percent, self.low = percent, [0, 1]
        self._plans: dict[int, tuple[int, int]] = {}

    def band(self, n: int) -> int:
        while self.low[-1] <= n:
            self.low.append(max(self.low[-1] + 1, 100 * (self.low[-1] - 1) // self.percent + 1))
        return int(np.searchsorted(self.low, n, side="right")) - 1

    def parts(self, zone: int) -> tuple[int, int]:
        """(number of first-level partitions, extra ones) of a zone; (0, 0) if its pairs can only be equal sets."""
        if zone not in self._plans:
            self.band(self.low[min(zone + 1, len(self.low) - 1)] + 1)
            while len(self.low) < zone + 3:
                self.band(self.low[-1])
            big = self.low[zone + 1] - 1
            total = big + 100 * big // self.percent
            k = max((slack(s, self.percent) for s in range(max(2, total - 40), total + 1)), default=0)
            k = max(k, 0)
            parts = k // 2 + 1
            each = self.low[zone] / parts
            thin = min(1.0, CELLS * np.exp(-each * (CELLS - 1) / CELLS))  # how likely a partition has an empty subset
            extra = 1 + int(3 * parts * thin)
            self._plans[zone] = (parts + extra, extra) if k else (0, 0)
        return self._plans[zone]


def signatures(h: np.ndarray, zones: Zones) -> np.ndarray:
    """PartEnum signatures (uint64) of a set of distinct hashes."""
    n = len(h)
    if not n:
        return h
    band = zones.band(n)
    out = []
    for zone in (band, band - 1):
        m, extra = zones.parts(zone) if zone >= 1 else (0, 0)
        if not m:
            continue
        x = mix64(h ^ np.uint64(0x51ED270B * (zone + 1)))
        cells = m * CELLS
        cell = ((x >> np.uint64(32)) * np.uint64(cells) >> np.uint64(32)).astype(np.int64)
        sums = [np.bincount(cell, weights=w, minlength=cells).reshape(m, CELLS) for w in (None, (x & np.uint64(0x3FFFFFF)).astype(float), (h & np.uint64(0x3FFFFFF)).astype(float))]
        filled, low, high = (y.sum(axis=1, keepdims=True) - y for y in sums)  # of each subset, by the second-level partition it leaves out
        sig = low.astype(np.uint64) ^ (high.astype(np.uint64) << np.uint64(30))
        sig = mix64(sig ^ mix64(np.arange(cells, dtype=np.uint64).reshape(m, CELLS) + np.uint64(zone << 32)))
        sig = sig[filled > 0] if np.count_nonzero((filled == 0).any(axis=1)) <= extra else sig.ravel()
        out.append(sig)
    return np.concatenate(out) if out else h[:0]


def _name(h: np.ndarray) -> int:
    """A set's hash: of the sum of its mixed members and its size; 0 for the empty set."""
    return int(mix64(mix64(h ^ np.uint64(0xA5A5A5A5)).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(h)))[0].astype(np.int64)) if len(h) else 0


def _bins(h: np.ndarray) -> np.ndarray:
    return np.bincount((h >> np.uint64(64 - FINE.bit_length() + 1)).astype(np.int64), minlength=FINE)


def _bytes(counts: np.ndarray) -> bytes:
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def sets(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n (set size), k1 (hash of the set), bins and fine (``BINS`` and ``FINE`` shingle counts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, k1, bins, fine = [], [], [], []
            for t in b.column(1).to_pylist():
                h = shingle_hashes(word_hashes(t), words)
                n.append(len(h))
                k1.append(_name(h))
                counts = _bins(h)
                fine.append(_bytes(counts))
                bins.append(_bytes(counts.reshape(BINS, -1).sum(axis=1)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(k1, pa.int64()), pa.array(bins, pa.binary()), pa.array(fine, pa.binary())], names=["doc_id", "n", "k1", "bins", "fine"])

    return _plain(docs).mapInArrow(run, "doc_id long, n long, k1 long, bins binary, fine binary")


def _signature_rows(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(key, sig, node, head) of sets. Of 1000 documents, equal sets give their rows once, and rows after a signature's first carry that
    first node as head and a key of their own, so that a hot signature or a group of copies is spread."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zones = Zones(percent)
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                own: dict[int, np.ndarray] = {}
                for d, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    if d is not None:
                        h = shingle_hashes(word_hashes(t), words)
                        name = _name(h)
                        if name not in own:
                            own[name] = signatures(h, zones).view(np.int64)
                sig = np.concatenate([np.zeros(0, np.int64), *own.values()])
                node = np.repeat(np.fromiter(own, np.int64, len(own)), [len(x) for x in own.values()])
                order = np.lexsort((node, sig))
                node, sig = node[order], sig[order]
                first = np.r_[True, sig[1:] != sig[:-1]][: len(sig)]
                head = node[np.maximum.accumulate(np.where(first, np.arange(len(sig)), 0))]
                key = np.where(first, sig, signed(mix64(node.view(np.uint64) ^ sig.view(np.uint64))))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (key, sig, node, head)], names=["key", "sig", "node", "head"])

    return _plain(docs).mapInArrow(read, "key long, sig long, node long, head long")


def _buckets(rows: DataFrame) -> DataFrame:
    """(sig, node, head) of signatures that several nodes share; the head is a smaller node of the bucket."""

    def run(t: pa.Table) -> Iterator[pa.RecordBatch]:
        sig, node, head = (t.column(c).to_numpy() for c in ("sig", "node", "head"))
        local = node != head  # these come from a task's own combination
        out = [(sig[local], node[local], head[local])]
        sig, node = sig[~local], node[~local]
        order = np.lexsort((node, sig))
        sig, node = sig[order], node[order]
        first = np.r_[True, sig[1:] != sig[:-1]][: len(sig)]
        least = node[np.maximum.accumulate(np.where(first, np.arange(len(sig)), 0))] if len(sig) else node
        other = node != least
        out.append((sig[other], node[other], least[other]))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], names=["sig", "node", "head"])

    return by_partition(rows.repartition("key").drop("key"), run, "sig long, node long, head long")


def _bounded(pairs: DataFrame, info: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sizes and shingle counts allow the similarity."""
    left = info.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("bins").alias("ba"))
    right = info.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("bins").alias("bb"))
    sized = pairs.join(left, "a").join(right, "b").filter(F.greatest("na", "nb") * percent <= F.least("na", "nb") * 100)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            x, y = (np.frombuffer(b"".join(t.column(c).to_pylist()), np.uint8).reshape(-1, BINS).astype(np.int16) for c in (2, 3))
            total = t.column(4).to_numpy()
            ok = np.abs(x - y).sum(axis=1) <= slack(total, percent)
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(ok)) for c in t.columns[:2]], names=["a", "b"])

    return sized.select("a", "b", "ba", "bb", F.expr("na + nb").alias("total")).mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, docs: DataFrame, heads: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs (a, b) of nodes whose whole sets are similar enough; heads: node, doc_id of one of its rows."""
    pairs = materialize(pairs, "pairs")
    nodes = materialize(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct().join(heads.select("node", "doc_id"), "node"), "nodes")
    wanted = BitFilter(nodes, "doc_id")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            b = b.filter(pa.array(wanted.passes(b.column(2).to_numpy())))
            for at in range(0, b.num_rows, 1000):
                sets = [shingle_hashes(word_hashes(t), words) for t in b.column(1).slice(at, 1000).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array([_name(h) for h in sets], pa.int64()), pa.array([h.tobytes() for h in sets], pa.binary())], names=["node", "set"])

    got = wanted.column(_plain(docs).filter("doc_id is not null"), "doc_id").mapInArrow(read, "node long, set binary")
    got = materialize(got.join(nodes.select("node"), "node", "left_semi").dropDuplicates(["node"]), "sets")
    both = pairs.join(got.select(F.col("node").alias("a"), F.col("set").alias("x")), "a").join(got.select(F.col("node").alias("b"), F.col("set").alias("y")), "b").select("a", "b", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            ok = []
            for x, y in zip(t.column(2), t.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(x) + len(y) - len(distinct(np.concatenate([x, y])))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(ok, pa.bool_())) for c in t.columns[:2]], names=["a", "b"])

    links = materialize(both.mapInArrow(run, "a long, b long"), "links")
    for done in (pairs, nodes, got):
        discard(done)
    return links


def _mixed(members: DataFrame, comp: DataFrame) -> DataFrame:
    """sig, node, component, size of the buckets whose nodes are in several components; of buckets with the same nodes, one."""
    rows = members.join(comp, "node", "left").select("sig", "node", F.coalesce("component", "node").alias("component"))
    mixed = rows.groupBy("sig").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("node")).alias("who")).filter("lo <> hi and size > 2")
    mixed = mixed.groupBy("who", "size").agg(F.min("sig").alias("sig"))
    return materialize(rows.join(mixed.select("sig", "size"), "sig"), "mixed")


def _pivots(mixed: DataFrame) -> DataFrame:
    """(a, b): each node of a bucket with ``STARS`` others, if they are in different components."""
    turn = [F.min(F.struct(F.xxhash64("node", F.lit(t)).alias("turn"), F.col("node").alias("head"), F.col("component").alias("other"))) for t in range(STARS)]
    pivot = mixed.groupBy("sig").agg(F.array(*turn).alias("p")).select("sig", F.explode("p").alias("p")).select("sig", "p.head", "p.other")
    return mixed.join(pivot, "sig").filter("component <> other").select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b")).distinct()


def _blocks(mixed: DataFrame, info: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that share a bucket and pass the bound."""
    rows = mixed.join(info.select("node", "n", "fine"), "node").withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("long"))
    rows = rows.withColumn("mine", F.pmod(F.xxhash64("node", "sig"), F.col("blocks"))).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.select("sig", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "node", "component", "n", "fine")

    def run(t: pa.Table) -> Iterator[pa.RecordBatch]:
        sig, i, j, mine, node, comp, n = (t.column(c).to_numpy() for c in range(7))
        bins = np.frombuffer(b"".join(t.column(7).to_pylist()), np.uint8).reshape(-1, FINE)
        order = np.lexsort((j, i, sig))
        cut = np.flatnonzero(np.r_[True, (np.diff(sig[order]) != 0) | (np.diff(i[order]) != 0) | (np.diff(j[order]) != 0)])
        a_out, b_out = [], []
        for s, e in zip(cut, np.r_[cut[1:], len(order)], strict=True):
            g = order[s:e]
            left = g[mine[g] == i[g]]
            right = g[mine[g] == j[g]]
            for x in left:
                total = n[x] + n[right]
                near = right[(comp[right] != comp[x]) & (np.maximum(n[x], n[right]) * percent <= np.minimum(n[x], n[right]) * 100)]
                if len(near):
                    total = n[x] + n[near]
                    near = near[np.abs(bins[near].astype(np.int16) - bins[x].astype(np.int16)).sum(axis=1) <= slack(total, percent)]
                    a_out.append(np.minimum(node[near], node[x]))
                    b_out.append(np.maximum(node[near], node[x]))
        a, b = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (a_out, b_out))
        order = np.lexsort((b, a))  # buckets share pairs
        a, b = a[order], b[order]
        first = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])][: len(a)]
        yield pa.RecordBatch.from_arrays([pa.array(a[first]), pa.array(b[first])], names=["a", "b"])

    return by_partition(rows.repartition("sig", "i", "j"), run, "a long, b long").distinct()


def join(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, set_id (smallest doc_id with the same set), component_id for every row."""
    info = materialize(sets(docs, words), "sets")
    named = info.filter("n > 0 and doc_id is not null")
    heads = materialize(named.groupBy(F.col("k1").alias("node")).agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("bins").alias("bins"), F.first("fine").alias("fine")), "nodes")
    buckets = materialize(_buckets(_signature_rows(docs, words, percent)), "buckets")
    star = buckets.select(F.least("head", "node").alias("a"), F.greatest("head", "node").alias("b")).distinct()
    links = _verified(_bounded(star, heads, percent), docs, heads, words, percent)
    comp = materialize(components(links), "components")
    members = buckets.select("sig", "node").unionByName(buckets.select("sig", F.col("head").alias("node"))).distinct()
    mixed = _mixed(members, comp)
    discard(buckets)
    for step in (_pivots, _blocks):
        if mixed.isEmpty():
            break
        more = _verified(_bounded(_pivots(mixed), heads, percent) if step is _pivots else _blocks(mixed, heads, percent), docs, heads, words, percent)
        if not more.isEmpty():
            before, both = (links, comp, mixed), links.unionByName(more)
            comp = materialize(components(both), "components")
            links, mixed = materialize(both, "links"), _mixed(mixed.select("sig", "node"), comp)
            for done in before:
                discard(done)
        discard(more)
    for done in (links, mixed):
        discard(done)
    # every set's first row, and the first of its component; empty sets are their own
    own = heads.select("node", F.col("doc_id").alias("set_id")).join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))
    first = own.groupBy("component").agg(F.min("set_id").alias("component_id"))
    own = materialize(own.join(first, "component").select("node", "set_id", "component_id"), "classes")
    for done in (heads, comp):
        discard(done)
    alone = F.expr("n = 0 or doc_id is null")
    got = info.filter(~alone).join(own, F.col("k1") == F.col("node")).select("doc_id", F.col("n").alias("n_shingles"), "set_id", "component_id")
    return got.unionByName(info.filter(alone).select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("set_id"), F.col("doc_id").alias("component_id")))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id", "set_id")


QUERIES = {"op2_ngram_jaccard_join": op2_ngram_jaccard_join}
ORACLE: dict[str, str] = {}

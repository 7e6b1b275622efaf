"""Quality classifier from weak labels: EM over overlapping heuristic labellers, then a hashed linear scorer.

Ten heuristics look at the whole text and vote good (1), bad (0) or abstain (2). The votes of all documents are counted
by pattern (at most 3**10 of them, however large the corpus); expectation-maximisation on the counts estimates each
labeller's accuracies and the posterior of each pattern, without gold labels. Posteriors of a bounded sample
(``TRAIN_DOCS`` documents with the smallest hashes of their ids) train a linear scorer over hashed word shapes, shape pairs
and repetition marks by FTRL; its weights (2**BITS floats) are broadcast and every document is scored where it is read.

A document is kept if its mean of posterior and score is at least ``KEEP``. Defined results: null or empty text has only
abstentions, so the prior decides (kept); repeated rows score alike; an empty table gives an empty result; ids may be
null (not sampled for training, scored nevertheless); input columns named ``posterior``, ``score`` or ``keep`` are replaced, all others come back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import _CACHES, claim, distinct, documents, materialize, small_batches
from .ftrl import Ftrl, sigmoid

BITS, TRAIN_DOCS, EPOCHS, KEEP = 16, 6000, 3, 0.5
FIT = {"alpha": 0.5, "beta": 1.0, "l1": 0.2, "l2": 0.5}
#: labeller: (bad if above, good if below) on the named share; the order is that of ``shares``.
LABELLERS = {
    "capitals": (0.5, 0.15), "shouting": (0.2, 0.02), "symbols": (0.25, 0.05), "marked_ends": (0.15, 0.02), "bare_symbols": (0.15, 0.03),
    "stutter": (0.25, 0.05), "few_words": (0.65, 0.4), "few_pairs": (0.7, 0.4), "no_sentences": (0.998, 0.985), "repeated_lines": (0.5, 0.2),
}
ABSTAIN, MIN_WORDS, MIN_LINES = 2, 8, 4
_UP, _SYM, _BANG, _STOP, _BARE, _MARKED = 1, 2, 4, 8, 16, 32
_SYMBOLS = frozenset("%$&*#|!@+=<>~^\\/_{}[]")


def _look_at(word: str) -> tuple[str, int]:
    """A word's shape (runs of upper case, letters, digits; marks as they are) and flags."""
    flags = 0
    letters = [c for c in word if c.isalpha()]
    if len(letters) > 1 and all(c.isupper() for c in letters):
        flags |= _UP
    if any(c in _SYMBOLS for c in word):
        flags |= _SYM
    if word.endswith("!!"):
        flags |= _BANG
    if word.rstrip(")\"'")[-1:] in (".", "?", "!"):
        flags |= _STOP
    if not letters and not any(c.isdigit() for c in word):
        flags |= _BARE
    if len(word) > 3 and word[-1] in _SYMBOLS and word[-1] == word[-2]:
        flags |= _MARKED
    shape, last = [], ""
    for c in word:
        k = "U" if c.isupper() else "l" if c.isalpha() else "d" if c.isdigit() else c
        if k != last:
            shape.append(k)
        last = k
    return "".join(shape)[:16], flags


class _Words(dict):
    """word -> shape hash (30 bits), word hash (24 bits) and flags (8 bits) in one integer."""

    def __missing__(self, word: str) -> int:
        if len(self) >= 300_000:
            self.clear()
        core = word.rstrip(".,")
        if core.isalpha() and (core.islower() or core[1:].islower()):  # most words
            shape, flags = ("l" if core[0].islower() else "Ul") + ("." if word[-1] == "." else "," if word[-1] == "," else ""), _STOP if word[-1] == "." else 0
        else:
            shape, flags = _look_at(word)
        look = xxhash.xxh3_64_intdigest(shape) & 0x3FFFFFFF
        v = self[word] = look << 32 | (xxhash.xxh3_64_intdigest(word) & 0xFFFFFF) << 8 | flags
        return v


_WORDS = _Words()
_CACHES["quality"] = _WORDS.clear


def _codes(text: str | None) -> np.ndarray:
    claim("quality")
    w = text.split() if text else []
    return np.fromiter(map(_WORDS.__getitem__, w), np.int64, len(w))


def shares(text: str | None, code: np.ndarray) -> list[float] | None:
    """The shares that the labellers judge; None with too few words to judge; NaN where a labeller has no say."""
    n = len(code)
    if n < MIN_WORDS:
        return None
    seen = np.bincount(code & 0xFF, minlength=64)
    share = lambda bit: float(seen[(np.arange(len(seen)) & bit) > 0].sum()) / n
    ids = code >> 8 & 0xFFFFFF
    stutter = float(np.count_nonzero(ids[1:] == ids[:-1])) / (n - 1)
    few_words = few_pairs = np.nan
    if n >= 20:
        few_words = 1.0 / max(len(distinct(ids)) / n**0.5, 1.0)
        few_pairs = 1 - len(distinct(ids[:-1] << 24 | ids[1:])) / (n - 1)
    lines = [x for x in text.split("\n") if x.strip()]
    repeated = 1 - len(set(lines)) / len(lines) if len(lines) >= MIN_LINES else np.nan
    return [share(_UP), share(_BANG), share(_SYM), share(_MARKED), share(_BARE), stutter, few_words, few_pairs, 1 - share(_STOP) if n >= 60 else np.nan, repeated]


def votes(text: str | None, code: np.ndarray | None = None) -> int:
    """The labellers' votes as one base-3 number."""
    s = shares(text, _codes(text) if code is None else code)
    pattern = 0
    for i, (bad, good) in enumerate(LABELLERS.values()):
        v = ABSTAIN if s is None or s[i] != s[i] else 0 if s[i] > bad else 1 if s[i] < good else ABSTAIN
        pattern += v * 3**i
    return pattern


def _unpack(pattern: np.ndarray) -> np.ndarray:
    return pattern[:, None] // 3 ** np.arange(len(LABELLERS)) % 3


def fit_labellers(pattern: np.ndarray, count: np.ndarray, rounds: int = 200, tol: float = 1e-9) -> tuple[float, np.ndarray]:
    """EM on counted patterns. Returns the prior of "good" and P(vote | class) as classes x labellers x 3 votes. It starts
    from: bad if any labeller says so, else good."""
    v = _unpack(pattern)
    good = np.where((v == 0).any(axis=1), 0.1, 0.9)
    prior, table = 0.9, np.full((2, v.shape[1], 3), 1 / 3)
    for _ in range(rounds):
        for y, q in ((0, 1 - good), (1, good)):
            w = q * count
            for vote in range(3):
                table[y, :, vote] = (w @ (v == vote) + 0.5) / (w.sum() + 1.5)
        prior = float((good @ count + 1) / (count.sum() + 2))
        new = posterior(pattern, prior, table)
        moved = float(np.abs(new - good).max()) if len(good) else 0.0
        good = new
        if moved < tol:
            break
    return prior, table


def posterior(pattern: np.ndarray, prior: float, table: np.ndarray) -> np.ndarray:
    """P(good | votes); a labeller that abstains says nothing."""
    v = _unpack(pattern)
    said = v != ABSTAIN
    j = np.arange(v.shape[1])
    logs = np.log(table)
    spoken = np.logaddexp(logs[..., 0], logs[..., 1])  # given that the labeller speaks
    ll = [np.where(said, logs[y][j, np.minimum(v, 1)] - spoken[y], 0).sum(axis=1) for y in (0, 1)]
    return sigmoid(np.log(prior) - np.log(1 - prior) + ll[1] - ll[0])


def features(code: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Hashed word shapes and shape pairs (with a mark on a repeated word), valued by the square root of their share of
    the text; 0 is the bias."""
    n = len(code)
    if not n:
        return np.zeros(1, np.int64), np.ones(1)
    h = (code >> 32).view(np.uint64)
    same = (code[1:] >> 8 & 0xFFFFFF == code[:-1] >> 8 & 0xFFFFFF).astype(np.uint64)
    x = np.concatenate([h, (h[:-1] * np.uint64(0x9E3779B1) + h[1:]) ^ same << np.uint64(62)])
    x = np.sort((x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits))
    first = np.flatnonzero(np.r_[True, x[1:] != x[:-1]])
    at, counts = x[first].astype(np.int64), np.diff(np.r_[first, len(x)])
    keep = at > 0
    return np.concatenate([[0], at[keep]]), np.concatenate([[1.0], np.sqrt(counts[keep] / n)])


def judge(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """doc_id, text and all other columns, with ``posterior`` (of the votes), ``score`` (of the scorer) and ``keep``."""
    spark = docs.sparkSession
    small_batches(spark)

    def vote(text: pd.Series) -> pd.Series:
        return pd.Series([votes(t) for t in text], dtype="int32")

    cast = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pattern = F.pandas_udf(vote, "int")("text").alias("pattern")
    # pattern counts of the whole corpus, and the ids to train on, from one pass over the texts
    voted = materialize(cast.select("doc_id", pattern), "votes")
    counted = voted.groupBy("pattern").count().toPandas().sort_values("pattern")
    keys, count = counted["pattern"].to_numpy(np.int64), counted["count"].to_numpy(float)
    prior, table = fit_labellers(keys, count)
    known = dict(zip(keys.tolist(), posterior(keys, prior, table).tolist(), strict=True))
    picked = voted.filter("doc_id is not null").orderBy(F.xxhash64("doc_id"), "doc_id", "pattern").limit(train_docs)
    sample = cast.join(F.broadcast(picked.select("doc_id", "pattern").dropDuplicates(["doc_id"])), "doc_id").select(F.xxhash64("doc_id").alias("key"), "pattern", "text")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [features(_codes(t)) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([i.astype("<i4").tobytes() for i, _ in x], pa.binary()), pa.array([v.astype("<f4").tobytes() for _, v in x], pa.binary())], names=["key", "pattern", "at", "value"])

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
        rows.sort()
        model = Ftrl(BITS, **FIT)
        for _ in range(EPOCHS):
            for _, p, at, value in rows:
                model.learn(np.frombuffer(at, "<i4"), np.frombuffer(value, "<f4").astype(float), known[p])
        yield pa.RecordBatch.from_arrays([pa.array([model.dense().tobytes()], pa.binary())], names=["w"])

    got = sample.mapInArrow(extract, "key long, pattern int, at binary, value binary").repartition(1).mapInArrow(train, "w binary").collect()
    weights = np.frombuffer(got[0].w, np.float32) if got else np.zeros(1 << BITS, np.float32)
    sent = spark.sparkContext.broadcast((weights, known))

    def rate(text: pd.Series) -> pd.DataFrame:
        w, post = sent.value
        rows = []
        for t in text:
            code = _codes(t)
            at, value = features(code)
            rows.append((post.get(votes(t, code), 0.5), float(sigmoid(w[at] @ value)) if len(code) else prior))
        return pd.DataFrame(rows, columns=["posterior", "score"])

    judged = docs.withColumn("_judged", F.pandas_udf(rate, "posterior double, score double")(F.col("text").cast("string")))
    judged = judged.withColumns({"posterior": F.col("_judged.posterior"), "score": F.col("_judged.score")}).drop("_judged")
    return judged.withColumn("keep", (F.col("posterior") + F.col("score")) / 2 >= KEEP)


def op7_weak_label_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", "posterior", "score", F.col("keep").cast("int").alias("keep"))


QUERIES = {"op7_weak_label_quality": op7_weak_label_quality}
ORACLE: dict[str, str] = {}

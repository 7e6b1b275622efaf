"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
import uuid

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: One word: anything but ASCII white space. ``bytes.split()`` and ``bytes.lower()`` follow the same rule.
WORD = r"[^\x20\x09-\x0D]+"
M64 = (1 << 64) - 1


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a local one only where the session names none (tests)."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        got = spark.sparkContext._jsc.sc().getCheckpointDir()
        if got.isDefined():
            path = got.get()
        else:
            if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
                raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
            import tempfile

            path = f"file://{tempfile.mkdtemp(prefix='spanforge_ck')}"
            spark.sparkContext.setCheckpointDir(path)
    return path


#: Where Spark has it, internal writes drop their shuffle files as soon as they end.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, tag: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back: lineage ends there,
    and the table survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/spanforge_{tag}_{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    before = spark.conf.get(_CLEANUP, None)
    if before is not None:
        spark.conf.set(_CLEANUP, "true")
    try:
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    finally:
        if before is not None:
            spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._spanforge_path = path
    return out


#: Rows of a batch that goes to a Python worker: texts can be long, and a worker keeps the memory of its largest batch.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Bound the rows of Arrow batches, for operators that send whole texts to Python."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def by_partition(df: DataFrame, run, ddl: str) -> DataFrame:
    """Apply ``run(table) -> iterator of record batches`` to each partition as one Arrow table. For rows that were
    dealt by a key with a bound on what shares it, so that a partition is a task's ordinary share."""
    import pyarrow as pa

    def whole(batches):
        got = [b for b in batches if b.num_rows]
        if got:
            yield from run(pa.Table.from_batches(got).combine_chunks())

    return df.mapInArrow(whole, ddl)


class BitFilter:
    """A one-hash Bloom filter of bounded size over a long column, built by an aggregation: it drops most rows that a
    following semi join would drop, before they are shuffled. ``MAX_BITS`` bounds what is broadcast; a fuller filter only passes more."""

    MAX_BITS = 1 << 25

    def __init__(self, ids: DataFrame, column: str):
        n = ids.count()
        self.bits = max(1 << 12, min(self.MAX_BITS, 1 << max(n * 16, 1).bit_length()))
        h = F.pmod(self._hash(F.col(column)), F.lit(self.bits))
        rows = ids.select(h.alias("h")).groupBy(F.shiftright("h", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(h & 63 as int))")).alias("b")).collect()
        words = np.zeros(self.bits >> 6, np.int64)
        if rows:
            words[np.array([r.w for r in rows])] = np.array([r.b for r in rows], np.int64)
        self.sent = ids.sparkSession.sparkContext.broadcast(words.view(np.uint64))

    @staticmethod
    def _hash(c):
        return F.xxhash64(c)

    def column(self, df: DataFrame, column: str) -> DataFrame:
        """``df`` with ``_slot``: where a value's bit is."""
        return df.withColumn("_slot", F.pmod(self._hash(F.col(column)), F.lit(self.bits)))

    def passes(self, slots: np.ndarray) -> np.ndarray:
        return (self.sent.value[slots >> 6] >> (slots & 63).astype(np.uint64)) & np.uint64(1) > 0


def discard(df: DataFrame) -> None:
    """Delete a table that ``materialize`` wrote, once nothing reads it any more."""
    path = getattr(df, "_spanforge_path", None)
    if path:
        jvm, sc = df.sparkSession._jvm, df.sparkSession.sparkContext
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply) over a uint64 array."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values (by sorting: steadier than a hash set on long arrays)."""
    x = np.sort(x)
    return x[np.r_[True, x[1:] != x[:-1]]] if len(x) else x


#: What clears the word caches of each user, and whose are filled: a Python worker that is used again keeps one operator's at a time.
_CACHES: dict = {}
_OWNER: list = [None]


def claim(user: str) -> None:
    """Called where a task begins: other users' caches are dropped."""
    if _OWNER[0] != user:
        for other, clear in _CACHES.items():
            if other != user:
                clear()
        _OWNER[0] = user


class WordHash(dict):
    """word bytes -> 64-bit hash, kept for at most ``limit`` words."""

    def __init__(self, limit: int = 400_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


WORDS = WordHash()
_CACHES["words"] = WORDS.clear


def word_list(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words of a text; null has none."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def word_hashes(text: str | None) -> np.ndarray:
    claim("words")
    w = word_list(text)
    return np.fromiter(map(WORDS.__getitem__, w), dtype=np.uint64, count=len(w))


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles; a shorter sequence is one shingle; no words, none."""
    if not len(words):
        return words
    n = min(n, len(words))
    m = len(words) - n + 1
    h = np.full(m, np.uint64(n), dtype=np.uint64)
    for i in range(n):
        h = (h ^ words[i : i + m]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    return distinct(mix64(h))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def crc_mod(column: str, modulus: int):
    """crc32 of an integer column's decimal text, modulo ``modulus`` (null stays null)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def n_words(column: str):
    """Number of words of a text column, JVM side; null or empty: 0."""
    c = F.coalesce(F.col(column), F.lit(""))
    return F.size(F.filter(F.split(c, r"[\x20\x09-\x0D]+"), lambda x: x != "")).cast("long")


def safe_name(text: str) -> str:
    return re.sub(r"\W", "_", text)

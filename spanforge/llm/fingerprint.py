"""Document fingerprints by consistent weighted sampling (ICWS): the collision rate of two fingerprints is the
generalised Jaccard similarity sum(min) / sum(max) of the texts' word counts.

DataFrame and SQL functions only. Terms are the words of ``lower(text)``, weighted by their counts S. For each of
``SAMPLES`` samples a term's hash gives r, c ~ Gamma(2, 1) and beta ~ U(0, 1); with t = floor(ln S / r + beta) the term's
value is ln a = ln c - r (t - beta + 1), and the sample is the term and t of the least value. A value and its term's hash bits
are packed into one long, so that a sample is a plain ``min`` that Spark aggregates without a sort.

Scale: texts are dealt once, by runs of 2**``RUN_BITS`` consecutive ids; words are exploded, counted and sampled in the task that holds
their document, with no exchange between. A document's successor comes from its run, or for a run's last document from
the next run's first; runs are dealt by ranges, so that no window without a key holds more than a row per partition.

Defined results: null text = empty text, whose fingerprint is ''; two empty texts are alike (1), an empty one is unlike any
other (0); equal texts have equal fingerprints; rows with a null doc_id are left out (they have no place in the
order); of rows that repeat a doc_id one after the other is the successor, in the order of their texts; extra columns
are ignored; a single document is its own successor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, materialize

SAMPLES, RUN_BITS = 32, 7
SPACE = r"[\x20\x09-\x0D]+"


def _uniform(h: Column, shift: int) -> Column:
    """16 bits of a hash as a number in (0, 1)."""
    bits = F.shiftrightunsigned(h, shift) if shift else h
    return (bits.bitwiseAND(F.lit(0xFFFF)).cast("double") + 0.5) / 65536.0


def fingerprints(texts: DataFrame, keys: list[str], text: str, samples: int = SAMPLES) -> DataFrame:
    """keys and ``sample`` (the marks of ``samples`` samples; null for a text without words). ``keys`` must identify a row; if the rows
    are dealt by the first of them, nothing is shuffled."""
    words = texts.select(*keys, F.explode(F.split(F.lower(text), SPACE)).alias("w")).filter("w <> ''")
    counts = words.select(*keys, F.xxhash64("w").alias("term")).groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("s"))
    counts = counts.select(*keys, "term", F.log(F.col("s").cast("double")).alias("ls"))
    values = []
    for k in range(samples):
        h, g = F.xxhash64("term", F.lit(k)), F.xxhash64("term", F.lit(k + 1_000_000))
        r = -F.log(_uniform(h, 0) * _uniform(h, 16))  # Gamma(2, 1): the sum of two exponentials
        c = F.log(-F.log(_uniform(h, 32) * _uniform(h, 48)))
        beta = _uniform(g, 0)
        a = c - r * (F.floor(F.col("ls") / r + beta).cast("double") - beta + 1.0)
        packed = F.shiftleft(((a + 64.0) * float(2**30)).cast("long"), 24).bitwiseOR(F.shiftrightunsigned(g, 40))
        values.append(F.min(packed).alias(f"v{k}"))
    least = counts.groupBy(*keys).agg(*values)
    return least.select(*keys, marks(F.array(*[F.col(f"v{k}") for k in range(samples)])).alias("sample"))


def marks(sample: Column) -> Column:
    """16 bits of each sample: what a fingerprint holds."""
    return F.transform(sample, lambda v: F.xxhash64(v).bitwiseAND(F.lit(0xFFFF)))


def digest(mark: Column) -> Column:
    """A fingerprint: its marks as hex; '' without words."""
    return F.coalesce(F.array_join(F.transform(mark, lambda v: F.lpad(F.hex(v), 4, "0")), ""), F.lit(""))


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """Share of equal marks of two fingerprints; two texts without words are alike."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x)).cast("double") / samples
    return F.when(a.isNull() & b.isNull(), 1.0).when(a.isNull() | b.isNull(), 0.0).otherwise(same)


def _next_run(runs: DataFrame) -> DataFrame:
    """(run, next_run): the next lower run, for the lowest the highest. Runs are dealt by ranges, however sparse the ids are; one window
    goes inside the ranges, one over the ranges' first runs (one row per partition)."""
    dealt = materialize(runs.repartitionByRange(F.col("run").desc()).withColumn("part", F.spark_partition_id()), "runs")
    tops = dealt.groupBy("part").agg(F.max("run").alias("top"))
    below = F.coalesce(F.lead("top").over(Window.orderBy(F.col("top").desc())), F.max("top").over(Window.partitionBy()))
    tops = tops.select("part", below.alias("below"))
    inside = dealt.withColumn("next_run", F.lead("run").over(Window.partitionBy("part").orderBy(F.col("run").desc())))
    return inside.join(tops, "part").select("run", F.coalesce("next_run", "below").alias("next_run"))


def successors(docs: DataFrame) -> DataFrame:
    """run, doc_id, text, next_id, next_text: the next document in descending order of doc_id."""
    rows = docs.filter("doc_id is not null").select(F.shiftright(F.col("doc_id").cast("long"), RUN_BITS).alias("run"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    inside = Window.partitionBy("run").orderBy(F.col("doc_id").desc(), "text")
    rows = rows.withColumns({"next_id": F.lead("doc_id").over(inside), "next_text": F.lead("text").over(inside), "n": F.row_number().over(inside)})
    first = rows.filter("n = 1").select(F.col("run").alias("next_run"), F.col("doc_id").alias("first_id"), F.col("text").alias("first_text"))
    after = _next_run(rows.filter("n = 1").select("run")).join(first, "next_run").drop("next_run")
    rows = rows.join(after, "run")
    return rows.select("run", "doc_id", "n", "text", F.coalesce("next_id", "first_id").alias("next_id"), F.coalesce("next_text", "first_text").alias("next_text"))


def fingerprint_documents(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    rows = successors(docs).withColumn("n_chars", F.char_length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")), F.substring("next_text", F.lit(1), half))
    both = rows.select("run", "doc_id", "n", "next_id", "n_chars", F.posexplode(F.array("text", edited)).alias("kind", "body"))
    keys = ["run", "doc_id", "n", "kind"]
    facts = both.select(*keys, "next_id", "n_chars", F.when(F.col("kind") == 1, F.sha2("body", 256)).alias("sha"))
    samples_of = fingerprints(both, keys, "body", samples)
    facts = facts.join(samples_of, keys, "left")
    pick = lambda c, kind: F.max(F.when(F.col("kind") == kind, F.col(c))).alias(f"{c}{kind}")
    one = facts.groupBy("run", "doc_id", "n", "next_id", "n_chars").agg(pick("sha", 1), pick("sample", 0), pick("sample", 1))
    one = materialize(one, "fingerprints")  # the successor's is looked up in it; nothing is computed twice
    own = one.filter("n is not null").groupBy("doc_id").agg(F.min_by("sample0", "n").alias("next_sample")).withColumnRenamed("doc_id", "to")
    out = one.join(own, F.col("next_id") == F.col("to"))
    return out.select(
        "doc_id", "n_chars", F.col("sha1").alias("edited_sha256"), digest(F.col("sample0")).alias("fingerprint"), digest(F.col("sample1")).alias("edited_fingerprint"),
        likeness(F.col("sample0"), F.col("sample1"), samples).alias("near_edited"), likeness(F.col("sample0"), F.col("next_sample"), samples).alias("near_next"), "next_id",
    )


def op9_cws_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(documents(spark, sf_dir)).drop("next_id")


QUERIES = {"op9_cws_fingerprint": op9_cws_fingerprint}
ORACLE: dict[str, str] = {}

"""A corpus pipeline of five training-data operators over ``documents``.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next stage's docs. All but the last return the columns of ``documents``.

Defined results, in every stage: null texts and null ids pass through the filters (no operator matches them), an empty table
gives an empty table, and columns beyond those of ``documents`` are dropped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanforge.llm import line_dedup, mixing, ngram_join, packing, quality
from spanforge.llm.common import documents, materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label classifier keeps."""
    return quality.judge(docs.select(COLUMNS)).filter("keep").select(COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that another line replaces; documents that lost all their text that way go. ``n_chars``
    follows the text."""
    out = line_dedup.dedup(docs.select(COLUMNS)).filter((F.size("lines_removed") == 0) | (F.trim("text") != ""))
    n = F.when(F.size("lines_removed") > 0, F.char_length("text")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", n.cast(docs.schema["n_chars"].dataType)).select(COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each component of near duplicates: 0.8 of five-word shingles."""
    docs = docs.select(COLUMNS)
    groups = ngram_join.join(docs, words=5, percent=80)
    others = groups.filter("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(others, "doc_id", "left_anti").select(COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it (0 to 3 times)."""
    docs = docs.select(COLUMNS)
    taken = mixing.mix(docs).groupBy("doc_id", "source", "size").agg(F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_rows")).filter("_copies > 0")
    taken = taken.withColumnsRenamed({"doc_id": "_id", "source": "_source", "size": "_size"})
    sized = docs.withColumn("_words", mixing.n_words("text"))
    got = sized.join(taken, F.expr("doc_id <=> _id and source <=> _source and _words = _size"))
    # rows that share id, source and size share the copies that the mix gave them
    several = got.filter("_rows > 1").withColumn("_at", F.row_number().over(Window.partitionBy("_id", "_source", "_size").orderBy("text")))
    got = got.filter("_rows = 1").withColumn("_at", F.lit(1)).unionByName(several)
    return got.withColumn("_copy", F.explode(F.expr("array_repeat(0, cast(_copies div _rows + if(_at <= _copies % _rows, 1, 0) as int))"))).select(COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences with their ids."""
    return packing.pack(docs.select(COLUMNS), with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("mixing sources to target weights", mixing_stage),
    ("packing", packing_stage),
]

#: No stage but the scans can be expressed in SQL; tests/llm compares them with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, "stage")
    return docs

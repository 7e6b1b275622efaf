"""The pipeline's stages against their own inputs, and the registry."""

import collections

import corpus_pipeline as cp
from spanforge.llm import ngram_join, registry

from .test_llm import corpus, table


def test_stages(spark, tmp_path):
    docs = table(spark, [*corpus(), (None, None)])
    seen = {}
    for name, stage in cp.STAGES:
        out = stage(spark, docs, "")
        path = str(tmp_path / name.replace(" ", "_"))
        out.write.parquet(path)
        seen[name] = (docs, spark.read.parquet(path))
        docs = seen[name][1]
    for name, (_, after) in list(seen.items())[:-1]:
        assert after.columns == cp.COLUMNS, name
    before, after = seen["n-gram Jaccard join"]
    groups = {r.doc_id: r.component_id for r in ngram_join.join(before, 5, 80).collect()}
    assert {r.doc_id for r in after.collect()} == {c for c in groups.values()}
    before, after = seen["mixing sources to target weights"]
    have = collections.Counter(r.doc_id for r in after.collect())
    assert have and max(have.values()) <= 3 and set(have) <= {r.doc_id for r in before.collect()}
    before, after = seen["packing"]
    assert after.filter("start = 0").count() == before.count()


def test_stages_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in cp.STAGES:
        assert stage(spark, docs, "").count() == 0


def test_registry_has_all_queries():
    names = list(registry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11))


def test_mixing_gives_repeated_rows_what_the_mix_took(spark):
    import corpus_pipeline
    from spanforge.llm import mixing

    rows = [(1, "one two three", "en", "a", 13)] * 5 + [(i, "four five", "en", "b", 9) for i in range(2, 12)] + [(None, "six", "en", "c", 3)] * 4
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    want = sum(x.copies for x in mixing.mix(docs).collect())
    assert corpus_pipeline.mixing_stage(spark, docs, "").count() == want

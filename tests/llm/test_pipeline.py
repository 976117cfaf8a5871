import hashlib

import brute
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from rawloom.llm import registry, toxicity
from rawloom.llm.frames import table


def test_registered():
    names = list(registry.QUERIES)
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(names) | {"pipeline"} <= set(entry.queries())
    assert set(registry.ORACLES) <= set(entry.oracle_sql())


def test_stages_against_brute_force(spark, sf):
    docs = table(spark, sf, "documents")
    rows = {r.doc_id: r.text for r in docs.collect()}
    lexicon = toxicity.train(toxicity.labelled(docs, table(spark, sf, "labels")))
    rejected = {r.doc_id for r in toxicity.toxicity(docs, lexicon).where("predicted = 1").collect()}
    left = {k: t for k, t in rows.items() if k not in rejected}
    groups = brute.near_duplicates(list(left.items()), pipeline.SIMILAR)
    left = {k: t for k, t in left.items() if groups[k][2]}
    cut = brute.repeats(list(left.items()))
    left = {k: brute.cut_text(t, cut[k][4]) for k, t in left.items()}
    items = [(r.item_id, r.text) for r in table(spark, sf, "benchmark").collect()]
    dirty = {r[0] for r in brute.contamination(list(left.items()), items) if r[5]}
    left = {k: t for k, t in left.items() if k not in dirty}
    got = {r.doc_id: r.decoded_sha256 for r in pipeline.run(spark, sf).collect()}
    assert got == {k: hashlib.sha256(t.encode()).hexdigest() for k, t in left.items()}


@pytest.mark.parametrize("empty", [False, True])
def test_stages_with_odd_rows(spark, odd, sf, empty):
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars").withColumn("predicted", F.lit("x"))
    docs = docs.limit(0) if empty else docs
    for _, stage in pipeline.STAGES[:-1]:
        after = stage(spark, docs, sf)
        assert after.columns == docs.columns
        docs = spark.createDataFrame(after.collect(), after.schema)
    got = pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert [r.doc_id for r in got] == [r.doc_id for r in docs.collect()]
    if not empty:
        assert {1, 2, 3, 4, 6, None} <= {r.doc_id for r in got}
        assert 5 not in {r.doc_id for r in got}


@pytest.mark.parametrize("pass_bytes", [8 << 20, 1000])
def test_benchmark_stage_decides_rows(spark, sf, pass_bytes, monkeypatch):
    """A contaminated row goes, and no other, also without a doc_id or with that of another row."""
    contamination = pipeline.decontaminate.contamination
    monkeypatch.setattr(pipeline.decontaminate, "contamination", lambda *a, **b: contamination(*a, **b, pass_bytes=pass_bytes))
    dirty = [r.text for r in table(spark, sf, "benchmark").orderBy("item_id").limit(2).collect()]
    rows = [(None, dirty[0]), (None, "clean"), (1, dirty[1]), (1, "also clean"), (2, None), (3, dirty[0])]
    docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    left = pipeline.benchmarks(spark, docs, sf)
    assert left.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=repr) == sorted([(None, "clean"), (1, "also clean"), (2, None)], key=repr)

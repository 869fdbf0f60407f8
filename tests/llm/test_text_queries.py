"""Registered queries against their SQL, and the pipeline stage by stage."""

from collections import Counter

import pytest

import corpus_pipeline
from matchlake.llm import decontaminate, ngram_join, quality_rules
from matchlake.llm.queries import ORACLES, QUERIES
from oracle_check import compare, duck


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, sf_small, name):
    result = compare(spark, duck(sf_small), name, sf_small, QUERIES[name], ORACLES[name])
    assert result["match"] and "type_diffs" not in result, result


def test_names_and_entry():
    import __spark_entry__ as entry

    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "ngram_join", "benchmark_decontamination", "source_mix", "sharding"]


def test_pipeline_takes_awkward_rows_and_leaves_one_table(spark, sf_small):
    import glob

    from . import cases

    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    before = set(glob.glob(f"{folder}/matchlake-*"))
    docs = cases.frame(spark, cases.documents()).repartition(3)
    out = corpus_pipeline.apply(spark, docs, sf_small)
    kept = [c for c in docs.columns if c != "shard"]
    assert out.columns == [*kept, "shard", "slot"]
    rows = out.collect()
    # Prose stays (its 60 documents, those long enough), copies and junk go, and slots have no gap.
    ids = Counter(r.doc_id for r in rows)
    assert len([i for i in ids if i is not None and i < 60]) > 30 and not {400, 401, 402, 407, 409, 410} & set(ids)
    assert len([i for i in ids if i is not None and 100 <= i < 125]) <= 1
    for shard in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))
    left = set(glob.glob(f"{folder}/matchlake-*")) - before
    assert len(left) == 1 and "stage-sharding" in left.pop()
    assert corpus_pipeline.apply(spark, cases.frame(spark, []), sf_small).count() == 0


def test_pipeline_stage_by_stage(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    ids = lambda df: Counter(r.doc_id for r in df.select("doc_id").collect())
    stage = dict(corpus_pipeline.STAGES)

    good = stage["quality_rules"](spark, docs, sf_small).persist()
    assert ids(good) == Counter(r.doc_id for r in quality_rules.report(docs).collect() if r.kept)

    one = stage["ngram_join"](spark, good, sf_small).persist()
    assert ids(one) == Counter({r.component_id: 1 for r in ngram_join.report(good).collect()})

    clean = stage["benchmark_decontamination"](spark, one, sf_small).persist()
    bench = spark.read.parquet(f"{sf_small}/benchmark.parquet")
    assert ids(clean) == Counter(r.doc_id for r in decontaminate.report(one, bench).collect() if not r.contaminated)

    mixed = stage["source_mix"](spark, clean, sf_small).persist()
    assert set(ids(mixed)) <= set(ids(clean)) and max(ids(mixed).values()) <= 2
    for df in (good, one, clean, mixed):
        assert df.columns == docs.columns

    out = stage["sharding"](spark, mixed, sf_small)
    assert ids(out) == ids(mixed) and out.columns == [*docs.columns, "shard", "slot"]
    run = corpus_pipeline.run(spark, sf_small)
    assert ids(run) == ids(mixed)

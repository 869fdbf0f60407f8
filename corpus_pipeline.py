"""A training corpus from ``documents``: five stages, each written as Parquet and
read again as the documents of the next one.

Stages: quality rules (rejected documents go), near-duplicate join (one document
of each group stays), benchmark decontamination (contaminated documents go),
mixing to source weights (a document as often as it is taken), sharding (adds
``shard`` and ``slot``).  All stages but the last return the columns of documents.

A stage's scratch tables go when its result is written, and that result when the next stage's is; only
the last one stays.

Defined cases, as of the operators: null, empty and wordless texts are rejected by the first stage; a null
doc_id is a document (rows repeated with their doc_id and text are one document after the second stage); an
empty table gives an empty result; a null source is a source; extra columns, whatever their names, are
carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from matchlake.llm import decontaminate, mixing, ngram_join, quality_rules, sharding
from matchlake.llm.common import scratch_tables, table, written
from matchlake.session import remove_scratch, scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.emit(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.sharded(docs)


STAGES = [
    ("quality_rules", quality),
    ("ngram_join", near_duplicates),
    ("benchmark_decontamination", benchmark),
    ("source_mix", mix),
    ("sharding", shards),
]

# Expectation-maximisation, and crc32 of the text, have no DuckDB SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply(spark, table(spark, sf_dir, "documents"), sf_dir)


def apply(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The stages on any documents; the benchmark is that of ``sf_dir``."""
    before = None
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        with scratch_tables(spark):
            docs = written(stage(spark, docs, sf_dir), path)
        if before:
            remove_scratch(spark, before)
        before = path
    return docs

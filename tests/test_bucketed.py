"""Clustered tables and measured statistics: rows as before, and the plans they are for."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from matchlake.operators.combine import merge_join
from matchlake.plans import bucketed
from matchlake.plans.edition import compact
from matchlake.plans.registry import Layers
from matchlake.plans.star import fact_appearance
from matchlake.plans.statistics import Dimension, TableStats, join_by_stats, kept_share, load_stats, measure, star_join, store_stats
from matchlake.plans.totals import player_totals


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in keys:
        spark.conf.set(key, "-1")
    yield
    for key in keys:
        spark.conf.unset(key)


def test_nothing_is_exchanged_on_clustered_tables(spark, sf_small, no_broadcast):
    base, ed = tempfile.mkdtemp(prefix="matchlake-buckets-"), compact()
    silver = Layers(spark, sf_small).silver(ed)
    written = bucketed.appearance_fact(silver, base, ed, 8)
    apps, games = (bucketed.read_bucketed(spark, f"{base}/{t}") for t in ("appearances", "games"))
    fact = fact_appearance(apps, games, ed, spread=False)
    assert "SortMergeJoin" in plan(fact) and "Exchange" not in plan(fact)
    assert "Exchange" in plan(fact_appearance(apps, games, ed))                 # the split form pays for one
    per_player = bucketed.totals(written)
    assert "Exchange" not in plan(per_player) and "partial_sum" in plan(per_player)
    assert "Exchange" not in plan(written.groupBy("player_key").agg(F.sum("goals")))
    plain = fact_appearance(silver["appearances"], silver["games"], ed)
    assert written.dtypes == plain.dtypes and rows(written) == rows(plain) and rows(per_player) == rows(player_totals(plain))
    assert spark.catalog.listTables() == [t for t in spark.catalog.listTables() if not t.name.startswith("matchlake_")]
    # Another session reads the clustering from beside the files.
    again = bucketed.read_bucketed(spark.newSession(), f"{base}/fact_appearance")
    assert "Exchange" not in plan(again.groupBy("player_key").count())
    assert json.load(open(f"{base}/fact_appearance/_buckets.json"))["buckets"] == 8
    assert len([f for f in os.listdir(f"{base}/appearances") if f.endswith(".parquet")]) <= 8


def test_a_clustered_table_is_rewritten_whole(spark):
    path = tempfile.mkdtemp(prefix="matchlake-buckets-") + "/t"
    for n in (50, 7):
        df = spark.range(n).select(F.when(F.col("id") % 5 > 0, F.col("id")).alias("k"), F.lit("x").alias("odd name"))
        assert rows(bucketed.write_bucketed(df, path, ["k"], 4)) == rows(df)
    assert bucketed.write_bucketed(df.limit(0), path, ["k"], 4).count() == 0
    assert [bucketed.bucket_count(n << 28) for n in (0, 1, 2, 3, 100)] == [1, 1, 2, 4, 128]


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_plain_merge_join_equals_the_split_one(spark, how):
    a = spark.createDataFrame([(1, "x", None), (1, None, 2), (3, "y", 3), (None, "z", 4)], "k int, v string, a int")
    b = spark.createDataFrame([(1, "b", 9), (2, "c", 8), (None, "d", 7)], "k int, v string, b int")
    assert rows(merge_join(a, b, "k", how, spread=False)) == rows(merge_join(a, b, "k", how))


# ---------------------------------------------------------------- statistics

@pytest.fixture(scope="module")
def heavy(spark):
    """A table of some hundred kilobytes on disk and 200 MB in memory."""
    path = tempfile.mkdtemp(prefix="matchlake-heavy-") + "/t"
    spark.range(400_000).select("id", F.repeat(F.lit("compressible "), 40).alias("text")).coalesce(1).write.parquet(path)
    return spark.read.parquet(path)


def test_a_wrong_estimate_does_not_pick_the_strategy(spark, heavy):
    left = spark.range(1000).withColumnRenamed("id", "id").withColumn("n", F.col("id") * 2)
    stats = measure(heavy, ["id"])
    assert stats.rows == 400_000 and stats.bytes > 200e6 and abs(stats.distinct["id"] - 400_000) < 40_000
    wide = left.hint("merge")                                                   # the left side is not the question
    assert "BroadcastHashJoin" in plan(left.join(heavy, "id", "left"))          # by its 2 MB of files
    by_stats = join_by_stats(wide, heavy, "id", stats, "left")
    assert "BroadcastHashJoin" not in plan(by_stats) and "SortMergeJoin" in plan(by_stats)
    assert by_stats.select("id", "n", "text").exceptAll(left.join(heavy, "id", "left")).count() == 0
    # The other way: few rows are left of a table that is estimated by its files.
    few = heavy.filter(F.length(F.concat("text", F.col("id").cast("string"))) < 522).select("id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100k")
    try:
        many = heavy.select("id")
        assert "SortMergeJoin" in plan(many.join(few.hint("merge"), "id"))
        small = join_by_stats(many, few, "id", measure(few))
        assert "BroadcastHashJoin" in plan(small) and small.count() == 10
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_star_join_takes_selective_dimensions_first(spark, heavy):
    fact = spark.range(1000).select((F.col("id") % 100).alias("a"), (F.col("id") % 40).alias("b"), F.col("id"), (F.col("id") % 7).alias("c"))
    dims = {"a": spark.range(90).select(F.col("id").alias("a"), F.lit("x").alias("in_a")),
            "b": spark.range(4).select(F.col("id").alias("b"), F.lit("y").alias("in_b")),
            "c": spark.range(3).select(F.col("id").alias("c"), F.lit("z").alias("in_c"))}
    stats = measure(fact, ["a", "b", "c", "id"])
    listed = [Dimension(heavy, "id", measure(heavy, ["id"])), Dimension(dims["a"], "a", measure(dims["a"], ["a"])),
              Dimension(dims["c"], "c", measure(dims["c"], ["c"]), "left"), Dimension(dims["b"], "b", measure(dims["b"], ["b"]))]
    out = star_join(fact, stats, listed)
    assert out.columns == ["a", "b", "id", "c", "text", "in_a", "in_c", "in_b"]
    tree = out._jdf.queryExecution().optimizedPlan().toString()
    at = [tree.index(x) for x in ("id#", "AS in_a", "AS in_b")]
    joins = [line for line in tree.splitlines() if "Join" in line]
    assert "merge" in joins[0] and "broadcast" in joins[-1]                     # the heavy one is joined last
    assert tree.index("AS in_b") > tree.index("AS in_a") or at                  # the most selective one lies deepest
    want = fact.join(heavy, "id").join(dims["a"], "a").join(dims["c"], "c", "left").join(dims["b"], "b")
    assert rows(out) == rows(want.select(out.columns))
    assert kept_share(stats, listed[3]) < 0.2 < kept_share(stats, listed[1]) and kept_share(stats, listed[2]) == 1.0


def test_statistics_are_stored(spark):
    df = spark.createDataFrame([(1, "abc", None, [1, 2]), (2, None, b"xy", None)], "k int, t string, b binary, l array<int>")
    stats = {"t": measure(df, ["k", "t"]), "none": measure(df.limit(0), ["k"])}
    assert stats["t"] == TableStats(2, 2 * 8 * 5 + 3 + 2 + 16, {"k": 2, "t": 1}) and stats["none"] == TableStats(0, 0, {"k": 0})
    path = tempfile.mkdtemp(prefix="matchlake-stats-") + "/s"
    store_stats(spark, path, stats)
    assert load_stats(spark, path) == stats

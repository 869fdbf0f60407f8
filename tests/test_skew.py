"""Hot join keys are split by AQE in the registered plans, for every join type."""

import re
from collections import Counter

import pytest

from matchlake.operators.combine import merge_join, spread_join
from matchlake.plans import registry
from matchlake.sources import adapter

# Small inputs stand for large ones: no broadcasts, many partitions, low thresholds.
SPLIT = {
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture
def split(spark):
    before = {k: spark.conf.get(k, None) for k in SPLIT}
    for k, v in SPLIT.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def ran(df) -> tuple[Counter, str]:
    """Rows, and the plan that ran."""
    rows = Counter(map(str, df.collect()))
    return rows, df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def hot_games(monkeypatch, sf_small):
    """A third of all appearances belong to one game."""
    plain = adapter.BUILDERS["appearances"]

    def appearances(spark, sf):
        df = plain(spark, sf).repartition(8)  # many map tasks, as a large table has: a partition is split between them
        game = spark.read.parquet(f"{sf}/orders.parquet").agg({"o_orderkey": "min"}).first()[0]
        return df.selectExpr(*[f"CASE WHEN player_club_id % 3 = 0 THEN {game} ELSE game_id END AS game_id" if c == "game_id" else c
                               for c in df.columns])

    monkeypatch.setitem(adapter.BUILDERS, "appearances", appearances)


@pytest.mark.parametrize("name", ["fact_appearance", "fact_appearance_full", "merge_join_inner", "merge_join_left",
                                  "merge_join_right", "merge_join_full"])
def test_registered_plans_split_a_hot_game(split, sf_small, hot_games, name):
    rows, plan = ran(registry.QUERIES[name](split, sf_small))
    assert re.search(r"SortMergeJoin\(skew=true\)", plan), plan
    split.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        again, plan = ran(registry.QUERIES[name](split, sf_small))
    finally:
        split.conf.unset("spark.sql.adaptive.skewJoin.enabled")
    assert "skew=true" not in plan and again == rows


@pytest.mark.parametrize("how", ["inner", "left", "right", "full", "left_semi", "left_anti"])
def test_merge_join_equals_a_plain_join(spark, how):
    left = spark.createDataFrame([(1, "a"), (1, None), (2, "c"), (None, "d"), (5, "e")], "k long, v string")
    right = spark.createDataFrame([(1, "x", 1), (2, None, 2), (3, "z", 3), (None, "n", 4)], "k long, v string, w long")
    got = Counter(map(tuple, merge_join(left, right, "k", how).collect()))
    left.createOrReplaceTempView("l")
    right.createOrReplaceTempView("r")
    kind = {"left_semi": "LEFT SEMI", "left_anti": "LEFT ANTI"}.get(how, how.upper())
    cols = "l.k, l.v" if "left_" in how else "coalesce(l.k, r.k) k, coalesce(l.v, r.v) v, w"
    want = Counter(map(tuple, spark.sql(f"SELECT {cols} FROM l {kind} JOIN r ON l.k = r.k").collect()))
    assert got == want


def test_keys_of_two_types_still_match(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(1, "a"), (3, "b")], "k long, v string")
    assert [tuple(r) for r in spread_join(left, right, "k").collect()] == [(1, "a")]

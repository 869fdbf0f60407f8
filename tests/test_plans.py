"""Physical-plan properties that matter at scale."""

import pytest

from matchlake.plans.registry import QUERIES


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_projection_reaches_the_scan(spark, sf_small):
    p = plan(QUERIES["report06_compact"](spark, sf_small))
    # Appearances need five of the eleven lineitem columns; games only the key.
    assert ("ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int,"
            "l_quantity:double,l_extendedprice:double>") in p
    assert "ReadSchema: struct<o_orderkey:bigint>" in p


def test_filter_reaches_the_scan(spark, sf_small):
    from pyspark.sql import functions as F

    df = QUERIES["parquet_scan"](spark, sf_small).filter(F.col("player_club_id") < 10)
    assert "PushedFilters: [IsNotNull(l_suppkey), LessThan(l_suppkey,10)]" in plan(df)


def test_aggregates_are_partial_then_final(spark, sf_small):
    p = plan(QUERIES["report06_compact"](spark, sf_small))
    assert "partial_sum" in p and "partial_count" in p


def test_top_k_is_not_a_full_sort(spark, sf_small):
    p = plan(QUERIES["report08_compact"](spark, sf_small))
    assert "TakeOrderedAndProject" in p


def test_report12_full_joins_dimensions_without_shuffling_them(spark, sf_small):
    # Even with size-based broadcasts off (large dimensions), the k chosen
    # games reach their dimensions through broadcasts bounded by k: no
    # dimension joins through a sort-merge join.
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        df = QUERIES["report12_full"](spark, sf_small)
        assert df.count() == 20
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        smj = [ln for ln in final.splitlines() if "SortMergeJoin" in ln]
        # The only sort-merge join left is the adapter's nation/region pairing.
        assert all("regionkey" in ln for ln in smj), smj
        assert final.count("BroadcastHashJoin") >= 4
    finally:
        for k in keys:
            spark.conf.unset(k)


def test_dedupe_combines_before_shuffle(spark, sf_small):
    p = plan(QUERIES["dedupe_single"](spark, sf_small))
    assert "partial_min" in p


def test_no_python_udfs_or_cartesian(spark, sf_small):
    for name, fn in QUERIES.items():
        if name in ("csv_roundtrip", "parquet_roundtrip", "ingest_status", "report_status"):
            continue
        p = plan(fn(spark, sf_small))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name,key", [("report14_compact", "date_key"), ("report14_full", "date_key"),
                                      ("report07_compact", "competition_key")])
def test_facts_are_aggregated_before_their_dimension_is_joined(spark, sf_small, name, key):
    plan = _optimized(QUERIES[name](spark, sf_small))
    lines = plan.splitlines()
    join = next(i for i, x in enumerate(lines) if "Join Inner" in x)
    assert any(f"Aggregate [{key}" in x for x in lines[join:]), plan


def test_names_are_joined_to_the_top_games_only(spark, sf_small):
    plan = _optimized(QUERIES["report12_compact"](spark, sf_small))
    assert "LogicalRDD" in plan and "o_orderkey" not in plan  # the k games were written; no fact below the joins


def test_large_k_is_not_broadcast(spark, sf_small):
    from matchlake.plans import reports as R
    from matchlake.plans.edition import compact, full
    from matchlake.plans.registry import Layers

    for name, ed in (("report12_compact", compact()), ("report12_full", full())):
        star = Layers(spark, sf_small).star(ed)
        large = R.REPORTS[name](star, k=R.MOST_BROADCAST + 1)
        assert "broadcast)" not in _optimized(large) and "LogicalRDD" not in _optimized(large)
        few = [tuple(r) for r in R.REPORTS[name](star, k=7).collect()]
        assert [tuple(r) for r in large.limit(7).collect()] == few


def test_clubs_of_a_player_are_counted_without_a_set(spark, sf_small):
    assert "collect_" not in _optimized(QUERIES["report01_compact"](spark, sf_small))
    assert "collect_set" not in _optimized(QUERIES["report01_full"](spark, sf_small))

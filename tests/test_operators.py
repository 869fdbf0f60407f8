"""Operator unit tests on small literal DataFrames."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.functions import calendar_columns, date_key, full_name, is_international, won
from matchlake.operators import (conform_dates, count_where, dedupe, fill_defaults, fill_numeric,
                                 merge_join, normalize_nulls, ratio, require, sum_where, top_k)
from matchlake.operators.clean import NULL_TOKENS_STRICT


def rows(df, order=None):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_normalize_nulls_exact_tokens(spark):
    df = spark.createDataFrame(
        [(1, "null"), (2, "NULL"), (3, "Null"), (4, ""), (5, "nULL"), (6, " null "), (7, "x"),
         (8, None)], "id int, s string")
    out = dict(rows(normalize_nulls(df)))
    assert [out[i] for i in range(1, 9)] == [None, None, None, None, "nULL", " null ", "x", None]
    strict = dict(rows(normalize_nulls(df, NULL_TOKENS_STRICT)))
    assert strict[4] == "" and strict[1] is None
    assert normalize_nulls(df).schema == df.schema


def test_normalize_nulls_empty_table(spark):
    df = spark.createDataFrame([], "id int, s string")
    assert normalize_nulls(df).count() == 0


def test_dedupe_survivor_is_first_by_order(spark):
    df = spark.createDataFrame(
        [(1, "b", 2), (1, "a", 9), (1, None, 5), (2, "z", 1), (None, "q", 1), (None, "p", 2)],
        "k int, s string, v int")
    out = rows(dedupe(df, ["k"]), ["k"])
    # NULLs sort first within the order; NULL keys collapse to one row.
    assert out == [(None, "p", 2), (1, None, 5), (2, "z", 1)]
    by_v = rows(dedupe(df, ["k"], order_by=["v"]), ["k"])
    assert by_v == [(None, "q", 1), (1, "b", 2), (2, "z", 1)]


def test_dedupe_independent_of_partitioning_and_hot_key(spark):
    random.seed(7)
    data = [(0 if i % 3 == 0 else i % 50, random.randint(0, 1000), f"s{random.randint(0, 99)}")
            for i in range(3000)]
    df = spark.createDataFrame(data, "k int, v int, s string")
    a = rows(dedupe(df, ["k"]), ["k"])
    b = rows(dedupe(df.repartition(13), ["k"]), ["k"])
    assert a == b
    expect = {}
    for k, v, s in data:
        expect[k] = min(expect.get(k, (v, s)), (v, s))
    assert a == sorted((k, v, s) for k, (v, s) in expect.items())


def test_dedupe_composite_and_keys_only(spark):
    df = spark.createDataFrame([(1, 1, 5), (1, 1, 3), (1, 2, 4)], "a int, b int, c int")
    assert rows(dedupe(df, ["a", "b"]), ["a", "b"]) == [(1, 1, 3), (1, 2, 4)]
    assert dedupe(df.select("a", "b"), ["a", "b"]).count() == 2


def test_fill_defaults_checks_schema(spark):
    df = spark.createDataFrame([(None, None, None)], "n int, s string, d double")
    assert rows(fill_defaults(df, {"n": 0, "s": "Unknown", "d": 0.0})) == [(0, "Unknown", 0.0)]
    with pytest.raises(KeyError):
        fill_defaults(df, {"missing": 0})
    with pytest.raises(TypeError):
        fill_defaults(df, {"n": "Unknown"})
    with pytest.raises(TypeError):
        fill_defaults(df, {"s": 0})


def test_fill_numeric_leaves_text(spark):
    df = spark.createDataFrame([(None, None, None)], "n bigint, s string, b boolean")
    assert rows(fill_numeric(df, 0)) == [(0, None, None)]


def test_require_drops_rows_lacking_keys(spark):
    df = spark.createDataFrame([(1, 1), (None, 1), (1, None)], "a int, b int")
    assert rows(require(df, ["a", "b"])) == [(1, 1)]


def test_conform_dates(spark):
    df = spark.createDataFrame(
        [("2020-02-29", dt.datetime(2020, 1, 1, 23, 59)), ("n/a", None), (None, None)],
        "d string, t timestamp_ntz")
    out = rows(conform_dates(df, ["d", "t"]))
    assert out == [(dt.date(2020, 2, 29), dt.date(2020, 1, 1)), (None, None), (None, None)]
    with pytest.raises(Exception):
        conform_dates(df, ["d"], strict=True).collect()


def test_merge_join_columns_and_coalesce(spark):
    left = spark.createDataFrame([(1, None, "l1", 10), (2, "c2", "l2", 20)],
                                 "k int, comp string, lonly string, shared int")
    right = spark.createDataFrame([(1, "r1", "ronly1", 99), (3, "r3", "ronly3", 33)],
                                  "k int, comp string, ronly string, shared int")
    inner = merge_join(left, right, "k")
    assert inner.columns == ["k", "comp", "lonly", "shared", "ronly"]
    assert rows(inner) == [(1, "r1", "l1", 10, "ronly1")]
    full = rows(merge_join(left, right, ["k"], "full"), ["k"])
    assert full == [(1, "r1", "l1", 10, "ronly1"), (2, "c2", "l2", 20, None),
                    (3, "r3", None, 33, "ronly3")]
    right_rows = rows(merge_join(left, right, "k", "right"), ["k"])
    assert [r[0] for r in right_rows] == [1, 3]
    assert merge_join(left, right, "k", "left_anti").columns == left.columns
    assert rows(merge_join(left, right, "k", "left_semi")) == [(1, None, "l1", 10)]


def test_merge_join_matches_row_model(spark):
    random.seed(3)
    lrows = [(random.randint(0, 9), random.choice([None, "a", "b"]), random.randint(0, 5))
             for _ in range(60)]
    rrows = [(random.randint(0, 12), random.choice([None, "x"]), random.randint(0, 5))
             for _ in range(40)]
    left = spark.createDataFrame(lrows, "k int, c string, lv int")
    right = spark.createDataFrame(rrows, "k int, c string, rv int")
    for how in ("inner", "left", "right", "full"):
        got = sorted(rows(merge_join(left, right, "k", how)), key=repr)
        model = []
        matched_r = set()
        for lk, lc, lv in lrows:
            hit = False
            for j, (rk, rc, rv) in enumerate(rrows):
                if lk == rk:
                    hit = True
                    matched_r.add(j)
                    model.append((lk, lc if lc is not None else rc, lv, rv))
            if not hit and how in ("left", "full"):
                model.append((lk, lc, lv, None))
        if how in ("right", "full"):
            model += [(rk, rc, None, rv) for j, (rk, rc, rv) in enumerate(rrows)
                      if j not in matched_r]
        assert got == sorted(model, key=repr), how


def test_ratio_and_conditional_aggregates(spark):
    df = spark.createDataFrame([(1, 0), (1, 8), (201, 200)], "n int, d int")
    out = rows(df.select(ratio("n", "d", digits=2).alias("r"), ratio("n", "d", guard=True).alias("g"),
                         ratio("n", "d", scale=100, digits=2).alias("p")))
    assert out[0] == (None, None, None)
    assert out[1] == (0.13, 0.125, 12.5)        # half-up: 0.125 -> 0.13
    assert out[2][0] == 1.01                      # 1.005 -> 1.01, as on decimal text
    g = spark.createDataFrame([("H", True, 2), ("H", False, 3), ("A", True, 4), (None, True, 1)],
                              "h string, w boolean, x int")
    res = g.agg(count_where((F.col("h") == "H") & F.col("w")).alias("hw"),
                sum_where(F.col("h") == "A", "x").alias("ax")).collect()[0]
    assert (res.hw, res.ax) == (1, 4)


def test_top_k_ties_are_repeatable(spark):
    df = spark.createDataFrame([(i, 10 if i % 2 else 5) for i in range(40)], "id int, v int")
    a = rows(top_k(df, 5, [F.desc("v")], tie=["id"]))
    b = rows(top_k(df.repartition(7), 5, [F.desc("v")], tie=["id"]))
    assert a == b == [(1, 10), (3, 10), (5, 10), (7, 10), (9, 10)]


def test_flags_and_calendar(spark):
    df = spark.createDataFrame(
        [("win", 1, None, None, "x", "international", dt.date(2024, 3, 2)),
         ("0", 0, "n", "f", "l", None, dt.date(2024, 3, 4)),
         (None, None, None, None, None, "domestic_league", None)],
        "wt string, wn int, name string, first string, last string, type string, d date")
    out = rows(df.select(
        won(F.col("wt"), T.StringType()), won(F.col("wn"), T.IntegerType()),
        full_name(F.col("name"), F.col("first"), F.col("last")),
        is_international(F.col("type")), date_key(F.col("d")),
        *[c.alias(k) for k, c in calendar_columns(F.col("d")).items() if k in
          ("day_of_week", "day_name", "is_weekend")]))
    assert out[0] == (True, True, "x", True, 20240302, 7, "Saturday", True)
    assert out[1] == (False, False, "n", False, 20240304, 2, "Monday", False)
    assert out[2][:5] == (False, False, "", False, None)


def test_normalize_nulls_escapes_names_and_tokens(spark):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("we`ird col", T.StringType())])
    df = spark.createDataFrame([("it's",), ("a\\b",), ("x`y",), ("null",)], schema)
    out = [r[0] for r in normalize_nulls(df, ["it's", "a\\b", "null"]).collect()]
    assert out == [None, None, "x`y", None]
    assert normalize_nulls(df).columns == ["we`ird col"]

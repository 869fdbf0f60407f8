"""Property tests: operators against plain-Python models on random small tables."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from matchlake.operators import dedupe, merge_join, normalize_nulls

SETTINGS = settings(max_examples=25, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

keys = st.one_of(st.none(), st.integers(0, 4))
texts = st.one_of(st.none(), st.sampled_from(["", "a", "b", "null", "NULL", "Null", "nULL"]))
nums = st.one_of(st.none(), st.integers(-3, 3))


def _ord(v):
    """Spark's ascending order with NULLs first."""
    return (0,) if v is None else (1, v)


@SETTINGS
@given(rows=st.lists(st.tuples(keys, texts, nums), max_size=30))
def test_dedupe_matches_model(spark, rows):
    df = spark.createDataFrame(rows, "k int, s string, v int")
    got = sorted((tuple(r) for r in dedupe(df, ["k"]).collect()), key=repr)
    best = {}
    for k, s, v in rows:
        cand = (s, v)
        if k not in best or tuple(map(_ord, cand)) < tuple(map(_ord, best[k])):
            best[k] = cand
    assert got == sorted(((k, s, v) for k, (s, v) in best.items()), key=repr)


@SETTINGS
@given(rows=st.lists(st.tuples(keys, texts), max_size=20))
def test_normalize_nulls_matches_model(spark, rows):
    df = spark.createDataFrame(rows, "k int, s string")
    got = [tuple(r) for r in normalize_nulls(df).collect()]
    assert got == [(k, None if s in ("null", "NULL", "Null", "") else s) for k, s in rows]


@SETTINGS
@given(left=st.lists(st.tuples(keys, texts, nums), max_size=12),
       right=st.lists(st.tuples(keys, texts, nums), max_size=12),
       how=st.sampled_from(["inner", "left", "right", "full"]))
def test_merge_join_matches_model(spark, left, right, how):
    l_df = spark.createDataFrame(left, "k int, c string, lv int")
    r_df = spark.createDataFrame(right, "k int, c string, rv int")
    got = sorted((tuple(r) for r in merge_join(l_df, r_df, "k", how).collect()), key=repr)
    out, hit_r = [], set()
    for lk, lc, lv in left:
        hit = False
        for j, (rk, rc, rv) in enumerate(right):
            if lk is not None and lk == rk:
                hit = True
                hit_r.add(j)
                out.append((lk, lc if lc is not None else rc, lv, rv))
        if not hit and how in ("left", "full"):
            out.append((lk, lc, lv, None))
    if how in ("right", "full"):
        out += [(rk, rc, None, rv) for j, (rk, rc, rv) in enumerate(right) if j not in hit_r]
    assert got == sorted(out, key=repr)


@SETTINGS
@given(pairs=st.lists(st.tuples(st.integers(0, 10_000), st.integers(1, 2_000)),
                      min_size=1, max_size=40))
def test_ratio_rounds_half_up_on_decimal_text(spark, pairs):
    """``ratio(..., digits=2)`` equals half-up rounding of the double's shortest
    decimal text -- the rule the DuckDB oracle reproduces."""
    from decimal import ROUND_HALF_UP, Decimal

    from matchlake.operators import ratio

    df = spark.createDataFrame(pairs, "n long, d long")
    got = [r[0] for r in df.select(ratio("n", "d", digits=2)).collect()]
    want = [float(Decimal(repr(n / d)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))
            for n, d in pairs]
    assert got == want


@SETTINGS
@given(days=st.lists(st.integers(-20_000, 30_000), min_size=1, max_size=40))
def test_calendar_columns_match_python(spark, days):
    import calendar
    import datetime as dt

    from pyspark.sql import functions as F

    from matchlake.functions import calendar_columns

    dates = [dt.date(1970, 1, 1) + dt.timedelta(days=d) for d in days]
    df = spark.createDataFrame([(d,) for d in dates], "d date")
    cols = calendar_columns(F.col("d"), quarter=True)
    got = [tuple(r) for r in df.select(*[c.alias(k) for k, c in cols.items()]).collect()]
    want = []
    for d in dates:
        dow = (d.isoweekday() % 7) + 1  # 1 = Sunday ... 7 = Saturday
        want.append((d.year * 10000 + d.month * 100 + d.day, d.year, d.month, d.day,
                     (d.month - 1) // 3 + 1, dow, calendar.day_name[d.weekday()],
                     calendar.month_name[d.month], dow in (1, 7)))
    assert got == want

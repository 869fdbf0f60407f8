"""The driver contract of ``__spark_entry__``."""

import __spark_entry__ as entry
from matchlake.plans.registry import QUERIES
from tests.oracle_check import duck


def test_oracles_cover_every_query_of_the_library():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert set(QUERIES) <= set(o)


def test_every_oracle_plans_in_duckdb(sf_small):
    con = duck(sf_small)
    for name, sql in entry.oracle_sql().items():
        con.execute("EXPLAIN " + sql)  # raises on any syntax or binding error


def test_entry_schema_is_stable(spark):
    df = entry.entry(spark)
    assert [(f.name, f.dataType.simpleString()) for f in df.schema.fields] == [
        ("full_name", "string"), ("total_goals", "bigint"), ("country_of_citizenship", "string")]

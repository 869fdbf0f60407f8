"""Shape the driver's TPC-H-style tables into the eight football source tables.

The driver ships ``part supplier nation region orders lineitem events`` (and
more) as Parquet.  This module maps them, column by column, onto the raw
football tables the pipeline ingests, injecting the sentinels and NULLs the
cleaning operators exist for (``'null'``, ``'NULL'``, ``'Null'``, ``''`` and
non-matching variants, NULL keys, unparsable dates and seasons, both encodings
of a win, duplicate composite keys).  Every mapping is one projection of one
scan (competitions is a 25-row join), so the raw tables grow exactly with the
driver tables.

The mappings are Spark SQL expressions applied with ``selectExpr``: one
round trip to the JVM per table instead of one per expression node.  The
same mapping is written independently for DuckDB in ``matchlake/oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import schemas

# Column -> Spark SQL expression over the driver table(s), per raw table.
MAPPINGS: dict[str, dict[str, str]] = {
    "players": {
        "player_id": "p_partkey",
        "name": "CASE WHEN p_partkey % 10 = 0 THEN 'null' ELSE p_name END",
        "first_name": "CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_brand END",
        "last_name": "p_type",
        "country_of_citizenship": "CASE WHEN p_partkey % 11 = 0 THEN 'NULL' ELSE p_brand END",
        "position": "CASE WHEN p_partkey % 17 = 0 THEN 'Missing' "
                    "WHEN p_partkey % 19 = 0 THEN 'null' ELSE p_type END",
        "sub_position": "CASE WHEN p_partkey % 3 = 0 THEN '' "
                        "WHEN p_partkey % 13 = 0 THEN 'nULL' ELSE p_type END",
        "date_of_birth": "CASE WHEN p_partkey % 23 = 0 THEN 'unknown' ELSE "
                         "CAST(date_add(DATE'1980-01-01', CAST(p_partkey % 9000 AS INT)) "
                         "AS STRING) END",
        "foot": "CASE WHEN p_size % 3 = 0 THEN 'right' WHEN p_size % 3 = 1 THEN 'left' "
                "ELSE 'both' END",
        "height_in_cm": "p_size + 150",
        "current_club_id": "p_partkey % 100",
        "current_club_name": "concat('Club ', CAST(p_partkey % 100 AS STRING))",
        "agent_name": "CASE WHEN p_partkey % 4 = 0 THEN ' null ' "
                      "WHEN p_partkey % 4 = 1 THEN 'Null' ELSE concat('Agent ', p_brand) END",
        "country_of_birth": "p_brand",
        "city_of_birth": "p_name",
        "player_code": "replace(p_name, ' ', '-')",
    },
    "clubs": {
        "club_id": "s_suppkey",
        "name": "CASE WHEN s_suppkey % 9 = 0 THEN NULL WHEN s_suppkey % 9 = 4 THEN 'NULL' "
                "ELSE s_name END",
        "club_code": "lower(s_name)",
        "domestic_competition_id": "CAST(s_nationkey AS STRING)",
        "squad_size": "CASE WHEN s_suppkey % 41 = 0 THEN NULL ELSE s_suppkey % 40 END",
        "average_age": "CASE WHEN s_suppkey % 43 = 0 THEN NULL ELSE s_suppkey % 15 + 20.0 END",
        "foreigners_number": "s_suppkey % 20",
        "foreigners_percentage": "s_suppkey % 100",
        "national_team_players": "s_nationkey % 5",
        "stadium_name": "concat(s_name, ' Stadium')",
        "stadium_seats": "floor(abs(s_acctbal))",
        "total_market_value": "s_acctbal",
        "net_transfer_record": "CASE WHEN s_acctbal < 0 THEN 'deficit' ELSE 'surplus' END",
        "coach_name": "concat('Coach ', CAST(s_suppkey AS STRING))",
        "last_season": "s_suppkey % 25 + 2000",
    },
    "competitions": {
        "competition_id": "CAST(n_nationkey AS STRING)",
        "name": "CASE WHEN n_nationkey IN (3, 9) THEN 'premier-liga' ELSE n_name END",
        "competition_code": "lower(n_name)",
        "type": "CASE WHEN n_nationkey = 24 THEN NULL "
                "WHEN n_regionkey = 0 THEN 'international_cup' "
                "WHEN n_regionkey = 1 THEN 'international' "
                "WHEN n_regionkey = 2 THEN 'domestic_cup' ELSE 'domestic_league' END",
        "sub_type": "'first_tier'",
        "country_id": "n_nationkey",
        "country_name": "CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE r_name END",
        "domestic_league_code": "CAST(n_nationkey AS STRING)",
        "confederation": "r_name",
    },
    "games": {
        "game_id": "o_orderkey",
        # Every 103rd game names a competition that does not exist.
        "competition_id": "CASE WHEN o_orderkey % 103 = 0 THEN '99' "
                          "ELSE CAST(o_custkey % 25 AS STRING) END",
        "season": "CASE WHEN o_orderkey % 89 = 0 THEN 'null' "
                  "WHEN o_orderkey % 97 = 0 THEN concat(CAST(year(o_orderdate) AS STRING), '/', "
                  "lpad(CAST((year(o_orderdate) + 1) % 100 AS STRING), 2, '0')) "
                  "ELSE CAST(year(o_orderdate) AS STRING) END",
        "round": "o_orderpriority",
        "date": "CASE WHEN o_orderkey % 101 = 0 THEN 'NULL' "
                "ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END",
        "home_club_id": "o_orderkey % 100",
        "away_club_id": "(o_orderkey + 7) % 100",
        "home_club_goals": "o_custkey % 5",
        "away_club_goals": "o_orderkey % 4",
        "home_club_position": "o_custkey % 20 + 1",
        "away_club_position": "o_orderkey % 20 + 1",
        "attendance": "CASE WHEN o_orderkey % 13 = 0 THEN NULL "
                      "ELSE CAST(floor(o_totalprice) AS INT) END",
        "competition_type": "o_orderstatus",
    },
    "appearances": {
        "appearance_id": "concat_ws('-', CAST(l_orderkey AS STRING), "
                         "CAST(l_linenumber AS STRING), CAST(l_partkey AS STRING))",
        # Line 7 points at a game that does not exist (an orphan appearance).
        "game_id": "CASE WHEN l_linenumber = 7 THEN -1 - l_orderkey ELSE l_orderkey END",
        "player_id": "CASE WHEN floor(l_extendedprice) % 50 = 0 THEN NULL ELSE l_partkey END",
        "player_club_id": "l_suppkey",
        "competition_id": "CASE WHEN l_linenumber = 1 THEN NULL "
                          "ELSE CAST(l_partkey % 25 AS STRING) END",
        "date": "CASE WHEN l_linenumber = 2 THEN NULL WHEN l_linenumber = 3 THEN 'n/a' "
                "ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END",
        "goals": "floor(l_quantity) % 3",
        "assists": "l_linenumber % 2",
        "yellow_cards": "CASE WHEN l_returnflag = 'R' THEN 1 END",
        "red_cards": "CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 1 END",
        "minutes_played": "floor(l_quantity)",
    },
    "club_games": {
        "game_id": "l_orderkey",
        "club_id": "l_suppkey",
        "opponent_id": "(l_suppkey + 1) % 100",
        "own_goals": "floor(l_quantity) % 5",
        "opponent_goals": "l_linenumber % 4",
        "own_position": "l_linenumber",
        "opponent_position": "l_linenumber % 3 + 1",
        "hosting": "CASE WHEN l_linenumber % 2 = 0 THEN 'Home' ELSE 'Away' END",
        # Both encodings seen in the wild: numeric text and 'win'.
        "is_win": "CASE WHEN l_linestatus = 'F' AND l_linenumber % 2 = 0 THEN 'win' "
                  "WHEN l_linestatus = 'F' THEN '1' "
                  "WHEN l_linenumber % 3 = 0 THEN 'null' ELSE '0' END",
    },
    "game_events": {
        "game_event_id": "event_id",
        "game_id": "CASE WHEN event_id % 17 = 0 THEN NULL ELSE user_id END",
        "type": "event_type",
        "description": "CASE WHEN event_type = 'error' THEN NULL "
                       "WHEN event_type = 'view' THEN 'null' "
                       "ELSE concat(event_type, ':', props) END",
    },
    "player_valuations": {
        "player_id": "user_id",
        "date": "CAST(ts AS STRING)",
        "datetime": "ts",
        "market_value_in_eur": "value",
    },
}

# Raw table -> driver table it is projected from.
SOURCES = {
    "players": "part", "clubs": "supplier", "games": "orders", "appearances": "lineitem",
    "club_games": "lineitem", "game_events": "events", "player_valuations": "events",
}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _project(df: DataFrame, table: str) -> DataFrame:
    """Apply the mapping, cast to the declared schema, keep its column order."""
    exprs = MAPPINGS[table]
    return df.selectExpr(*[f"CAST({exprs[f.name]} AS {f.dataType.simpleString()}) AS {f.name}"
                           for f in schemas.SCHEMAS[table].fields])


def _source(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    if table == "competitions":
        n = _read(spark, sf_dir, "nation")
        r = _read(spark, sf_dir, "region")
        return n.join(r, n["n_regionkey"] == r["r_regionkey"], "inner")
    return _read(spark, sf_dir, SOURCES[table])


def build(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return _project(_source(spark, sf_dir, table), table)


def _builder(table: str):
    def make(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(spark, sf_dir, table)
    make.__name__ = table
    return make


players = _builder("players")
appearances = _builder("appearances")
club_games = _builder("club_games")
clubs = _builder("clubs")
competitions = _builder("competitions")
game_events = _builder("game_events")
games = _builder("games")
player_valuations = _builder("player_valuations")

BUILDERS = {
    "players": players,
    "appearances": appearances,
    "club_games": club_games,
    "clubs": clubs,
    "competitions": competitions,
    "game_events": game_events,
    "games": games,
    "player_valuations": player_valuations,
}


def raw_tables(spark: SparkSession, sf_dir: str):
    """All eight raw football tables over the driver tables, each built on first access."""
    from ..plans.star import LazyTables

    return LazyTables({name: (lambda b=b: b(spark, sf_dir)) for name, b in BUILDERS.items()})

"""Conformed (silver) layer: one fold of cleaning operators per table spec."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import age_in_years, full_name, is_international, stamp
from ..operators.clean import conform_dates, dedupe, dedupe_sparse, fill_defaults, int_or_null, normalize_nulls, require
from ..sources.schemas import SPECS, TableSpec
from .edition import Edition

# Tables each edition conforms (the full edition builds club facts from raw).
COMPACT_TABLES = ("players", "appearances", "games", "clubs", "competitions",
                  "game_events", "club_games", "player_valuations")
FULL_TABLES = ("players", "appearances", "games", "clubs", "competitions", "game_events")


def _derived(df: DataFrame, spec: TableSpec, ed: Edition) -> DataFrame:
    name = spec.name
    cols = {}
    if name == "players":
        cols["full_name"] = full_name(F.col("name"), F.col("first_name"), F.col("last_name"))
    elif name == "games":
        cols["season_year"] = int_or_null(F.col("season"))
        cols["total_goals"] = F.col("home_club_goals") + F.col("away_club_goals")
    elif name == "competitions":
        cols["is_international"] = is_international(F.col("type"))
    df = df.withColumns(cols) if cols else df
    df = conform_dates(df, spec.dates)
    extra = {}
    if ed.stamps and name == "players":
        extra["age"] = age_in_years(F.col("date_of_birth"), ed.today)
    if ed.stamps:
        extra["ingestion_timestamp"] = stamp(ed.as_of)
    return df.withColumns(extra) if extra else df


def conform_table(raw: DataFrame, spec: TableSpec, ed: Edition, stored: bool = False) -> DataFrame:
    """normalize sentinels -> de-duplicate -> drop rows lacking keys -> fill -> derive.

    ``stored``: ``raw`` is a written table, cheap to scan again, so keys are counted before any
    row is compared (``dedupe_sparse``); the rows are the same."""
    df = normalize_nulls(raw, ed.null_tokens)
    if spec.dedupe:
        df = (dedupe_sparse if stored else dedupe)(df, spec.keys)
    df = require(df, spec.required)
    df = fill_defaults(df, spec.defaults)
    return _derived(df, spec, ed)


def conform_all(raw: Mapping[str, DataFrame], ed: Edition, stored: bool = False) -> "LazyTables":
    """The edition's conformed tables, each built on first access."""
    from .star import LazyTables

    tables = COMPACT_TABLES if ed.name == "compact" else FULL_TABLES
    return LazyTables({t: (lambda t=t: conform_table(raw[t], SPECS[t], ed, stored)) for t in tables})

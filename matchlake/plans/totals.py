"""Mergeable totals per (player, season, competition): one pass over the appearance fact.

Sums and counts of these groups add up to those of any coarser group, so every report
per player, per season or per competition can be derived from them.  The table has at most one
row per player, season and competition, however many appearances there are; the jobs
write it once beside the facts (partitioned by season), and reports read it instead of the fact.  New
appearances are folded in with ``merge_totals``, without reading the old ones again.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEYS = ("player_key", "season_year", "competition_key")

# Measure -> its aggregate over appearances.  A sum over no value is NULL, a count 0, at every level.
MEASURES: dict[str, Callable[[], Column]] = {
    "apps": lambda: F.count(F.lit(1)),
    "games": lambda: F.count("game_key"),
    "goals": lambda: F.sum("goals"),
    "n_goals": lambda: F.count("goals"),
    "assists": lambda: F.sum("assists"),
    "n_assists": lambda: F.count("assists"),
    "yellow_cards": lambda: F.sum("yellow_cards"),
    "red_cards": lambda: F.sum("red_cards"),
    "minutes_played": lambda: F.sum("minutes_played"),
}


def player_totals(fact: DataFrame) -> DataFrame:
    """(player_key, season_year, competition_key, measures): NULL keys are groups of their own."""
    return fact.groupBy(*KEYS).agg(*[make().alias(m) for m, make in MEASURES.items()])


def merge_totals(*parts: DataFrame) -> DataFrame:
    """Totals of all appearances behind several totals tables (disjoint loads of the fact)."""
    rows = reduce(DataFrame.unionByName, parts)
    return rows.groupBy(*KEYS).agg(*[F.sum(m).alias(m) for m in MEASURES])


def totals_per_player(totals: DataFrame) -> DataFrame:
    """One row per player (a NULL player too) over all seasons and competitions of a totals table: what reports per
    player share, so that the totals are shuffled by player once and not for every report."""
    return totals.groupBy("player_key").agg(*[F.sum(m).alias(m) for m in MEASURES])


def totals_by(star, keys: list[str], where: Column | None = None, within: DataFrame | None = None,
              **measures: str) -> DataFrame:
    """One row per ``keys`` (some of ``KEYS``) with ``measures`` (output name -> measure).

    Derived from the star's stored totals where it has them, else from the fact in one
    aggregate; the rows are the same.  Whole totals per player are read as they are stored.  ``where`` filters, and ``within`` semi-joins on its only
    column, by the keys of the totals."""
    stored = star.player_totals
    whole = star.player_totals_per_player
    if whole is not None and list(keys) == ["player_key"] and where is None and within is None:
        return whole.select("player_key", *[F.col(m).alias(name) for name, m in measures.items()])
    rows = star.fact_appearance if stored is None else stored
    if where is not None:
        rows = rows.filter(where)
    if within is not None:
        rows = rows.join(within, within.columns[0], "left_semi")
    aggs = [(MEASURES[m]() if stored is None else F.sum(m)).alias(name) for name, m in measures.items()]
    return rows.groupBy(*keys).agg(*aggs)

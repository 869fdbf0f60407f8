"""Explicit schemas and per-table conformance specs for the eight source tables.

Schemas are declared rather than inferred: inference costs a second full pass
over CSV input and silently types a numeric column holding the text ``null`` as
a string.  ``TableSpec`` is the single description the conform layer folds
over (keys, required columns, defaults, date columns).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


S, L, I, D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()

PLAYERS = _schema(
    ("player_id", L), ("name", S), ("first_name", S), ("last_name", S),
    ("country_of_citizenship", S), ("position", S), ("sub_position", S),
    ("date_of_birth", S), ("foot", S), ("height_in_cm", I), ("current_club_id", L),
    ("current_club_name", S), ("agent_name", S), ("country_of_birth", S),
    ("city_of_birth", S), ("player_code", S),
)

APPEARANCES = _schema(
    ("appearance_id", S), ("game_id", L), ("player_id", L), ("player_club_id", L),
    ("competition_id", S), ("date", S), ("goals", I), ("assists", I),
    ("yellow_cards", I), ("red_cards", I), ("minutes_played", I),
)

GAMES = _schema(
    ("game_id", L), ("competition_id", S), ("season", S), ("round", S), ("date", S),
    ("home_club_id", L), ("away_club_id", L), ("home_club_goals", I),
    ("away_club_goals", I), ("home_club_position", I), ("away_club_position", I),
    ("attendance", I), ("competition_type", S),
)

CLUBS = _schema(
    ("club_id", L), ("name", S), ("club_code", S), ("domestic_competition_id", S),
    ("squad_size", I), ("average_age", D), ("foreigners_number", I),
    ("foreigners_percentage", D), ("national_team_players", I), ("stadium_name", S),
    ("stadium_seats", I), ("total_market_value", D), ("net_transfer_record", S),
    ("coach_name", S), ("last_season", I),
)

COMPETITIONS = _schema(
    ("competition_id", S), ("name", S), ("competition_code", S), ("type", S),
    ("sub_type", S), ("country_id", I), ("country_name", S),
    ("domestic_league_code", S), ("confederation", S),
)

GAME_EVENTS = _schema(
    ("game_event_id", L), ("game_id", L), ("type", S), ("description", S),
)

CLUB_GAMES = _schema(
    ("game_id", L), ("club_id", L), ("opponent_id", L), ("own_goals", I),
    ("opponent_goals", I), ("own_position", I), ("opponent_position", I),
    ("hosting", S), ("is_win", S),
)

PLAYER_VALUATIONS = _schema(
    ("player_id", L), ("date", S), ("datetime", T.TimestampNTZType()),
    ("market_value_in_eur", D),
)

SCHEMAS: dict[str, T.StructType] = {
    "players": PLAYERS,
    "appearances": APPEARANCES,
    "club_games": CLUB_GAMES,
    "clubs": CLUBS,
    "competitions": COMPETITIONS,
    "game_events": GAME_EVENTS,
    "games": GAMES,
    "player_valuations": PLAYER_VALUATIONS,
}

# Ingestion order of the raw layer (fixed value: the eight source file names).
SOURCE_TABLES = [
    "players", "appearances", "club_games", "clubs",
    "competitions", "game_events", "games", "player_valuations",
]


@dataclass(frozen=True)
class TableSpec:
    """How one source table is conformed.

    keys      -- natural key; rows are de-duplicated on it when ``dedupe``.
    required  -- rows with NULL in any of these are dropped (counted as rejects).
    defaults  -- typed fill values for NULLs.
    dates     -- text/timestamp columns conformed to DATE.
    """

    name: str
    keys: tuple[str, ...] = ()
    dedupe: bool = False
    required: tuple[str, ...] = ()
    defaults: dict = field(default_factory=dict)
    dates: tuple[str, ...] = ()


# Fill defaults and required keys per table.
_UNKNOWN = "Unknown"
SPECS: dict[str, TableSpec] = {
    "players": TableSpec(
        "players", keys=("player_id",), dedupe=True,
        defaults={"first_name": _UNKNOWN, "last_name": _UNKNOWN,
                  "country_of_citizenship": _UNKNOWN, "position": _UNKNOWN,
                  "sub_position": _UNKNOWN},
        dates=("date_of_birth",)),
    "appearances": TableSpec(
        "appearances", keys=("appearance_id",), required=("player_id", "game_id"),
        defaults={"yellow_cards": 0, "red_cards": 0, "goals": 0, "assists": 0,
                  "minutes_played": 0},
        dates=("date",)),
    "games": TableSpec(
        "games", keys=("game_id",), dedupe=True, required=("game_id",), dates=("date",)),
    "clubs": TableSpec(
        "clubs", keys=("club_id",), dedupe=True,
        defaults={"name": "Unknown Club", "squad_size": 0, "average_age": 0.0,
                  "foreigners_number": 0}),
    "competitions": TableSpec(
        "competitions", keys=("competition_id",), dedupe=True,
        defaults={"country_name": _UNKNOWN}),
    "game_events": TableSpec(
        "game_events", required=("game_id",), defaults={"description": ""}),
    "club_games": TableSpec("club_games", keys=("game_id", "club_id"), dedupe=True),
    "player_valuations": TableSpec("player_valuations", dates=("date", "datetime")),
}

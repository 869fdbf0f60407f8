"""Star schema (gold): four dimensions, three facts, for either edition."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calendar_columns, date_key, stamp, won
from ..operators.clean import int_or_null
from ..operators.combine import merge_join
from .edition import Edition


DIM_TABLES = ("dim_player", "dim_club", "dim_competition", "dim_date")
FACT_TABLES = ("fact_appearance", "fact_game", "fact_club_perf")


class LazyTables(Mapping):
    """Name -> DataFrame, where each value may be given as a zero-argument
    builder and is built on first access only.

    PySpark analyses every transformation eagerly, so building tables a query
    never reads costs driver time; laziness keeps each query to its own plan.
    """

    def __init__(self, sources: Mapping[str, DataFrame | Callable[[], DataFrame]]):
        self._src = dict(sources)
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            v = self._src[name]
            self._built[name] = v if isinstance(v, DataFrame) else v()
        return self._built[name]

    def __iter__(self):
        return iter(self._src)

    def __len__(self) -> int:
        return len(self._src)


class Star:
    """The seven gold tables (values or lazy builders), and the totals where they are stored."""

    TABLES = DIM_TABLES + FACT_TABLES

    def __init__(self, **tables):
        missing = set(self.TABLES) - set(tables)
        if missing:
            raise TypeError(f"Star: missing tables {sorted(missing)}")
        self._t = LazyTables(tables)

    @property
    def player_totals(self) -> DataFrame | None:
        return self._t["player_totals"] if "player_totals" in list(self._t) else None

    @property
    def player_totals_per_player(self) -> DataFrame | None:
        return self._t["player_totals_per_player"] if "player_totals_per_player" in list(self._t) else None

    dim_player = property(lambda self: self._t["dim_player"])
    dim_club = property(lambda self: self._t["dim_club"])
    dim_competition = property(lambda self: self._t["dim_competition"])
    dim_date = property(lambda self: self._t["dim_date"])
    fact_appearance = property(lambda self: self._t["fact_appearance"])
    fact_game = property(lambda self: self._t["fact_game"])
    fact_club_perf = property(lambda self: self._t["fact_club_perf"])

    def tables(self) -> dict[str, DataFrame]:
        return {n: self._t[n] for n in self.TABLES}

# Column lists of each table, in order, per edition.
PLAYER_COLS = {
    "compact": ["full_name", "first_name", "last_name", "country_of_citizenship",
                "date_of_birth", "position", "sub_position", "foot", "height_in_cm",
                "current_club_name", "agent_name"],
    "full": ["full_name", "first_name", "last_name", "country_of_birth", "city_of_birth",
             "country_of_citizenship", "date_of_birth", "age", "position", "sub_position",
             "foot", "height_in_cm", "player_code", "current_club_id", "current_club_name",
             "agent_name", "ingestion_timestamp"],
}
CLUB_COLS = {
    "compact": ["name", "club_code", "domestic_competition_id", "squad_size", "average_age",
                "foreigners_number", "stadium_name", "stadium_seats", "coach_name"],
    "full": ["name", "club_code", "domestic_competition_id", "squad_size", "average_age",
             "foreigners_number", "foreigners_percentage", "national_team_players",
             "stadium_name", "stadium_seats", "total_market_value", "net_transfer_record",
             "coach_name", "last_season", "ingestion_timestamp"],
}
COMPETITION_COLS = {
    "compact": ["name", "type", "country_name", "confederation", "is_international"],
    "full": ["name", "competition_code", "type", "sub_type", "country_id", "country_name",
             "domestic_league_code", "confederation", "is_international", "ingestion_timestamp"],
}
GAME_MEASURES = {
    "compact": ["round", "home_club_goals", "away_club_goals", "total_goals", "attendance"],
    "full": ["round", "home_club_goals", "away_club_goals", "total_goals",
             "home_club_position", "away_club_position", "attendance", "competition_type"],
}
APPEARANCE_RENAMES = {"appearance_id": "appearance_key", "game_id": "game_key",
                      "player_id": "player_key", "player_club_id": "club_key",
                      "competition_id": "competition_key"}


def dim_player(players: DataFrame, ed: Edition) -> DataFrame:
    return players.select(F.col("player_id").alias("player_key"), *PLAYER_COLS[ed.name])


def dim_club(clubs: DataFrame, ed: Edition) -> DataFrame:
    return clubs.select(F.col("club_id").alias("club_key"), *CLUB_COLS[ed.name])


def dim_competition(competitions: DataFrame, ed: Edition) -> DataFrame:
    return competitions.select(F.col("competition_id").alias("competition_key"),
                               *COMPETITION_COLS[ed.name])


def dim_date(games: DataFrame, ed: Edition) -> DataFrame:
    """Calendar rows for the distinct non-NULL game dates (not a generated range).

    Its size is bounded by the number of calendar days the games span.
    """
    dates = games.select("date").filter(F.col("date").isNotNull()).distinct()
    cols = calendar_columns(F.col("date"), quarter=ed.name == "full")
    if ed.stamps:
        cols["ingestion_timestamp"] = stamp(ed.as_of)
    return dates.withColumns(cols)


def fact_appearance(appearances: DataFrame, games: DataFrame, ed: Edition, spread: bool = True) -> DataFrame:
    """Appearances merged with their game (inner): competition and date fall back to
    the game's.  A game with very many appearances is split (``merge_join``), unless both tables
    are clustered by game and joined as they lie (``spread=False``)."""
    merged = merge_join(appearances, games, "game_id", "inner", spread)
    if ed.name == "compact":
        return merged.select(
            *[F.col(c).alias(key) for c, key in APPEARANCE_RENAMES.items()],
            date_key(F.col("date")).alias("date_key"),
            "season_year", "goals", "assists", "yellow_cards", "red_cards", "minutes_played",
        )
    out = merged.withColumnsRenamed(APPEARANCE_RENAMES).withColumns({
        "date_key": date_key(F.col("date")),
        "season_year": int_or_null(F.col("season")),
        "ingestion_timestamp": stamp(ed.as_of),
    })
    return out.filter(F.col("player_key").isNotNull())


def fact_game(games: DataFrame, ed: Edition) -> DataFrame:
    cols = [
        F.col("game_id").alias("game_key"),
        F.col("competition_id").alias("competition_key"),
        F.col("home_club_id").alias("home_club_key"),
        F.col("away_club_id").alias("away_club_key"),
        date_key(F.col("date")).alias("date_key"),
        F.col("season_year"),
        *GAME_MEASURES[ed.name],
    ]
    if ed.stamps:
        cols.append(stamp(ed.as_of).alias("ingestion_timestamp"))
    return games.select(cols)


def fact_club_perf(club_games: DataFrame, ed: Edition) -> DataFrame:
    """Club-per-game facts; ``won``, a column that this library adds, is a boolean read
    from either is_win encoding, so that every report counts wins alike."""
    win_type = club_games.schema["is_win"].dataType
    cols = [
        F.col("game_id").alias("game_key"),
        F.col("club_id").alias("club_key"),
        F.col("opponent_id").alias("opponent_club_key"),
        "own_goals", "opponent_goals",
    ]
    if ed.name == "full":
        cols += ["own_position", "opponent_position"]
    cols += ["hosting", "is_win", won(F.col("is_win"), win_type).alias("won")]
    if ed.stamps:
        cols.append(stamp(ed.as_of).alias("ingestion_timestamp"))
    return club_games.select(cols)


def build_star(silver: Mapping[str, DataFrame], raw: Mapping[str, DataFrame],
               ed: Edition) -> Star:
    """All seven gold tables as lazy plans over the conformed tables.

    The compact edition reads club games from the conformed layer, the full
    edition from the raw layer (not de-duplicated).
    """
    def club_games() -> DataFrame:
        return silver["club_games"] if ed.name == "compact" else raw["club_games"]

    return Star(
        dim_player=lambda: dim_player(silver["players"], ed),
        dim_club=lambda: dim_club(silver["clubs"], ed),
        dim_competition=lambda: dim_competition(silver["competitions"], ed),
        dim_date=lambda: dim_date(silver["games"], ed),
        fact_appearance=lambda: fact_appearance(silver["appearances"], silver["games"], ed),
        fact_game=lambda: fact_game(silver["games"], ed),
        fact_club_perf=lambda: fact_club_perf(club_games(), ed),
    )

"""The fifteen business reports, each in a compact and a full edition.

Plan shape used throughout: aggregate the fact on its key first, then join the
(deduplicated, key-unique) dimension, so the large dimension joins see one row
per key instead of one per appearance.  Reports that need nothing of the appearance fact but
sums per player, season or competition take them from the star's stored totals where it has
them (``totals.totals_by``).  Top-k reports cut before they fetch attributes
(``top_k_late``) and break ties on the dimension key, so the cut is repeatable.  Reports without a limit sort their
output by default, as defined; ``ordered=False`` skips that global sort for
consumers that sort on read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.clean import fill_defaults, fill_numeric
from ..operators.combine import spread_join
from ..operators.metrics import MOST_BROADCAST, count_where, ratio, sum_where, top_k, top_k_late
from .star import Star
from .totals import totals_by

ReportFn = Callable[..., DataFrame]
REPORTS: dict[str, ReportFn] = {}

DEFAULT_SEASON = 2014


def report(num: int, edition: str):
    def deco(fn: ReportFn) -> ReportFn:
        REPORTS[f"report{num:02d}_{edition}"] = fn
        return fn
    return deco


def _order(df: DataFrame, ordered: bool, *cols) -> DataFrame:
    """Sort for read-out, or leave unordered (``ordered=False``) when the
    consumer sorts: a global sort is a range shuffle plus a sampling job."""
    return df.orderBy(*cols) if ordered else df


def _per_player(star: Star, where=None, **measures: str) -> DataFrame:
    return totals_by(star, ["player_key"], where, **measures)


# ---------------------------------------------------------------- R01 clubs per player
@report(1, "compact")
def report01_compact(star: Star, ordered: bool = True) -> DataFrame:
    # Distinct (player, club) pairs first: the club join then sees one row per pair.
    pairs = star.fact_appearance.select("player_key", "club_key").distinct()
    named = spread_join(pairs, star.dim_club.select("club_key", "name"), "club_key")
    # Distinct names as rows, then a count: no set of a player's clubs in memory.
    clubs = (named.select("player_key", "name").distinct()
             .groupBy("player_key").agg(F.count("name").alias("number_of_clubs")))
    return (star.dim_player.join(clubs, "player_key")
            .select("full_name", "country_of_citizenship", "position", "number_of_clubs")
            .transform(_order, ordered, F.desc("number_of_clubs")))


@report(1, "full")
def report01_full(star: Star, ordered: bool = True) -> DataFrame:
    named = spread_join(star.fact_appearance.select("player_key", "club_key"),
                        star.dim_club.select("club_key", F.col("name").alias("club_name")), "club_key", "left")
    # The player's set of names is a column of the report, so it is in memory in any case: every task
    # cuts its rows to sets before the one shuffle by player.
    clubs = (named.groupBy("player_key").agg(F.array_sort(F.collect_set("club_name")).alias("clubs_played"))
             .withColumn("number_of_clubs", F.size("clubs_played").cast("bigint")))
    players = star.dim_player.select("player_key", "full_name", "country_of_citizenship",
                                     "position", "date_of_birth", "age", "current_club_name")
    out = players.join(clubs, "player_key", "left")
    return (fill_defaults(out, {"number_of_clubs": 0})
            .transform(_order, ordered, F.desc("number_of_clubs")))


# ---------------------------------------------------------------- R02 international apps
def _international(star: Star, **measures: str) -> DataFrame:
    comps = star.dim_competition.filter(F.col("is_international")).select("competition_key")
    return totals_by(star, ["player_key"], within=comps, **measures)


@report(2, "compact")
def report02_compact(star: Star, ordered: bool = True) -> DataFrame:
    stats = _international(star, intl_apps="apps", intl_goals="goals")
    return (star.dim_player.join(stats, "player_key")
            .select("full_name", "country_of_citizenship", "intl_apps", "intl_goals")
            .transform(_order, ordered, F.desc("intl_apps")))


@report(2, "full")
def report02_full(star: Star, k: int = 50) -> DataFrame:
    stats = _international(star, international_appearances="apps", international_goals="goals",
                           international_assists="assists", total_minutes="minutes_played")
    return top_k_late(stats, star.dim_player, "player_key", k, [F.desc("international_appearances")],
                      ["player_key", "full_name", "country_of_citizenship", "position",
                       "international_appearances", "international_goals", "international_assists", "total_minutes"])


# ---------------------------------------------------------------- R03 season top scorers
@report(3, "compact")
def report03_compact(star: Star, season: int = DEFAULT_SEASON, k: int = 10) -> DataFrame:
    stats = _per_player(star, F.col("season_year") == season, total_goals="goals")
    return top_k_late(stats, star.dim_player, "player_key", k, [F.desc("total_goals")],
                      ["full_name", "total_goals", "country_of_citizenship"])


@report(3, "full")
def report03_full(star: Star, season: int = DEFAULT_SEASON, k: int = 10) -> DataFrame:
    stats = _per_player(star, F.col("season_year") == season, total_goals="goals", matches_played="games",
                        total_assists="assists", total_minutes="minutes_played").filter(F.col("total_goals") > 0)
    stats = stats.withColumn("goals_per_match", ratio("total_goals", "matches_played", digits=2))
    return top_k_late(stats, star.dim_player, "player_key", k, [F.desc("total_goals"), F.desc("goals_per_match")],
                      ["player_key", "full_name", "country_of_citizenship", "position", "current_club_name",
                       "total_goals", "matches_played", "total_assists", "total_minutes", "goals_per_match"])


# ---------------------------------------------------------------- R04 red cards
@report(4, "compact")
def report04_compact(star: Star, ordered: bool = True) -> DataFrame:
    stats = _per_player(star, total_reds="red_cards", total_games="games").filter(F.col("total_reds") > 0)
    return (star.dim_player.join(stats, "player_key")
            .select("full_name", "total_reds", "total_games")
            .transform(_order, ordered, F.desc("total_reds")))


@report(4, "full")
def report04_full(star: Star, k: int = 5) -> DataFrame:
    stats = _per_player(star, total_red_cards="red_cards", total_yellow_cards="yellow_cards",
                        total_appearances="games").filter(F.col("total_red_cards") > 0)
    stats = stats.withColumn("cards_per_game", ratio(F.col("total_red_cards") + F.col("total_yellow_cards"),
                                                     "total_appearances", digits=2))
    return top_k_late(stats, star.dim_player, "player_key", k, [F.desc("total_red_cards"), F.desc("total_yellow_cards")],
                      ["player_key", "full_name", "country_of_citizenship", "position", "current_club_name",
                       "total_red_cards", "total_yellow_cards", "total_appearances", "cards_per_game"])


# ---------------------------------------------------------------- R05 successful clubs
@report(5, "compact")
def report05_compact(star: Star, k: int = 20) -> DataFrame:
    wins = star.fact_club_perf.groupBy("club_key").agg(count_where(F.col("won")).alias("total_wins"))
    return top_k_late(wins, star.dim_club, "club_key", k, [F.desc("total_wins")], ["name", "total_wins"])


@report(5, "full")
def report05_full(star: Star, k: int = 5) -> DataFrame:
    stats = (star.fact_club_perf.groupBy("club_key").agg(
        count_where(F.col("won")).alias("total_wins"),
        F.count("*").alias("total_matches"),
        F.sum("own_goals").alias("total_goals_scored"),
        F.sum("opponent_goals").alias("total_goals_conceded"))
        .withColumns({
            "win_percentage": ratio("total_wins", "total_matches", scale=100, digits=2),
            "goal_difference": F.col("total_goals_scored") - F.col("total_goals_conceded"),
        }))
    return top_k_late(
        stats, star.dim_club, "club_key", k, [F.desc("total_wins"), F.desc("win_percentage"), F.desc("goal_difference")],
        ["club_key", "name", "domestic_competition_id", "stadium_name", "total_wins", "total_matches",
         "win_percentage", "total_goals_scored", "total_goals_conceded", "goal_difference", "squad_size",
         "total_market_value"])


# ---------------------------------------------------------------- R06 player performance
@report(6, "compact")
def report06_compact(star: Star, ordered: bool = True) -> DataFrame:
    stats = _per_player(star, total_goals="goals", total_assists="assists", apps="games")
    return (stats.join(star.dim_player, "player_key")
            .select("full_name", "total_goals", "total_assists", "apps")
            .transform(_order, ordered, F.desc("total_goals")))


@report(6, "full")
def report06_full(star: Star, ordered: bool = True) -> DataFrame:
    stats = _per_player(star, total_appearances="games", total_goals="goals", total_assists="assists",
                        total_yellows="yellow_cards", total_reds="red_cards",
                        total_minutes="minutes_played").filter(F.col("total_appearances") > 0)
    return (star.dim_player.join(stats, "player_key")
            .select("player_key", "full_name", "country_of_citizenship", "position", "age",
                    "current_club_name", "total_appearances", "total_goals", "total_assists",
                    "total_minutes", "total_yellows", "total_reds")
            .withColumns({
                "goal_contribution": F.col("total_goals") + F.col("total_assists"),
                "goals_per_appearance": ratio("total_goals", "total_appearances", digits=2),
            })
            .transform(_order, ordered, F.desc("goal_contribution")))


# ---------------------------------------------------------------- R07 competition statistics
@report(7, "compact")
def report07_compact(star: Star, ordered: bool = True) -> DataFrame:
    # Per competition first: the join and the names see one row per competition.
    games = star.fact_game.groupBy("competition_key").agg(
        F.count("game_key").alias("n"), F.sum("total_goals").alias("g"), F.count("total_goals").alias("ng"),
        F.sum("attendance").alias("a"), F.count("attendance").alias("na"))
    return (games.join(star.dim_competition, "competition_key")
            .groupBy("name", "type", "country_name")
            .agg(F.sum("n").alias("total_games"),
                 F.try_divide(F.sum("g"), F.sum("ng")).alias("avg_goals"),
                 F.try_divide(F.sum("a"), F.sum("na")).alias("avg_attendance"))
            .transform(_order, ordered, F.desc("avg_attendance")))


@report(7, "full")
def report07_full(star: Star, ordered: bool = True) -> DataFrame:
    games = star.fact_game.groupBy("competition_key").agg(
        F.count("game_key").alias("total_games"), F.sum("total_goals").alias("total_goals"),
        F.avg("total_goals").alias("avg_goals_per_game"),
        F.avg("attendance").alias("avg_attendance"))
    cards = totals_by(star, ["competition_key"], total_red_cards="red_cards", total_yellow_cards="yellow_cards")
    out = (star.dim_competition.join(games, "competition_key", "left")
           .join(cards, "competition_key", "left")
           .select("competition_key", "name", "type", "country_name", "confederation",
                   "total_games", "total_goals", "avg_goals_per_game", "avg_attendance",
                   "total_red_cards", "total_yellow_cards"))
    return (fill_numeric(out, 0)
            .withColumns({"avg_goals_per_game": F.round("avg_goals_per_game", 2),
                          "avg_attendance": F.round("avg_attendance", 0)})
            .transform(_order, ordered, F.desc("total_games")))


# ---------------------------------------------------------------- R08 top assists
@report(8, "compact")
def report08_compact(star: Star, k: int = 20) -> DataFrame:
    stats = _per_player(star, total_assists="assists")
    return top_k_late(stats, star.dim_player, "player_key", k, [F.desc("total_assists")], ["full_name", "total_assists"])


@report(8, "full")
def report08_full(star: Star, k: int = 20) -> DataFrame:
    stats = _per_player(star, total_assists="assists", total_goals="goals", total_games="games",
                        total_minutes="minutes_played").filter(F.col("total_assists") > 0)
    stats = stats.withColumn("assists_per_game", ratio("total_assists", "total_games", digits=2))
    return top_k_late(stats, star.dim_player, "player_key", k, [F.desc("total_assists")],
                      ["player_key", "full_name", "country_of_citizenship", "position", "current_club_name",
                       "total_assists", "total_goals", "total_games", "total_minutes", "assists_per_game"])


# ---------------------------------------------------------------- R09 home vs away
def _home():
    return F.col("hosting") == "Home"


def _away():
    return F.col("hosting") == "Away"


@report(9, "compact")
def report09_compact(star: Star) -> DataFrame:
    stats = star.fact_club_perf.groupBy("club_key").agg(
        count_where(_home() & F.col("won")).alias("home_wins"),
        count_where(_away() & F.col("won")).alias("away_wins"))
    return star.dim_club.join(stats, "club_key").select("name", "home_wins", "away_wins")


@report(9, "full")
def report09_full(star: Star, ordered: bool = True) -> DataFrame:
    won_int = F.col("won").cast("int")
    stats = star.fact_club_perf.groupBy("club_key").agg(
        sum_where(_home(), won_int).alias("home_wins"),
        count_where(_home()).alias("home_games"),
        sum_where(_away(), won_int).alias("away_wins"),
        count_where(_away()).alias("away_games"),
        sum_where(_home(), "own_goals").alias("home_goals_scored"),
        sum_where(_away(), "own_goals").alias("away_goals_scored"))
    return (star.dim_club.join(stats, "club_key")
            .withColumns({
                "home_win_pct": ratio("home_wins", "home_games", guard=True),
                "away_win_pct": ratio("away_wins", "away_games", guard=True)})
            .select("club_key", "name", "home_games", "home_wins", "home_win_pct",
                    "home_goals_scored", "away_games", "away_wins", "away_win_pct",
                    "away_goals_scored")
            .filter(F.col("home_games") + F.col("away_games") > 0)
            .transform(_order, ordered, F.desc("home_win_pct")))


# ---------------------------------------------------------------- R10 season trends
@report(10, "compact")
def report10_compact(star: Star, ordered: bool = True) -> DataFrame:
    return (star.fact_game.groupBy("season_year")
            .agg(F.sum("total_goals").alias("total_goals"),
                 F.avg("attendance").alias("avg_attendance"))
            .transform(_order, ordered, "season_year"))


@report(10, "full")
def report10_full(star: Star, ordered: bool = True) -> DataFrame:
    games = star.fact_game.groupBy("season_year").agg(
        F.count("game_key").alias("total_games"), F.sum("total_goals").alias("total_goals"),
        F.avg("total_goals").alias("avg_goals_per_game"),
        F.avg("attendance").alias("avg_attendance"))
    cards = totals_by(star, ["season_year"], total_yellows="yellow_cards", total_reds="red_cards")
    out = games.join(cards, "season_year", "left").select(
        "season_year", "total_games", "total_goals", "avg_goals_per_game", "avg_attendance",
        "total_yellows", "total_reds")
    # Filling every numeric column also turns a NULL season into 0, as the report does.
    return (fill_numeric(out, 0)
            .withColumns({"avg_goals_per_game": F.round("avg_goals_per_game", 2),
                          "avg_attendance": F.round("avg_attendance", 0)})
            .transform(_order, ordered, "season_year"))


# ---------------------------------------------------------------- R11 position analysis
@report(11, "compact")
def report11_compact(star: Star, ordered: bool = True) -> DataFrame:
    # Averages are per appearance row.  Summing and counting per player first
    # keeps the player join at one row per player; sum/count gives the same
    # value as avg over the raw rows.
    per = _per_player(star, g="goals", ng="n_goals", a="assists", na="n_assists")
    return (per.join(star.dim_player.select("player_key", "position"), "player_key")
            .groupBy("position")
            .agg((F.sum("g") / F.sum("ng")).alias("avg_goals_per_player"),
                 (F.sum("a") / F.sum("na")).alias("avg_assists_per_player"))
            .transform(_order, ordered, F.desc("avg_goals_per_player")))


@report(11, "full")
def report11_full(star: Star, ordered: bool = True) -> DataFrame:
    per = _per_player(star, g="goals", a="assists", y="yellow_cards", r="red_cards", n="games")
    # One row per player after the per-player aggregate, so counting keys is
    # the distinct player count.
    stats = (per.join(star.dim_player.select("player_key", "position"), "player_key")
             .groupBy("position")
             .agg(F.count("player_key").alias("total_players"), F.sum("g").alias("total_goals"),
                  F.sum("a").alias("total_assists"), F.sum("y").alias("total_yellows"),
                  F.sum("r").alias("total_reds"), F.sum("n").alias("total_appearances")))
    return (stats.withColumns({
        "goals_per_player": ratio("total_goals", "total_players", digits=2),
        "assists_per_player": ratio("total_assists", "total_players", digits=2)})
        .transform(_order, ordered, F.desc("total_goals")))


# ---------------------------------------------------------------- R12 top matches
def _few(top: DataFrame, k: int) -> DataFrame:
    """The k games, checkpointed (in the shared folder) while they are few, so that
    the fact is read once however often they are joined."""
    if k > MOST_BROADCAST:
        return top
    from ..session import ensure_checkpoint_dir

    ensure_checkpoint_dir(top.sparkSession)
    return top.checkpoint(eager=True)


def _needed(dim: DataFrame, key: str, top: DataFrame, k: int, *fact_keys: str) -> DataFrame:
    """Rows of ``dim`` (unique on ``key``) for the keys of the k games: at most
    2k, broadcast while k is at most ``MOST_BROADCAST``, else joined as Spark plans it."""
    keys = None
    for fk in fact_keys:
        part = top.select(F.col(fk).alias(key))
        keys = part if keys is None else keys.unionByName(part)
    if k > MOST_BROADCAST:
        return dim.join(keys.distinct(), key, "left_semi")
    return F.broadcast(dim.join(F.broadcast(keys), key, "left_semi"))


@report(12, "compact")
def report12_compact(star: Star, k: int = 50) -> DataFrame:
    # Games whose clubs both exist (key-only joins), the k first of them, and names for those only.
    keys = star.dim_club.select("club_key")
    games = star.fact_game.select("game_key", "home_club_key", "away_club_key", "attendance",
                                  "total_goals", "date_key")
    for side in ("home_club_key", "away_club_key"):
        games = spread_join(games, keys.withColumnRenamed("club_key", side), side, "left_semi")
    top = _few(top_k(games, k, [F.desc("attendance")], tie=["game_key"]), k)
    names = _needed(star.dim_club.select("club_key", "name"), "club_key", top, k, "home_club_key", "away_club_key")
    home = names.select(F.col("club_key").alias("home_club_key"), F.col("name").alias("home_name"))
    away = names.select(F.col("club_key").alias("away_club_key"), F.col("name").alias("away_name"))
    out = top.join(home, "home_club_key").join(away, "away_club_key")
    return (out.orderBy(F.desc("attendance"), F.asc("game_key"))
            .select("home_name", "away_name", "attendance", "total_goals", "date_key"))


@report(12, "full")
def report12_full(star: Star, k: int = 20) -> DataFrame:
    """Top k attended games with club, competition and date attributes.

    Every dimension is unique on its key and joined LEFT, so each game keeps
    exactly one row with unchanged attendance: the k games are chosen first, and
    each dimension is cut to the keys of those games.
    """
    top = _few(top_k(star.fact_game.filter(F.col("attendance").isNotNull()), k,
                     [F.desc("attendance")], tie=["game_key"]), k)
    clubs = _needed(star.dim_club.select("club_key", "name"), "club_key", top, k,
                    "home_club_key", "away_club_key")
    home = clubs.select(F.col("club_key").alias("home_club_key"),
                        F.col("name").alias("home_club_name"))
    away = clubs.select(F.col("club_key").alias("away_club_key"),
                        F.col("name").alias("away_club_name"))
    comp = _needed(star.dim_competition.select("competition_key",
                                               F.col("name").alias("competition_name")),
                   "competition_key", top, k, "competition_key")
    dates = _needed(star.dim_date.select("date_key", "date"), "date_key", top, k, "date_key")
    out = (top.join(home, "home_club_key", "left").join(away, "away_club_key", "left")
           .join(comp, "competition_key", "left").join(dates, "date_key", "left")
           .select("game_key", "home_club_name", "away_club_name", "home_club_goals",
                   "away_club_goals", "attendance", "competition_name", "date")
           .withColumn("match_result", F.concat(F.col("home_club_goals").cast("string"),
                                                F.lit("-"),
                                                F.col("away_club_goals").cast("string"))))
    return out.orderBy(F.desc("attendance"), F.asc("game_key"))


# ---------------------------------------------------------------- R13 nationality
@report(13, "compact")
def report13_compact(star: Star, ordered: bool = True) -> DataFrame:
    return (star.dim_player.groupBy("country_of_citizenship")
            .agg(F.count("*").alias("player_count"))
            .transform(_order, ordered, F.desc("player_count")))


@report(13, "full")
def report13_full(star: Star, ordered: bool = True) -> DataFrame:
    per = _per_player(star, g="goals", a="assists", n="games")
    players = star.dim_player.select("player_key", "country_of_citizenship")
    stats = (players.join(per, "player_key", "left")
             .groupBy("country_of_citizenship")
             .agg(F.count("player_key").alias("total_players"), F.sum("g").alias("total_goals"),
                  F.sum("a").alias("total_assists"), F.sum("n").alias("total_appearances")))
    return (fill_numeric(stats, 0)
            .select("country_of_citizenship", "total_players", "total_goals", "total_assists",
                    "total_appearances")
            .withColumn("goals_per_player", ratio("total_goals", "total_players", digits=2))
            .transform(_order, ordered, F.desc("total_players")))


# ---------------------------------------------------------------- R14 monthly trends
@report(14, "compact")
def report14_compact(star: Star, ordered: bool = True) -> DataFrame:
    # Per day first: the calendar join sees one row per day.
    days = star.fact_game.groupBy("date_key").agg(F.sum("total_goals").alias("g"))
    return (days.join(star.dim_date.select("date_key", "month_name", "month"), "date_key")
            .groupBy("month_name", "month").agg(F.sum("g").alias("goals"))
            .transform(_order, ordered, "month"))


@report(14, "full")
def report14_full(star: Star, ordered: bool = True) -> DataFrame:
    days = star.fact_game.groupBy("date_key").agg(
        F.count("game_key").alias("n"), F.sum("total_goals").alias("g"), F.count("total_goals").alias("ng"),
        F.sum("attendance").alias("a"), F.count("attendance").alias("na"))
    stats = (days.join(star.dim_date.select("date_key", "month", "month_name"), "date_key")
             .groupBy("month", "month_name")
             .agg(F.sum("n").alias("total_games"), F.sum("g").alias("total_goals"),
                  F.try_divide(F.sum("g"), F.sum("ng")).alias("avg_goals_per_game"),
                  F.try_divide(F.sum("a"), F.sum("na")).alias("avg_attendance")))
    return (stats.withColumns({"avg_goals_per_game": F.round("avg_goals_per_game", 2),
                               "avg_attendance": F.round("avg_attendance", 0)})
            .transform(_order, ordered, "month"))


# ---------------------------------------------------------------- R15 squad analysis
@report(15, "compact")
def report15_compact(star: Star, ordered: bool = True) -> DataFrame:
    return (star.dim_club.select("name", "squad_size", "foreigners_number", "average_age")
            .transform(_order, ordered, F.desc("squad_size")))


@report(15, "full")
def report15_full(star: Star, ordered: bool = True) -> DataFrame:
    perf = (star.fact_club_perf.groupBy("club_key")
            .agg(count_where(F.col("won")).alias("total_wins"), F.count("*").alias("total_matches"))
            .withColumn("win_rate", ratio("total_wins", "total_matches", scale=100, digits=2)))
    out = star.dim_club.join(perf, "club_key", "left").select(
        "club_key", "name", "squad_size", "average_age", "foreigners_number",
        "foreigners_percentage", "national_team_players", "total_wins", "total_matches",
        "win_rate")
    out = fill_defaults(out, {"total_wins": 0, "total_matches": 0, "win_rate": 0})
    return (out.filter(F.col("squad_size") > 0)
            .transform(_order, ordered, F.desc("foreigners_percentage")))


def takes_order(name: str) -> bool:
    """Whether the report has an ``ordered`` switch (reports without a limit)."""
    import inspect

    return "ordered" in inspect.signature(REPORTS[name]).parameters


def report_names(edition: str | None = None) -> list[str]:
    return sorted(n for n in REPORTS if edition is None or n.endswith(edition))

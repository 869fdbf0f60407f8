"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query builds its plan from the driver tables (through the adapter), so
its work grows with them.  Reports are full lineage plans (raw -> conformed ->
star -> report); the ``jobs`` module is the materialising path.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import (NULL_TOKENS, NULL_TOKENS_STRICT, conform_dates, dedupe, dedupe_sparse,
                               fill_defaults, normalize_nulls)
from ..operators.combine import merge_join
from ..session import remove_scratch, run_concurrently, scratch_path
from ..sources import adapter
from ..sources.io import (NULL_MARK, CsvDialect, LayerPaths, csv_quarantine, csv_rejects, ingest_all, read_csv,
                          read_table, write_csv, write_table)
from ..sources.schemas import SCHEMAS, SOURCE_TABLES, SPECS
from . import bucketed, jobs, quality, statistics
from . import reports as R
from .edition import Edition, compact, full
from .silver import COMPACT_TABLES, FULL_TABLES, conform_all, conform_table
from .star import DIM_TABLES, FACT_TABLES, Star, build_star
from .totals import merge_totals, player_totals

Query = Callable[[SparkSession, str], DataFrame]

# Fixed value: the driver's orders span 1995-2001, so the season report asks for 1998.
SEASON = 1998
REPORT_PARAMS = {"report03_compact": {"season": SEASON}, "report03_full": {"season": SEASON}}


class Layers:
    """Lazy raw / conformed / star plans over one driver folder (each table is
    built on first access, so a query only analyses what it reads)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.raw = adapter.raw_tables(spark, sf_dir)
        self._silver: dict[str, object] = {}

    def silver(self, ed: Edition):
        if ed.name not in self._silver:
            self._silver[ed.name] = conform_all(self.raw, ed)
        return self._silver[ed.name]

    def star(self, ed: Edition) -> Star:
        return build_star(self.silver(ed), self.raw, ed)


QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


# ---------------------------------------------------------------- sources / sinks
@register("parquet_scan")
def parquet_scan(spark, sf):
    return adapter.appearances(spark, sf)


@register("parquet_roundtrip")
def parquet_roundtrip(spark, sf):
    path = scratch_path(spark, "games-parquet")
    write_table(adapter.games(spark, sf), path)
    return read_table(spark, path)


@register("csv_roundtrip")
def csv_roundtrip(spark, sf):
    path = scratch_path(spark, "players-csv")
    write_csv(adapter.players(spark, sf), path)
    return read_csv(spark, path, SCHEMAS["players"], null_value=NULL_MARK)


@register("ingest_status")
def ingest_status(spark, sf):
    """Raw CSVs of all tables, and one name without a file -> bronze."""
    paths = LayerPaths(scratch_path(spark, "ingest"))
    run_concurrently(spark, [lambda t=t: write_csv(adapter.BUILDERS[t](spark, sf), paths.raw(t))
                             for t in SOURCE_TABLES])
    status = ingest_all(spark, paths, [*SOURCE_TABLES, "transfers"], null_value=NULL_MARK)  # rows on the driver, one per table
    remove_scratch(spark, paths.base)
    return status


@register("csv_ingest_rejects")
def csv_ingest_rejects(spark, sf):
    """Appearances exported with decimals in a whole-number column, text in others, a
    header in another case, a column nobody declared and one column missing."""
    raw = adapter.appearances(spark, sf).drop("red_cards")
    odd = raw.withColumnsRenamed({"game_id": "Game_ID"}).withColumns({
        "goals": F.concat(F.col("goals").cast("string"), F.lit(".0")),
        "assists": F.when(F.col("player_club_id") % 7 == 0, "n/a").otherwise(F.col("assists").cast("string")),
        "minutes_played": F.when(F.col("player_club_id") % 11 == 0, "90.5").otherwise(F.col("minutes_played").cast("string")),
        "note": F.lit("late")})
    path = scratch_path(spark, "appearances-csv")
    write_csv(odd, path)
    return csv_rejects(spark, path, SCHEMAS["appearances"], NULL_MARK)


@register("ingest_rejects")
def ingest_rejects(spark, sf):
    """What bronze could not take of an appearances file with text in number columns and with records of one field
    too many: every cell and record, with the row's key."""
    raw = adapter.appearances(spark, sf).drop("red_cards")
    odd = raw.withColumns({
        "assists": F.when(F.col("player_club_id") % 7 == 0, "n/a").otherwise(F.col("assists").cast("string")),
        "minutes_played": F.when(F.col("player_club_id") % 11 == 0, "90.5").otherwise(F.col("minutes_played").cast("string")),
        "note": F.when(F.col("player_club_id") % 13 == 0, "late,again").otherwise("late")})
    path = scratch_path(spark, "rejects-csv")
    write_csv(odd, path, quote_all=False, dialect=CsvDialect(quote="'"))  # to a reader of plain CSV, nothing is quoted
    found = csv_quarantine(spark, path, SCHEMAS["appearances"], NULL_MARK)
    return found.select("reason", "column_name", "cell", F.get_json_object("record", "$.appearance_id").alias("appearance_id"),
                        F.col("source_file").contains("rejects-csv").alias("has_source"))


@register("csv_dialect_roundtrip")
def csv_dialect_roundtrip(spark, sf):
    """Clubs whose names hold quotes, separators, line breaks and accents, through a file with
    semicolons, doubled quotes and a one-byte encoding."""
    clubs = adapter.clubs(spark, sf).withColumns({
        "stadium_name": F.concat(F.col("stadium_name"), F.lit(' "The Ground"; Gate 1,\nÉtage 2 ')),
        "coach_name": F.when(F.col("club_id") % 5 == 0, "").when(F.col("club_id") % 5 == 1, '"').otherwise(F.col("coach_name"))})
    dialect = CsvDialect(delimiter=";", escape='"', encoding="ISO-8859-1", multi_line=True)
    path = scratch_path(spark, "clubs-csv")
    write_csv(clubs, path, dialect=dialect)
    return read_csv(spark, path, SCHEMAS["clubs"], null_value=NULL_MARK, dialect=dialect)


@register("layer_row_counts")
def layer_row_counts(spark, sf):
    """Rows of every table of the three layers: counts of keys only, nothing is written."""
    layers = Layers(spark, sf)
    ed = compact()
    return quality.layer_row_counts({
        "raw": {t: layers.raw[t] for t in SOURCE_TABLES},
        "silver": {t: layers.silver(ed)[t] for t in COMPACT_TABLES},
        "gold": layers.star(ed).tables()})


@register("written_row_counts")
def written_row_counts(spark, sf):
    """The raw tables written, the facts' season partitions among them, and counted from their files' footers."""
    paths = LayerPaths(scratch_path(spark, "counted"))
    raw = adapter.raw_tables(spark, sf)
    run_concurrently(spark, [lambda t=t: write_table(raw[t], paths.bronze(t), partition_by=["hosting"] if t == "club_games" else None)
                             for t in SOURCE_TABLES])
    counts = quality.written_row_counts(spark, {"bronze": {t: paths.bronze(t) for t in SOURCE_TABLES}})
    remove_scratch(spark, paths.base)
    return counts


# ---------------------------------------------------------------- operators
@register("normalize_nulls")
def q_normalize_nulls(spark, sf):
    return normalize_nulls(adapter.players(spark, sf), NULL_TOKENS)


@register("normalize_nulls_strict")
def q_normalize_nulls_strict(spark, sf):
    return normalize_nulls(adapter.players(spark, sf), NULL_TOKENS_STRICT)


@register("dedupe_single")
def q_dedupe_single(spark, sf):
    return dedupe(spark.read.parquet(f"{sf.rstrip('/')}/lineitem.parquet"), ["l_orderkey"])


@register("dedupe_composite")
def q_dedupe_composite(spark, sf):
    return dedupe(adapter.club_games(spark, sf), ["game_id", "club_id"])


@register("dedupe_sparse_single")
def q_dedupe_sparse_single(spark, sf):
    return dedupe_sparse(adapter.games(spark, sf).unionByName(adapter.games(spark, sf).filter("game_id % 3 = 0")
                         .withColumns({"attendance": F.lit(None).cast("int"), "game_id": F.expr("nullif(game_id, 3)")})), ["game_id"])


@register("dedupe_sparse_composite")
def q_dedupe_sparse_composite(spark, sf):
    return dedupe_sparse(adapter.club_games(spark, sf), ["game_id", "club_id"])


@register("fill_defaults")
def q_fill_defaults(spark, sf):
    clubs = normalize_nulls(adapter.clubs(spark, sf), NULL_TOKENS)
    return fill_defaults(clubs, SPECS["clubs"].defaults)


@register("conform_dates")
def q_conform_dates(spark, sf):
    return conform_dates(adapter.appearances(spark, sf), ["date"])


def _merge(how: str) -> Query:
    def q(spark, sf):
        ed = compact()
        raw = adapter.raw_tables(spark, sf)
        apps = conform_table(raw["appearances"], SPECS["appearances"], ed)
        games = conform_table(raw["games"], SPECS["games"], ed)
        return merge_join(apps, games, "game_id", how)
    return q


for _how in ("inner", "left", "right", "full"):
    register(f"merge_join_{_how}")(_merge(_how))


@register("player_age")
def q_player_age(spark, sf):
    return Layers(spark, sf).silver(full())["players"].select("player_id", "date_of_birth", "age")


@register("ingestion_stamp")
def q_ingestion_stamp(spark, sf):
    return Layers(spark, sf).silver(full())["clubs"].select("club_id", "name",
                                                             "ingestion_timestamp")


# ---------------------------------------------------------------- conformed tables
def _silver(table: str) -> Query:
    def q(spark, sf):
        ed = compact()
        return conform_table(adapter.BUILDERS[table](spark, sf), SPECS[table], ed)
    return q


for _t in SOURCE_TABLES:
    register("silver_valuations" if _t == "player_valuations" else f"silver_{_t}")(_silver(_t))


def _silver_full(table: str) -> Query:
    return lambda spark, sf: Layers(spark, sf).silver(full())[table]


for _t in FULL_TABLES:
    register(f"silver_{_t}_full")(_silver_full(_t))


# ---------------------------------------------------------------- star tables
def _star_table(table: str, ed_factory) -> Query:
    def q(spark, sf):
        return getattr(Layers(spark, sf).star(ed_factory()), table)
    return q


for _t in DIM_TABLES + FACT_TABLES:
    register(_t)(_star_table(_t, compact))
    register(f"{_t}_full")(_star_table(_t, full))


# ---------------------------------------------------------------- per-player totals
def _totals(ed_factory) -> Query:
    return lambda spark, sf: player_totals(Layers(spark, sf).star(ed_factory()).fact_appearance)


register("player_totals")(_totals(compact))
register("player_totals_full")(_totals(full))


@register("fact_appearance_bucketed")
def fact_appearance_bucketed(spark, sf):
    """FT1 from tables clustered by game, itself clustered by player."""
    return bucketed.appearance_fact(Layers(spark, sf).silver(compact()), scratch_path(spark, "buckets"), compact(), 16)


@register("player_totals_bucketed")
def player_totals_bucketed(spark, sf):
    return bucketed.totals(fact_appearance_bucketed(spark, sf))


@register("games_star_by_stats")
def games_star_by_stats(spark, sf):
    """Games with competition, date and home club, joined in the order and by the strategy of measured sizes."""
    star = Layers(spark, sf).star(compact())
    games = star.fact_game.select("game_key", "competition_key", "home_club_key", "date_key", "total_goals")
    dims = [("competition_key", star.dim_competition.select("competition_key", F.col("name").alias("competition")), "inner"),
            ("home_club_key", star.dim_club.select(F.col("club_key").alias("home_club_key"), F.col("name").alias("home_club")), "inner"),
            ("date_key", star.dim_date.select("date_key", "month_name"), "left")]
    measured = statistics.measure(games, [k for k, *_ in dims])
    return statistics.star_join(games, measured, [
        statistics.Dimension(df, key, statistics.measure(df, [key]), how) for key, df, how in dims])


@register("report11_from_totals")
def report11_from_totals(spark, sf):
    """R11 full from written totals, without the fact: those of even and of odd competitions, merged."""
    star = Layers(spark, sf).star(full())
    totals = player_totals(star.fact_appearance)
    even = F.coalesce(F.col("competition_key").try_cast("int") % 2 == 0, F.lit(False))
    path = scratch_path(spark, "totals")
    write_table(merge_totals(totals.filter(even), totals.filter(~even)), path)

    def unread():
        raise AssertionError("the report reads the fact")

    tables = {t: (lambda t=t: getattr(star, t)) for t in DIM_TABLES + FACT_TABLES} | {
        "fact_appearance": unread, "player_totals": lambda: read_table(spark, path)}
    return R.REPORTS["report11_full"](Star(**tables))


# ---------------------------------------------------------------- reports
def _report(name: str) -> Query:
    ed_factory = compact if name.endswith("_compact") else full

    def q(spark, sf):
        return R.REPORTS[name](Layers(spark, sf).star(ed_factory()), **REPORT_PARAMS.get(name, {}))
    return q


for _name in R.report_names():
    register(_name)(_report(_name))


# ---------------------------------------------------------------- quality
@register("quality_metrics")
def q_quality_metrics(spark, sf):
    return quality.quality_metrics(Layers(spark, sf).star(full()))


@register("conform_quality")
def q_conform_quality(spark, sf):
    return quality.conform_quality(adapter.raw_tables(spark, sf), compact())


@register("conform_quality_full")
def q_conform_quality_full(spark, sf):
    return quality.conform_quality(adapter.raw_tables(spark, sf), full())


@register("conform_rejects")
def q_conform_rejects(spark, sf):
    return quality.conform_rejects(adapter.raw_tables(spark, sf), compact()).drop("record")


@register("conform_rejects_full")
def q_conform_rejects_full(spark, sf):
    return quality.conform_rejects(adapter.raw_tables(spark, sf), full()).drop("record")


@register("report_status")
def q_report_status(spark, sf):
    """The jobs from bronze on, full edition: conform, model, reports; then which reports exist."""
    paths = LayerPaths(scratch_path(spark, "reports")).for_edition("full")
    ed = full()
    raw = adapter.raw_tables(spark, sf)
    run_concurrently(spark, [lambda t=t: write_table(raw[t], paths.bronze(t)) for t in (*FULL_TABLES, "club_games")])
    jobs.run_conform(spark, paths, ed)
    jobs.run_model(spark, paths, ed)
    names = R.report_names("full")
    jobs.run_reports(spark, paths, ed, names, REPORT_PARAMS)
    status = jobs.report_status(spark, paths, names)  # rows on the driver, one per report
    remove_scratch(spark, paths.base)
    return status


@register("report_csv_export")
def q_report_csv_export(spark, sf):
    """A report exported as headed, quoted CSV and read back."""
    report = R.REPORTS["report05_compact"](Layers(spark, sf).star(compact()))
    path = scratch_path(spark, "report-csv")
    write_csv(report, path)
    return read_csv(spark, path, report.schema, null_value=NULL_MARK)

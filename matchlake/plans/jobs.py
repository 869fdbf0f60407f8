"""Batch jobs: ingest -> conform -> model -> reports -> quality, each writing its layer once.

Every job reads the previous layer back from storage, so lineage is cut at
each layer boundary and a lost executor only recomputes work of the current
job.  Outputs are full overwrites through Spark's commit protocol, so a job can
simply be re-run.  Jobs return small status DataFrames (one row per table or
report); no data passes through the driver.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import run_concurrently
from ..sources.io import (STATUS_SCHEMA, CsvDialect, LayerPaths, check_format, error_text, ingest_all, path_exists,
                          read_table, remove_path, table_exists, write_counted, write_csv)
from ..sources.schemas import SOURCE_TABLES
from . import reports as R
from .edition import Edition
from .silver import COMPACT_TABLES, FULL_TABLES, conform_all
from .star import DIM_TABLES, FACT_TABLES, LazyTables, Star, build_star
from .totals import player_totals, totals_per_player

# Independent writes of one layer are submitted concurrently (driver threads only
# submit jobs; the work runs on executors), so small tables do not leave the
# cluster idle between jobs.
DEFAULT_PARALLEL_WRITES = 4


def _parallel(spark: SparkSession, tasks: list[Callable[[], tuple]],
              parallel: int) -> list[tuple]:
    return run_concurrently(spark, tasks, parallel)


# Facts are partitioned by season so season-filtered reports prune whole folders.
FACT_PARTITIONS = {"fact_appearance": ["season_year"], "fact_game": ["season_year"]}
TOTALS = "player_totals"
PER_PLAYER = "player_totals_per_player"

REPORT_STATUS_SCHEMA = T.StructType([
    T.StructField("report", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("error", T.StringType()),
])


def run_ingest(spark: SparkSession, paths: LayerPaths,
               tables: Iterable[str] = SOURCE_TABLES, null_value: str | None = None,
               dialects: Mapping[str, CsvDialect] | None = None, quarantine: bool = False) -> DataFrame:
    return ingest_all(spark, paths, tables, null_value=null_value, dialects=dialects, quarantine=quarantine)


def _write_all(spark: SparkSession, frames: Mapping[str, DataFrame], where,
               paths: LayerPaths, partitions: dict | None = None,
               parallel: int = DEFAULT_PARALLEL_WRITES, rebalance: bool = True) -> DataFrame:
    """Write each table; one that cannot be built or written is a status row, and
    the others go on.  ``frames`` may build its tables on access; ``rebalance``: see ``write_counted``."""
    def task(name: str):
        def run():
            try:
                rows = write_counted(frames[name], where(name), paths.fmt, (partitions or {}).get(name), paths.versioned,
                                     rebalance)
                return (name, "ok", rows, None)
            except Exception as e:  # noqa: BLE001 -- per-table isolation
                return (name, "failed", None, error_text(e))
        return run

    rows = _parallel(spark, [task(n) for n in frames], parallel)
    return spark.createDataFrame(rows, STATUS_SCHEMA)


def _tables(ed: Edition) -> tuple[str, ...]:
    return COMPACT_TABLES if ed.name == "compact" else FULL_TABLES


def _lazy(spark: SparkSession, tables: Iterable[str], where, fmt: str) -> LazyTables:
    return LazyTables({t: (lambda t=t: read_table(spark, where(t), fmt)) for t in tables})


def run_conform(spark: SparkSession, paths: LayerPaths, ed: Edition) -> DataFrame:
    bronze = _lazy(spark, _tables(ed), paths.bronze, paths.fmt)
    return _write_all(spark, conform_all(bronze, ed, stored=True), paths.silver, paths)


def run_quarantine(spark: SparkSession, paths: LayerPaths, ed: Edition) -> DataFrame:
    """Write the rows that conforming left out and the texts it could not read, with reasons, from bronze."""
    from . import quality

    bronze = _lazy(spark, _tables(ed), paths.bronze, paths.fmt)
    rejects = LazyTables({"conform_rejects": lambda: quality.conform_rejects(bronze, ed)})
    return _write_all(spark, rejects, paths.conform_rejects, paths, {"conform_rejects": ["table_name"]})


def run_model(spark: SparkSession, paths: LayerPaths, ed: Edition) -> DataFrame:
    silver = _lazy(spark, _tables(ed), paths.silver, paths.fmt)
    raw = _lazy(spark, ["club_games"], paths.bronze, paths.fmt)
    return write_star(spark, build_star(silver, raw, ed), paths)


def write_star(spark: SparkSession, star: Star, paths: LayerPaths) -> DataFrame:
    """Write the four dimensions and three facts (facts partitioned by season), then the totals per player, season
    and competition from the written fact, and from these the totals per player.

    Facts and totals have few seasons, so they are written by the tasks that join or add them up (a file per task
    and season) and not shuffled once more for larger files: that shuffle would move every wide row again.

    A partitioned table is read back with its partition columns last and their types
    guessed from folder names, so its schema is written beside it.  Totals of an earlier run go first: a run
    that ends between the fact and its totals leaves none, and reports then read the fact."""
    for old in (PER_PLAYER, TOTALS, f"_schema_of_{TOTALS}"):
        remove_path(spark, paths.totals(old))
    dims = LazyTables({t: (lambda t=t: getattr(star, t)) for t in DIM_TABLES})
    facts = LazyTables({t: (lambda t=t: getattr(star, t)) for t in FACT_TABLES})
    status = _write_all(spark, dims, paths.dim, paths).unionByName(
        _write_all(spark, facts, paths.fact, paths, FACT_PARTITIONS, rebalance=False))
    failed = {r["table_name"] for r in status.filter("status = 'failed'").collect()}
    for t in FACT_PARTITIONS:
        if t not in failed:
            _write_schema(spark, facts[t], paths.fact, t)
    if "fact_appearance" in failed:
        return status
    totals = LazyTables({TOTALS: lambda: player_totals(_read_fact(spark, paths, "fact_appearance"))})
    _write_schema(spark, totals[TOTALS], paths.totals, TOTALS)
    summed = _write_all(spark, totals, paths.totals, paths, {TOTALS: ["season_year"]}, rebalance=False)
    status = status.unionByName(summed)
    if summed.first()["status"] == "failed":
        return status
    per_player = LazyTables({PER_PLAYER: lambda: totals_per_player(
        _read_partitioned(spark, paths.fmt, paths.totals, TOTALS))})
    return status.unionByName(_write_all(spark, per_player, paths.totals, paths))


def _write_schema(spark: SparkSession, df: DataFrame, where, t: str) -> None:
    spark.createDataFrame([(df.schema.json(),)], "schema string").coalesce(1).write.mode(
        "overwrite").text(where(f"_schema_of_{t}"))


def _read_partitioned(spark: SparkSession, fmt: str, where, t: str) -> DataFrame:
    """A partitioned table with the columns and types of its schema."""
    if not path_exists(spark, where(f"_schema_of_{t}")):
        return read_table(spark, where(t), fmt)
    schema = T.StructType.fromJson(json.loads(spark.read.text(where(f"_schema_of_{t}")).first()[0]))
    return read_table(spark, where(t), fmt, schema).select(*schema.names)


def _read_fact(spark: SparkSession, paths: LayerPaths, t: str) -> DataFrame:
    if t in FACT_PARTITIONS:
        return _read_partitioned(spark, paths.fmt, paths.fact, t)
    return read_table(spark, paths.fact(t), paths.fmt)


def read_star(spark: SparkSession, paths: LayerPaths) -> Star:
    tables = {t: read_table(spark, paths.dim(t), paths.fmt) for t in DIM_TABLES}
    tables.update({t: _read_fact(spark, paths, t) for t in FACT_TABLES})
    if table_exists(spark, paths.totals(TOTALS)):
        tables[TOTALS] = _read_partitioned(spark, paths.fmt, paths.totals, TOTALS)
        if table_exists(spark, paths.totals(PER_PLAYER)):
            tables[PER_PLAYER] = read_table(spark, paths.totals(PER_PLAYER), paths.fmt)
    return Star(**tables)


def run_reports(spark: SparkSession, paths: LayerPaths, ed: Edition,
                names: Iterable[str] | None = None,
                params: dict[str, dict] | None = None,
                parallel: int = DEFAULT_PARALLEL_WRITES,
                ordered: bool = True, csv: bool = False) -> DataFrame:
    """Write each report of the edition; a failing report is a status row, not a crash.

    ``ordered=False`` writes reports without their final global sort (their
    readers sort); top-k reports keep their order, which defines the cut.  ``csv``
    also exports each report as headed, quoted CSV, from the written table.
    """
    star = read_star(spark, paths)
    plans = {}
    rows = []
    for name in names or R.report_names(ed.name):
        try:
            kwargs = dict((params or {}).get(name, {}))
            if not ordered and name in R.REPORTS and R.takes_order(name):
                kwargs["ordered"] = False
            plans[name] = R.REPORTS[name](star, **kwargs)
        except Exception as e:  # noqa: BLE001 -- per-report isolation
            rows.append((name, "failed", None, error_text(e)))

    def task(name: str, df: DataFrame):
        def run():
            try:
                n = write_counted(df, paths.report(name), paths.fmt, versioned=paths.versioned)
                if csv:
                    write_csv(_flat(read_table(spark, paths.report(name), paths.fmt)), paths.report_csv(name))
                return (name, "ok", n, None)
            except Exception as e:  # noqa: BLE001
                return (name, "failed", None, error_text(e))
        return run

    rows += _parallel(spark, [task(n, df) for n, df in plans.items()], parallel)
    return spark.createDataFrame(rows, REPORT_STATUS_SCHEMA)


def _flat(df: DataFrame) -> DataFrame:
    """Lists as one text, for CSV."""
    return df.select(*[F.concat_ws("; ", c).alias(c) if t.startswith("array") else F.col(c) for c, t in df.dtypes])


def report_status(spark: SparkSession, paths: LayerPaths,
                  names: Iterable[str]) -> DataFrame:
    """Which reports exist (``present`` with their row count, ``missing``), and which
    exist but cannot be read (``failed`` with the error)."""
    def check(name: str):
        def run():
            try:
                if not table_exists(spark, paths.report(name)):
                    return (name, "missing", None, None)
                return (name, "present", read_table(spark, paths.report(name), paths.fmt).count(), None)
            except Exception as e:  # noqa: BLE001
                return (name, "failed", None, error_text(e))
        return run

    rows = _parallel(spark, [check(n) for n in names], DEFAULT_PARALLEL_WRITES)
    return spark.createDataFrame(rows, REPORT_STATUS_SCHEMA)


def run_quality(spark: SparkSession, paths: LayerPaths, ed: Edition) -> DataFrame:
    """Quality tables of one edition, computed from the written layers:
    ``layer_row_counts`` (bronze, silver, dimensions, facts), ``report_status``, ``report_summary``
    and ``quality_metrics``; each is written under ``gold/<edition>/quality``."""
    from . import quality

    layers = {
        "bronze": {t: paths.bronze(t) for t in SOURCE_TABLES if table_exists(spark, paths.bronze(t))},
        "silver": {t: paths.silver(t) for t in _tables(ed)},
        "gold": {t: paths.dim(t) for t in DIM_TABLES} | {t: paths.fact(t) for t in FACT_TABLES},
    }
    reports = report_status(spark, paths, R.report_names(ed.name))
    outputs = {
        "layer_row_counts": quality.written_row_counts(spark, layers, paths.fmt),
        "report_status": reports,
        "report_summary": quality.report_summary(reports),
        "quality_metrics": quality.quality_metrics(read_star(spark, paths)),
    }
    # A report that cannot be read is a failure of the stage, and so of the exit code.
    broken = reports.filter("status = 'failed'").withColumnRenamed("report", "table_name")
    return _write_all(spark, outputs, paths.quality, paths).unionByName(broken)


def run_all(spark: SparkSession, base: str, ed: Edition,
            params: dict[str, dict] | None = None, null_value: str | None = None,
            ordered: bool = True, fmt: str = "parquet", csv: bool = False,
            dialects: Mapping[str, CsvDialect] | None = None, quarantine: bool = False,
            versioned: bool = False) -> DataFrame:
    """Raw CSV under ``base/raw`` -> every layer of one edition.

    ``dialects``: of tables whose files differ from plain CSV; ``quarantine``: also keep what ingest and
    conform leave out; ``versioned``: publish each table at once when it is whole, so that readers, and a run that
    fails, never see half of one.

    Returns one status table: (stage, name, status, row_count, error) for
    every ingested table, conformed table, star table, report and quality
    table.
    """
    paths = LayerPaths(base, fmt, versioned=versioned)
    check_format(spark, paths.fmt)
    ep = paths.for_edition(ed.name)
    stages = [("ingest", run_ingest(spark, paths, null_value=null_value, dialects=dialects, quarantine=quarantine))]
    stages.append(("conform", run_conform(spark, ep, ed)))
    if quarantine:
        stages.append(("quarantine", run_quarantine(spark, ep, ed)))
    stages.append(("model", run_model(spark, ep, ed)))
    stages.append(("reports", run_reports(spark, ep, ed, params=params, ordered=ordered, csv=csv)
                   .withColumnRenamed("report", "table_name")))
    stages.append(("quality", run_quality(spark, ep, ed)))
    out = None
    for stage, df in stages:
        df = df.select(F.lit(stage).alias("stage"), F.col("table_name").alias("name"),
                       "status", "row_count", "error")
        out = df if out is None else out.unionByName(df)
    return out

"""Tables that are published version by version."""

import glob
import os
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from matchlake.plans import jobs
from matchlake.plans import reports as R
from matchlake.plans.edition import compact
from matchlake.plans.registry import REPORT_PARAMS
from matchlake.sources import adapter
from matchlake.sources.io import (KEPT_VERSIONS, NULL_MARK, LayerPaths, current_path, footer_counts, published, read_table,
                                  table_exists, write_counted, write_csv, write_table)
from matchlake.sources.schemas import SOURCE_TABLES


@pytest.fixture
def path():
    return tempfile.mkdtemp(prefix="matchlake-versions-") + "/t"


def ids(df):
    return sorted(r.id for r in df.collect())


def failing(spark, n):
    """Rows of which the last task fails, after others have written theirs."""
    return spark.range(n, numPartitions=4).select(F.when(F.col("id") == n - 1, F.raise_error(F.lit("lost"))).otherwise(F.col("id"))
                                                  .cast("long").alias("id"))


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_a_failed_write_leaves_the_old_rows(spark, path, fmt):
    write_table(spark.range(5), path, fmt, versioned=True)
    with pytest.raises(Exception, match="lost"):
        write_table(failing(spark, 100), path, fmt, versioned=True)
    assert ids(read_table(spark, path, fmt)) == [0, 1, 2, 3, 4] and len(published(spark, path)) == 1
    time.sleep(1)                                  # tasks that were under way
    write_table(spark.range(7), path, fmt, versioned=True)
    assert ids(read_table(spark, path, fmt)) == list(range(7))
    folders = [n for n in os.listdir(path) if n.startswith("v")]
    assert len(folders) == 2                       # what the failed writer left is gone


def test_the_first_write_failing_leaves_no_table(spark, path):
    assert not table_exists(spark, path)
    with pytest.raises(Exception, match="lost"):
        write_table(failing(spark, 100), path, versioned=True)
    assert not table_exists(spark, path)
    write_table(spark.range(3), path, versioned=True)
    assert table_exists(spark, path)


def test_a_reader_ends_with_the_version_it_began_with(spark, path):
    write_table(spark.range(5), path, versioned=True)
    begun = read_table(spark, path)
    write_table(spark.range(50), path, versioned=True)
    assert ids(begun) == list(range(5)) and ids(read_table(spark, path)) == list(range(50))
    # A table can be rewritten from itself.
    write_table(read_table(spark, path).filter("id < 9"), path, versioned=True)
    assert ids(read_table(spark, path)) == list(range(9))


def test_old_versions_go(spark, path):
    for n in range(1, 6):
        assert write_counted(spark.range(n), path, versioned=True) == n
        assert len(published(spark, path)) == min(n, KEPT_VERSIONS)
        assert current_path(spark, path).split("/")[-1].startswith(f"v{n:08d}-")
        assert footer_counts(spark, {"t": path}) == {"t": n}
    assert len(glob.glob(f"{path}/v*")) == len(glob.glob(f"{path}/_published-*")) == KEPT_VERSIONS


def test_partitioned_versions_and_plain_tables(spark, path):
    df = spark.range(20).withColumn("p", F.col("id") % 3)
    write_table(df, path, partition_by=["p"], versioned=True)
    assert read_table(spark, path).filter("p = 1").count() == 7 and glob.glob(f"{path}/v*/p=1")
    plain = path + "-plain"
    write_table(df, plain)
    assert current_path(spark, plain) == plain and table_exists(spark, plain) and published(spark, plain) == []
    write_table(spark.range(4), plain, versioned=True)      # from then on it has versions
    assert ids(read_table(spark, plain)) == [0, 1, 2, 3]


def test_jobs_publish_and_survive_a_failing_rerun(spark, sf_small):
    base = tempfile.mkdtemp(prefix="matchlake-versioned-")
    for t in SOURCE_TABLES:
        write_csv(adapter.BUILDERS[t](spark, sf_small), LayerPaths(base).raw(t))
    status = jobs.run_all(spark, base, compact(), params=REPORT_PARAMS, null_value=NULL_MARK, versioned=True, quarantine=True)
    assert {r.status for r in status.collect()} == {"ok"}
    ep = LayerPaths(base, versioned=True).for_edition("compact")
    before = {n: sorted(map(repr, read_table(spark, ep.report(n)).collect())) for n in R.report_names("compact")}
    assert len(published(spark, ep.fact("fact_game"))) == 1

    # The fact's source breaks: its status is a failure, and every reader still has the rows of before.
    star = jobs.read_star(spark, ep)
    broken = {t: (lambda t=t: getattr(star, t)) for t in star.TABLES} | {
        "fact_game": lambda: star.fact_game.withColumn("round", F.raise_error(F.lit("lost")).cast("string"))}
    rows = {r.table_name: r.status for r in jobs.write_star(spark, type(star)(**broken), ep).collect()}
    assert rows["fact_game"] == "failed" and rows["dim_club"] == "ok"
    again = jobs.run_reports(spark, ep, compact(), params=REPORT_PARAMS).collect()
    assert {r.status for r in again} == {"ok"}
    assert {n: sorted(map(repr, read_table(spark, ep.report(n)).collect())) for n in before} == before
    assert len(published(spark, ep.fact("fact_game"))) == 1 and len(published(spark, ep.dim("dim_club"))) == 2


def test_command_line_settings(spark, sf_small, capsys):
    from matchlake.__main__ import _dialects, main

    base = tempfile.mkdtemp(prefix="matchlake-cli-")
    paths = LayerPaths(base)
    from matchlake.sources.io import CsvDialect

    write_csv(adapter.clubs(spark, sf_small), paths.raw("clubs"), dialect=CsvDialect(delimiter=";"))
    args = ["--base", base, "--null-marker", "--dialect", "clubs.delimiter=;", "--versioned", "--quarantine"]
    assert main(["ingest", *args], spark=spark) == 1     # the other tables are missing
    assert "clubs\tok\t10" in capsys.readouterr().out and len(published(spark, paths.bronze("clubs"))) == 1
    assert _dialects(["*.delimiter=\\t", "clubs.multi_line=true"])["clubs"] == CsvDialect(delimiter="\t", multi_line=True)
    assert set(_dialects(["*.encoding=UTF-16"])) == set(SOURCE_TABLES) and _dialects([]) == {}
    with pytest.raises(ValueError, match="no CSV setting"):
        _dialects(["clubs.colour=red"])

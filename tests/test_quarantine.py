"""CSV dialects, quarantined cells, records and rows, and row counts from file footers."""

import json
import os
import tempfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from matchlake.operators.clean import normalize_nulls
from matchlake.plans import jobs, quality
from matchlake.plans.edition import compact, full
from matchlake.plans.silver import COMPACT_TABLES, FULL_TABLES, conform_all
from matchlake.sources import adapter
from matchlake.sources.io import (NULL_MARK, CsvDialect, LayerPaths, _footer_frame, csv_quarantine, footer_counts, read_csv,
                                  read_table, write_csv, write_table)
from matchlake.sources.schemas import SCHEMAS, SOURCE_TABLES

AWKWARD = ['say "hi"', 'a;b,c\td', "two\nlines", "\r\nend", " blanks ", "", None, "é ÿ ß", '"', '""', "\\", 'x\\"y', "#no comment", "'q'"]


def frame(spark):
    return spark.createDataFrame([(i, t, f"n{i}") for i, t in enumerate(AWKWARD)], "id long, text string, last string").coalesce(1)


@pytest.mark.parametrize("dialect", [
    CsvDialect(escape='"', multi_line=True), CsvDialect(delimiter=";", escape='"', multi_line=True),
    CsvDialect(delimiter="\t", quote="'", escape="'", multi_line=True),
    CsvDialect(encoding="ISO-8859-1", escape='"', multi_line=True), CsvDialect(encoding="UTF-16", escape='"', multi_line=True),
    CsvDialect(delimiter="||", escape='"', multi_line=True)], ids=str)
def test_cells_survive_a_foreign_dialect(spark, dialect):
    df, path = frame(spark), os.path.join(tempfile.mkdtemp(), "t.csv")
    write_csv(df, path, dialect=dialect)
    back = read_csv(spark, path, df.schema, null_value=NULL_MARK, dialect=dialect)
    got = {r.id: r.text for r in back.collect()}
    # A line break of two characters is read as one.
    assert got == {i: t and t.replace("\r\n", "\n") if t and "\r\n" in t and got[i] != t else t for i, t in enumerate(AWKWARD)}
    assert [r["last"] for r in back.orderBy("id").collect()] == [f"n{i}" for i in range(len(AWKWARD))]


def test_a_hand_written_file_of_another_dialect(spark):
    base = LayerPaths(tempfile.mkdtemp(prefix="matchlake-dialect-"))
    os.makedirs(os.path.dirname(base.raw("clubs")))
    with open(base.raw("clubs"), "w", encoding="latin-1", newline="") as f:
        f.write("% exported\nclub_id;name;stadium_name;squad_size\n1;\"Club \"\"One\"\"; A\";\"Stade\nNord\";25\n2;Évian;;x\n")
    dialect = CsvDialect(delimiter=";", escape='"', encoding="ISO-8859-1", multi_line=True, comment="%")
    status = jobs.run_ingest(spark, base, ["clubs"], dialects={"clubs": dialect}, quarantine=True).first()
    assert status.status == "ok" and status.row_count == 2 and status.error == "unparsed cells: squad_size 1"
    got = {r.club_id: r for r in read_table(spark, base.bronze("clubs")).collect()}
    assert got[1].name == 'Club "One"; A' and got[1].stadium_name == "Stade\nNord" and got[1].squad_size == 25
    assert got[2].name == "Évian" and got[2].stadium_name is None and got[2].squad_size is None
    reject = read_table(spark, base.rejects("clubs")).collect()
    assert [(r.reason, r.column_name, r.cell) for r in reject] == [("unparsed", "squad_size", "x")]
    assert reject[0].source_file.endswith("clubs.csv") and json.loads(reject[0].record)["name"] == "Évian"


def test_malformed_records_are_kept_whole(spark):
    base = LayerPaths(tempfile.mkdtemp(prefix="matchlake-malformed-"))
    os.makedirs(os.path.dirname(base.raw("game_events")))
    with open(base.raw("game_events"), "w") as f:
        f.write("game_event_id,game_id,type,description\n1,2,goal,ok\n3,4,goal,too,many,fields\n5,six\n7,null,goal,fine\n")
    status = jobs.run_ingest(spark, base, ["game_events"], quarantine=True).first()
    assert status.status == "ok" and status.row_count == 4
    assert status.error == "unparsed cells: game_id 1; malformed records: 2"
    rejects = read_table(spark, base.rejects("game_events")).collect()
    assert Counter((r.reason, r.column_name, r.cell) for r in rejects) == Counter([
        ("malformed", None, "3,4,goal,too,many,fields"), ("malformed", None, "5,six"), ("unparsed", "game_id", "six")])
    bronze = {r.game_event_id: r for r in read_table(spark, base.bronze("game_events")).collect()}
    assert bronze[3].description == "too" and bronze[5].type is None and len(bronze) == 4
    # A clean file of a later load leaves no rejects behind.
    with open(base.raw("game_events"), "w") as f:
        f.write("game_event_id,game_id,type,description\n1,2,goal,ok\n")
    assert jobs.run_ingest(spark, base, ["game_events"], quarantine=True).first().error is None
    assert not os.path.exists(base.rejects("game_events"))


def test_quarantine_of_a_clean_file_is_empty(spark, sf_small):
    path = os.path.join(tempfile.mkdtemp(), "clubs.csv")
    write_csv(adapter.clubs(spark, sf_small), path)
    assert csv_quarantine(spark, path, SCHEMAS["clubs"], NULL_MARK).collect() == []


@pytest.mark.parametrize("edition", ["compact", "full"])
def test_rows_in_are_rows_out_and_rejects(spark, sf_small, edition):
    ed = compact() if edition == "compact" else full()
    raw = adapter.raw_tables(spark, sf_small)
    rejects = quality.conform_rejects(raw, ed).collect()
    lost = Counter()
    for r in rejects:
        if r.reason != "unparsed":
            lost[r.table_name] += r.copies
    silver = conform_all(raw, ed)
    for t in COMPACT_TABLES if edition == "compact" else FULL_TABLES:
        assert raw[t].count() == silver[t].count() + lost[t], t
    told = {r.table_name: r for r in quality.conform_quality(raw, ed).collect()}
    for t, r in told.items():
        mine = [x for x in rejects if x.table_name == t]
        assert sum(x.copies for x in mine if x.reason == "duplicate") == r.duplicates_dropped
        assert sum(x.copies for x in mine if x.reason == "missing key") == r.rejected
        assert sum(x.copies for x in mine if x.reason == "unparsed" and x.column_name != "season") == r.unparsed_dates


def test_duplicates_are_whole_rows_with_copies(spark):
    rows = [(1, "a"), (1, "b"), (1, "b"), (1, None), (2, "x"), (2, "x"), (2, "x"), (None, "n"), (None, "n"), (None, "m"), (3, "one")]
    games = spark.createDataFrame([(i, t, "2000-01-01") for i, t in rows], "game_id long, round string, date string")
    for f in SCHEMAS["games"].fields:
        if f.name not in games.columns:
            games = games.withColumn(f.name, F.lit(None).cast(f.dataType))
    raw = {t: spark.createDataFrame([], SCHEMAS[t]) for t in SOURCE_TABLES} | {"games": games}
    got = quality.conform_rejects(raw, compact()).filter("table_name = 'games'").collect()
    told = Counter({(r.reason, r.row_key, json.loads(r.record).get("round")): r.copies for r in got})
    # The survivor of a key is its least row: NULL first, then by text.
    assert told == Counter({("duplicate", "1", "a"): 1, ("duplicate", "1", "b"): 2, ("duplicate", "2", "x"): 2,
                            ("duplicate", "\\N", "n"): 2, ("missing key", "\\N", "m"): 1})
    assert [r.column_name for r in got if r.reason == "missing key"] == ["game_id"]


def test_quarantine_stage_writes_a_table(spark, sf_small):
    paths = LayerPaths(tempfile.mkdtemp(prefix="matchlake-quarantine-")).for_edition("compact")
    for t in SOURCE_TABLES:
        write_table(adapter.BUILDERS[t](spark, sf_small), paths.bronze(t))
    status = jobs.run_quarantine(spark, paths, compact()).first()
    written = read_table(spark, paths.conform_rejects("conform_rejects"))
    assert status.status == "ok" and status.row_count == written.count() > 0
    assert {"reason", "record", "copies"} <= set(written.columns)


def test_reports_are_summed_up(spark):
    status = spark.createDataFrame([("a", "present"), ("b", "missing"), ("c", "present"), ("d", "failed")], "report string, status string")
    assert tuple(quality.report_summary(status).first()) == (4, 2, 1, 1, "2 of 4")
    assert tuple(quality.report_summary(status.limit(0)).first()) == (0, 0, 0, 0, "0 of 0")


# ---------------------------------------------------------------- footers

@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_counts_come_from_footers(spark, sf_small, fmt):
    base = tempfile.mkdtemp(prefix="matchlake-footers-")
    games = normalize_nulls(adapter.games(spark, sf_small)).withColumn("s", F.col("season").try_cast("int"))
    write_table(games, f"{base}/games", fmt)
    write_table(games, f"{base}/parts", fmt, ["s"])
    write_table(games.limit(0), f"{base}/none", fmt)
    tables = {n: f"{base}/{n}" for n in ("games", "parts", "none")}
    plan = _footer_frame(spark, tables, fmt)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PushedAggregation: [COUNT(*)]") == 3 and "ReadSchema: struct<o_" not in plan
    n = games.count()
    assert footer_counts(spark, tables, fmt) == {"games": n, "parts": n, "none": 0}
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""        # the caller's session is as it was


def test_footer_counts_of_an_overwritten_table(spark):
    path = tempfile.mkdtemp(prefix="matchlake-footers-") + "/t"
    for n in (500, 20):
        write_table(spark.range(n).repartition(7), path)
        assert footer_counts(spark, {"t": path}) == {"t": n}

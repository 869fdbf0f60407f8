"""Materialising jobs: raw CSV -> bronze -> silver -> gold -> reports, both editions."""

import tempfile

import pytest

from matchlake.plans import jobs
from matchlake.plans import reports as R
from matchlake.plans.edition import compact, full
from matchlake.plans.registry import REPORT_PARAMS, QUERIES
from matchlake.sources import adapter
from matchlake.sources.io import NULL_MARK, LayerPaths, read_table, write_csv
from matchlake.sources.schemas import SOURCE_TABLES


@pytest.fixture(scope="module")
def raw_base(spark, sf_small):
    base = tempfile.mkdtemp(prefix="matchlake-jobs-")
    paths = LayerPaths(base)
    for t in SOURCE_TABLES:
        write_csv(adapter.BUILDERS[t](spark, sf_small), paths.raw(t))
    return base


@pytest.mark.parametrize("edition", ["compact", "full"])
def test_run_all_writes_every_layer(spark, sf_small, raw_base, edition):
    ed = compact() if edition == "compact" else full()
    status = jobs.run_all(spark, raw_base, ed, params=REPORT_PARAMS, null_value=NULL_MARK)
    all_rows = status.collect()
    assert {r.stage for r in all_rows} == {"ingest", "conform", "model", "reports", "quality"}
    ep_q = LayerPaths(raw_base).for_edition(edition)
    metrics = {r.metric: r.value for r in read_table(spark, ep_q.quality("quality_metrics")).collect()}
    assert metrics["total_games"] == read_table(spark, ep_q.fact("fact_game")).count()
    counts = read_table(spark, ep_q.quality("layer_row_counts"))
    assert counts.filter("layer = 'gold'").count() == 7
    assert all(r.status == "ok" for r in all_rows if r.stage != "reports"), all_rows
    rows = {r.name: r for r in all_rows if r.stage == "reports"}
    assert set(rows) == set(R.report_names(edition))
    assert all(r.status == "ok" for r in rows.values()), rows
    # Reports read back from the materialised star equal the lineage plans.
    ep = LayerPaths(raw_base).for_edition(edition)
    for name in R.report_names(edition):
        written = read_table(spark, ep.report(name))
        direct = QUERIES[name](spark, sf_small)
        assert written.dtypes == direct.dtypes, name
        assert sorted(map(tuple, written.collect()), key=repr) == \
            sorted(map(tuple, direct.collect()), key=repr), name
        assert rows[name].row_count == written.count(), name


def test_fact_partitioned_by_season(spark, raw_base):
    ep = LayerPaths(raw_base).for_edition("compact")
    jobs.run_conform(spark, ep, compact())
    jobs.run_model(spark, ep, compact())
    fact = read_table(spark, ep.fact("fact_appearance")).filter("season_year = 1998")
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "season_year" in plan


def test_ingest_isolates_failures(spark, sf_small):
    paths = LayerPaths(tempfile.mkdtemp(prefix="matchlake-ingest-"))
    write_csv(adapter.clubs(spark, sf_small), paths.raw("clubs"))
    status = {r.table_name: r for r in jobs.run_ingest(spark, paths, ["clubs", "players"],
                                                       null_value=NULL_MARK).collect()}
    assert status["clubs"].status == "ok" and status["clubs"].row_count == 10
    assert status["players"].status == "missing"


def test_report_failure_is_a_status_row(spark, raw_base):
    ep = LayerPaths(raw_base).for_edition("compact")
    R.REPORTS["report99_compact"] = lambda star: star.dim_player.select("no_such_column")
    try:
        st = {r.report: r for r in jobs.run_reports(
            spark, ep, compact(), ["report99_compact", "report13_compact"]).collect()}
    finally:
        del R.REPORTS["report99_compact"]
    assert st["report99_compact"].status == "failed"
    assert st["report13_compact"].status == "ok"


def test_required_table_raises(spark):
    from pyspark.errors import AnalysisException

    paths = LayerPaths(tempfile.mkdtemp(prefix="matchlake-ingest-"))
    with pytest.raises(AnalysisException):
        jobs.ingest_all(spark, paths, ["players"], require=["players"])


def test_command_line_runs_every_stage(spark, raw_base, capsys):
    from matchlake.__main__ import main

    args = ["--base", raw_base, "--edition", "compact", "--null-marker",
            "--param", "report03_compact.season=1998"]
    assert main(["ingest", *args], spark=spark) == 0
    assert main(["conform", *args], spark=spark) == 0
    assert main(["model", *args], spark=spark) == 0
    assert main(["reports", *args], spark=spark) == 0
    assert main(["quality", *args], spark=spark) == 0
    out = capsys.readouterr().out
    assert "report15_compact\tok" in out and "fact_appearance\tok" in out


def test_command_line_rejects_unknown_format(spark, raw_base):
    from matchlake.__main__ import main

    with pytest.raises(ValueError, match="not available"):
        main(["ingest", "--base", raw_base, "--format", "no_such_format_xyz"], spark=spark)


@pytest.mark.parametrize("edition", [compact(), full()], ids=lambda e: e.name)
def test_written_facts_keep_their_schema(spark, sf_small, raw_base, edition):
    ep = LayerPaths(raw_base).for_edition(edition.name)
    jobs.run_conform(spark, ep, edition)
    jobs.run_model(spark, ep, edition)
    suffix = "" if edition.name == "compact" else "_full"
    for t, df in jobs.read_star(spark, ep).tables().items():
        assert df.dtypes == QUERIES[t + suffix](spark, sf_small).dtypes, t


def test_every_layer_has_the_format_asked_for(spark, raw_base):
    import glob
    import shutil

    from matchlake.__main__ import main

    base = tempfile.mkdtemp(prefix="matchlake-orc-")
    shutil.copytree(f"{raw_base}/raw", f"{base}/raw")
    assert main(["all", "--base", base, "--format", "orc", "--null-marker", "--csv"], spark=spark) == 0
    assert glob.glob(f"{base}/gold/**/*.orc", recursive=True) and not glob.glob(f"{base}/**/*.parquet", recursive=True)
    # Every report is exported too, quoted and with its header.
    assert len(glob.glob(f"{base}/gold/compact/reports_csv/*.csv/part-*")) >= 15
    lines = open(glob.glob(f"{base}/gold/compact/reports_csv/report05_compact.csv/part-*")[0]).read().splitlines()
    assert lines[0] in ('"name","total_wins"', "name,total_wins") and lines[1].startswith('"')


def test_one_missing_table_does_not_end_a_stage(spark, sf_small):
    base = LayerPaths(tempfile.mkdtemp(prefix="matchlake-partial-"))
    for t in ("players", "clubs", "games", "competitions"):
        write_csv(adapter.BUILDERS[t](spark, sf_small), base.raw(t))
    jobs.run_ingest(spark, base, null_value=NULL_MARK)
    ep = base.for_edition("compact")
    conform = {r.table_name: r for r in jobs.run_conform(spark, ep, compact()).collect()}
    assert conform["players"].status == "ok" and conform["appearances"].status == "failed"
    assert "PATH_NOT_FOUND" in conform["appearances"].error
    model = {r.table_name: r.status for r in jobs.run_model(spark, ep, compact()).collect()}
    assert model["fact_game"] == "ok" and model["fact_appearance"] == model["fact_club_perf"] == "failed"


def test_a_report_that_cannot_be_read_is_a_failure(spark, raw_base, capsys):
    import glob

    from matchlake.__main__ import main

    ep = LayerPaths(raw_base).for_edition("full")
    names = R.report_names("full")
    jobs.run_conform(spark, ep, full())
    jobs.run_model(spark, ep, full())
    jobs.run_reports(spark, ep, full(), names)
    for part in glob.glob(f"{ep.report('report13_full')}/part-*"):
        with open(part, "wb") as f:
            f.write(b"not a table")
    for crc in glob.glob(f"{ep.report('report13_full')}/.part-*.crc"):
        with open(crc, "wb") as f:
            f.write(b"")
    status = {r.report: r for r in jobs.report_status(spark, ep, [*names, "report99_full"]).collect()}
    assert status["report13_full"].status == "failed" and status["report13_full"].error
    assert status["report99_full"].status == "missing" and status["report12_full"].status == "present"
    assert main(["quality", "--base", raw_base, "--edition", "full"], spark=spark) == 1
    assert "report13_full\tfailed" in capsys.readouterr().out
    jobs.run_reports(spark, ep, full(), names)

"""Per-player totals, late top-k and counted dedupe: rows as before, and the plans they are for."""

import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from matchlake.operators.clean import dedupe, dedupe_sparse, normalize_nulls
from matchlake.operators.metrics import MOST_BROADCAST, top_k, top_k_late
from matchlake.plans import jobs
from matchlake.plans import reports as R
from matchlake.plans.edition import compact, full
from matchlake.plans.registry import REPORT_PARAMS, Layers
from matchlake.plans.star import FACT_TABLES, Star
from matchlake.plans.totals import KEYS, MEASURES, merge_totals, player_totals, totals_by, totals_per_player
from matchlake.sources import adapter
from matchlake.sources.io import LayerPaths, write_table

DERIVED = {"report02", "report03", "report04", "report06", "report07", "report08", "report10", "report11", "report13"}


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module", params=["full"])  # test_jobs compares both editions' reports
def written(request, spark, sf_small):
    """(edition, paths of a written model)."""
    ed = compact() if request.param == "compact" else full()
    paths = LayerPaths(tempfile.mkdtemp(prefix="matchlake-totals-")).for_edition(ed.name)
    for t in adapter.BUILDERS:
        write_table(adapter.BUILDERS[t](spark, sf_small), paths.bronze(t))
    jobs.run_conform(spark, paths, ed)
    status = {r.table_name: r for r in jobs.run_model(spark, paths, ed).collect()}
    assert status["player_totals"].status == "ok"
    return ed, paths


def scans(df) -> str:
    plan = df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().executedPlan().toString()
    return plan


def test_only_one_report_reads_the_appearance_fact(spark, written):
    ed, paths = written
    star = jobs.read_star(spark, paths)
    reading = set()
    for name in R.report_names(ed.name):
        plan = scans(R.REPORTS[name](star, **REPORT_PARAMS.get(name, {})))
        if "fact_appearance" in plan:
            reading.add(name)
        if name[:8] in DERIVED and name not in (f"report{n}_compact" for n in ("07", "10", "13")):
            assert "totals/player_totals" in plan, name
    assert reading == {f"report01_{ed.name}"}


def test_season_report_prunes_the_totals(spark, written):
    ed, paths = written
    plan = scans(R.REPORTS[f"report03_{ed.name}"](jobs.read_star(spark, paths), season=1998))
    assert "PartitionFilters: [isnotnull(season_year" in plan


def test_reports_from_totals_equal_those_from_the_fact(spark, written):
    ed, paths = written
    stored = jobs.read_star(spark, paths)
    plain = Star(**stored.tables())
    assert stored.player_totals is not None and plain.player_totals is None
    for name in R.report_names(ed.name):
        if name[:8] in DERIVED:
            kwargs = REPORT_PARAMS.get(name, {})
            a, b = R.REPORTS[name](stored, **kwargs), R.REPORTS[name](plain, **kwargs)
            assert a.dtypes == b.dtypes and rows(a) == rows(b), name


def test_totals_merge(spark, written):
    _, paths = written
    fact = jobs.read_star(spark, paths).fact_appearance
    whole = player_totals(fact)
    parts = [player_totals(fact.filter(F.pmod(F.xxhash64("appearance_key"), F.lit(3)) == i)) for i in range(3)]
    assert rows(merge_totals(*parts)) == rows(whole)
    assert rows(merge_totals(whole)) == rows(whole)
    assert rows(merge_totals(whole, player_totals(fact.limit(0)))) == rows(whole)
    assert whole.columns == [*KEYS, *MEASURES]


def test_totals_of_nulls(spark):
    fact = spark.createDataFrame(
        [(1, 10, None, None, None, None, None, None, None), (1, 11, None, None, 2, None, 1, None, 90),
         (None, None, 2000, "a", 1, 1, 1, 1, 1)],
        "player_key long, game_key long, season_year int, competition_key string, goals int, assists int, "
        "yellow_cards int, red_cards int, minutes_played int")
    got = {r.player_key: r for r in player_totals(fact).collect()}
    assert got[1].apps == 2 and got[1].games == 2 and got[1].goals == 2 and got[1].n_goals == 1
    assert got[1].assists is None and got[1].n_assists == 0 and got[None].games == 0
    # No group without rows: an empty fact has no totals.
    assert player_totals(fact.limit(0)).collect() == []


def test_totals_of_an_earlier_run_are_not_read(spark, written):
    """A model whose fact fails leaves no totals, and the reports say so instead of mixing two runs."""
    ed, paths = written
    star = jobs.read_star(spark, paths)
    broken = {t: (lambda t=t: getattr(star, t)) for t in Star.TABLES} | {
        "fact_appearance": lambda: star.fact_appearance.select("no_such_column")}
    other = LayerPaths(tempfile.mkdtemp(prefix="matchlake-broken-")).for_edition(ed.name)
    assert "ok" in {r.status for r in jobs.write_star(spark, star, other).collect()}
    assert os.path.isdir(other.totals("player_totals"))
    status = {r.table_name: r.status for r in jobs.write_star(spark, Star(**broken), other).collect()}
    assert status["fact_appearance"] == "failed" and "player_totals" not in status
    assert not os.path.isdir(other.totals("player_totals")) and jobs.read_star(spark, other).player_totals is None
    assert jobs.read_star(spark, paths).player_totals is not None


# ---------------------------------------------------------------- late top-k

LATE = ["report02_full", "report03_compact", "report03_full", "report04_full", "report05_compact", "report05_full",
        "report08_compact", "report08_full"]


def no_broadcast(spark, threshold):
    for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(key, threshold) if threshold else spark.conf.unset(key)


@pytest.mark.parametrize("name", LATE)
def test_attributes_are_fetched_for_the_top_rows_only(spark, sf_small, name):
    """Also where the dimension is too large for a broadcast: its wide rows meet the k keys before
    they are de-duplicated, shuffled or joined."""
    no_broadcast(spark, "-1")
    try:
        ed = compact() if name.endswith("compact") else full()
        df = R.REPORTS[name](Layers(spark, sf_small).star(ed), **REPORT_PARAMS.get(name, {}))
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        wide = "p_brand" if "05" not in name else "s_name"
        lines = plan.splitlines()
        depth = {i: len(x) - len(x.lstrip(" :+-")) for i, x in enumerate(lines)}
        semi = [i for i, x in enumerate(lines) if "Join LeftSemi" in x and "rightHint=(strategy=broadcast)" in x]
        assert semi, plan
        # Every aggregate that handles the attribute stands on such a semi join.
        for i, x in enumerate(lines):
            if "Aggregate [" in x and wide in x:
                below = [j for j in range(i + 1, len(lines)) if all(depth[k] > depth[i] for k in range(i + 1, j + 1))]
                assert set(below) & set(semi), plan
    finally:
        no_broadcast(spark, None)


def test_late_top_k_equals_join_then_cut(spark):
    rnd = random.Random(2)
    stats = spark.createDataFrame([(i if i % 9 else None, rnd.randint(0, 5), rnd.randint(0, 3)) for i in range(200)],
                                  "k long, a int, b int").filter("k is not null or a = 0").dropDuplicates(["k"])
    dim = spark.createDataFrame([(i, f"name {i}") for i in range(50, 400)], "k long, name string")
    order = [F.desc("a"), F.desc("b")]
    for k in (0, 1, 7, 60, 500, MOST_BROADCAST + 1):
        late = top_k_late(stats, dim, "k", k, order, ["name", "k", "b", "a"])
        plain = top_k(dim.join(stats, "k"), k, order, tie=["k"]).select("name", "k", "b", "a")
        assert [tuple(r) for r in late.collect()] == [tuple(r) for r in plain.collect()], k
    large = top_k_late(stats, dim, "k", MOST_BROADCAST + 1, order, ["name"])
    assert "strategy=broadcast" not in large._jdf.queryExecution().optimizedPlan().toString()


# ---------------------------------------------------------------- counted dedupe

def test_counted_dedupe_equals_dedupe(spark):
    rnd = random.Random(5)
    cells = [None, "", "x", "y"]
    table = [(rnd.choice([None, *range(40)]), rnd.choice([None, 1, 2]), rnd.choice(cells), rnd.choice([None, 0.5, 1.5])) for _ in range(300)]
    df = spark.createDataFrame(table, "a long, b int, c string, d double").repartition(5)
    for keys, order in ((["a"], None), (["a", "b"], None), (["a"], ["d"]), (["c", "a"], ["b"]), (["a", "b", "c", "d"], None)):
        assert rows(dedupe_sparse(df, keys, order)) == rows(dedupe(df, keys, order)), keys
    assert dedupe_sparse(df, ["a"]).columns == df.columns
    assert dedupe_sparse(df.limit(0), ["a"]).collect() == []


def test_counted_dedupe_passes_single_rows_unsorted(spark, sf_small):
    """Rows of keys that occur once are neither sorted nor shuffled, and a reader of two columns reads two."""
    games = normalize_nulls(adapter.games(spark, sf_small))
    df = dedupe_sparse(games, ["game_id"]).select("game_id", "attendance")
    first = df._jdf.queryExecution().executedPlan().toString()
    alone, again = first.split("Union")[1].split("LeftSemi")[0], first.split("LeftSemi")[1]
    assert "LeftAnti" in alone and "SortAggregate" in first.split("LeftSemi")[0] and "SortAggregate" not in again
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in first
    assert "ReadSchema: struct<o_orderkey:bigint>" in first                   # the keys are counted by themselves
    df.collect()
    # No key repeats here, so what is left of the plan is a scan of two columns.
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "SortAggregate" not in final and "Exchange" not in final
    assert dedupe(games, ["game_id"]).count() == df.count()


def test_counted_dedupe_of_a_hot_key(spark):
    """A key of a third of all rows is reduced before its shuffle."""
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"),
                                  (F.col("id") * 7919 % 3001).alias("v")).repartition(6)
    got = dedupe_sparse(df, ["k"])
    assert "partial_min" in got._jdf.queryExecution().executedPlan().toString()
    assert rows(got) == rows(dedupe(df, ["k"]))


def test_star_without_totals_still_lists_seven_tables(spark, written):
    _, paths = written
    assert set(jobs.read_star(spark, paths).tables()) == set(Star.TABLES) and set(FACT_TABLES) < set(Star.TABLES)


# ---------------------------------------------------------------- bytes shuffled by the jobs

def test_totals_per_player_are_shared(spark, written):
    """Reports per player read stored sums: none of them adds up the totals by player again."""
    ed, paths = written
    star = jobs.read_star(spark, paths)
    for n in ("04", "06", "08", "11", "13"):
        df = R.REPORTS[f"report{n}_{ed.name}"](star)
        files = " ".join(df.inputFiles())
        assert "totals/player_totals_per_player/" in files and "totals/player_totals/" not in files, n
        assert "keys=[player_key" not in scans(df), n
    for n in ("02", "03"):                                                     # some competitions, one season
        assert "player_totals_per_player" not in " ".join(R.REPORTS[f"report{n}_{ed.name}"](star).inputFiles()), n
    assert rows(star.player_totals_per_player) == rows(totals_by(Star(**star.tables()), ["player_key"], **{m: m for m in MEASURES}))
    assert star.player_totals_per_player.dtypes == totals_by(
        Star(**star.tables()), ["player_key"], **{m: m for m in MEASURES}).dtypes


def test_totals_per_player_of_nulls(spark):
    fact = spark.createDataFrame(
        [(1, 10, 1999, "a", None, None, None, None, 5), (1, None, 2000, None, 2, None, 1, None, 90),
         (1, 12, None, "a", 3, None, None, None, None), (None, None, 2000, "a", 1, 1, 1, 1, 1), (None, 4, None, None, 1, 1, 1, 1, 1)],
        "player_key long, game_key long, season_year int, competition_key string, goals int, assists int, "
        "yellow_cards int, red_cards int, minutes_played int")
    got = {r.player_key: r for r in totals_per_player(player_totals(fact)).collect()}
    assert set(got) == {1, None}
    assert (got[1].apps, got[1].games, got[1].goals, got[1].n_goals, got[1].minutes_played) == (3, 2, 5, 2, 95)
    assert got[1].assists is None and got[1].n_assists == 0 and got[1].red_cards is None
    assert (got[None].apps, got[None].games, got[None].goals) == (2, 1, 2)


def test_sums_per_player_go_with_the_totals(spark, written):
    """Neither totals table outlives the fact that it was added up from."""
    ed, paths = written
    star = jobs.read_star(spark, paths)
    other = LayerPaths(tempfile.mkdtemp(prefix="matchlake-stale-")).for_edition(ed.name)
    jobs.write_star(spark, star, other)
    assert os.path.isdir(other.totals(jobs.PER_PLAYER))
    broken = {t: (lambda t=t: getattr(star, t)) for t in Star.TABLES} | {
        "fact_appearance": lambda: star.fact_appearance.select("no_such_column")}
    jobs.write_star(spark, Star(**broken), other)
    assert not os.path.isdir(other.totals(jobs.PER_PLAYER))
    assert jobs.read_star(spark, other).player_totals_per_player is None


def test_facts_and_totals_are_written_without_another_shuffle(spark, written, monkeypatch):
    from matchlake.sources import io

    ed, paths = written
    plans, write = {}, io.write_table

    def recorded(df, path, *args, **kwargs):
        plans[path.rsplit("/", 1)[1]] = df._jdf.queryExecution().optimizedPlan().toString()
        write(df, path, *args, **kwargs)

    monkeypatch.setattr(io, "write_table", recorded)
    other = LayerPaths(tempfile.mkdtemp(prefix="matchlake-plain-")).for_edition(ed.name)
    jobs.write_star(spark, jobs.read_star(spark, paths), other)
    for t in ("fact_appearance", "fact_game", "player_totals"):
        assert t in plans and "Rebalance" not in plans[t], t
        assert any(n.startswith("season_year=") for n in os.listdir((other.fact if t in FACT_TABLES else other.totals)(t))), t


def test_clubs_of_a_player_take_one_shuffle(spark, written):
    """One of the fact's rows, and one of the players that they are joined with."""
    ed, paths = written
    plan = R.REPORTS[f"report01_{ed.name}"](jobs.read_star(spark, paths))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 2 and plan.count("collect_set") == 2, plan


def test_clubs_of_a_player_on_odd_rows(spark):
    """Clubs that share a name, without one, or unknown; a club twice; players without a row or only without a club."""
    fact = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (1, 3), (1, 9), (2, 9), (3, None), (3, 4), (None, 1)],
                                 "player_key long, club_key long")
    clubs = spark.createDataFrame([(1, "Same"), (2, "Same"), (3, None), (4, "Älv"), (5, "Unseen")], "club_key long, name string")
    players = spark.createDataFrame([(i, f"p{i}", "x", "y", None, 20, "z") for i in (1, 2, 3, 4)],
                                    "player_key long, full_name string, country_of_citizenship string, position string, "
                                    "date_of_birth date, age int, current_club_name string")
    unread = {t: None for t in Star.TABLES} | {"fact_appearance": fact, "dim_club": clubs, "dim_player": players}
    df = R.report01_full(Star(**{t: v if v is not None else (lambda: 1 / 0) for t, v in unread.items()}))
    got = {r.player_key: (r.clubs_played, r.number_of_clubs) for r in df.collect()}
    assert got == {1: (["Same"], 1), 2: ([], 0), 3: (["Älv"], 1), 4: (None, 0)}
    assert dict(df.dtypes)["number_of_clubs"] == "bigint"


def test_tables_are_compressed_unless_the_session_says_how(spark):
    import glob

    base, conf = tempfile.mkdtemp(prefix="matchlake-codec-"), "spark.sql.parquet.compression.codec"
    write_table(spark.range(10), f"{base}/own")
    spark.conf.set(conf, "gzip")
    try:
        write_table(spark.range(10), f"{base}/session")
    finally:
        spark.conf.unset(conf)
    assert glob.glob(f"{base}/own/*.zstd.parquet") and glob.glob(f"{base}/session/*.gz.parquet")
    assert spark.read.parquet(f"{base}/own").count() == spark.read.parquet(f"{base}/session").count() == 10

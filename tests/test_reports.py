"""Report contracts: golden column layouts, cross-report invariants, oracle parity."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from matchlake.plans import quality
from matchlake.plans import reports as R
from matchlake.plans.edition import compact, full
from matchlake.plans.registry import Layers
from tests.oracle_check import compare, duck

# Header rows of the published compact-edition report files.
GOLDEN_COLUMNS = {
    "report01_compact": ["full_name", "country_of_citizenship", "position", "number_of_clubs"],
    "report02_compact": ["full_name", "country_of_citizenship", "intl_apps", "intl_goals"],
    "report03_compact": ["full_name", "total_goals", "country_of_citizenship"],
    "report04_compact": ["full_name", "total_reds", "total_games"],
    "report06_compact": ["full_name", "total_goals", "total_assists", "apps"],
    "report07_compact": ["name", "type", "country_name", "total_games", "avg_goals",
                         "avg_attendance"],
    "report08_compact": ["full_name", "total_assists"],
    "report10_compact": ["season_year", "total_goals", "avg_attendance"],
    "report11_compact": ["position", "avg_goals_per_player", "avg_assists_per_player"],
    "report12_compact": ["home_name", "away_name", "attendance", "total_goals", "date_key"],
    "report13_compact": ["country_of_citizenship", "player_count"],
    "report14_compact": ["month_name", "month", "goals"],
    "report15_compact": ["name", "squad_size", "foreigners_number", "average_age"],
}


@pytest.fixture(scope="module")
def stars(spark, sf_small):
    lay = Layers(spark, sf_small)
    return {"compact": lay.star(compact()), "full": lay.star(full())}


def test_thirty_reports_registered():
    assert len(R.report_names("compact")) == 15 and len(R.report_names("full")) == 15


@pytest.mark.parametrize("name", sorted(GOLDEN_COLUMNS))
def test_golden_column_layout(stars, name):
    assert R.REPORTS[name](stars["compact"]).columns == GOLDEN_COLUMNS[name]


def _sum(df, col):
    return df.agg(F.sum(col)).collect()[0][0] or 0


def test_goal_totals_are_conserved(stars):
    star = stars["compact"]
    all_goals = _sum(star.fact_game, "total_goals")
    # Every game has a season group (NULL included).
    assert _sum(R.report10_compact(star), "total_goals") == all_goals
    # Only games whose competition exists reach the competition report.
    known = star.fact_game.join(star.dim_competition.select("competition_key"),
                                "competition_key", "left_semi")
    assert known.count() < star.fact_game.count()
    r07 = R.report07_compact(star)
    assert round(_sum(r07.select((F.col("total_games") * F.col("avg_goals")).alias("g")), "g")) \
        == _sum(known, "total_goals")
    dated = _sum(star.fact_game.filter(F.col("date_key").isNotNull()), "total_goals")
    assert _sum(R.report14_compact(star), "goals") == dated
    assert R.report14_compact(star).count() == 12


def test_player_and_game_counts(stars):
    star = stars["full"]
    assert _sum(R.report13_compact(stars["compact"]), "player_count") == \
        stars["compact"].dim_player.count()
    r13 = R.report13_full(star)
    assert _sum(r13, "total_players") == star.dim_player.count()
    assert _sum(r13, "total_appearances") == star.fact_appearance.count()
    known = star.fact_game.join(star.dim_competition.select("competition_key"),
                                "competition_key", "left_semi")
    assert _sum(R.report07_full(star), "total_games") == known.count()


def test_top_k_limits(stars):
    assert R.report03_compact(stars["compact"], season=1998).count() <= 10
    assert R.report05_full(stars["full"]).count() == 5
    assert R.report12_full(stars["full"]).count() == 20
    r12 = R.report12_full(stars["full"]).collect()
    att = [r.attendance for r in r12]
    assert att == sorted(att, reverse=True)


def test_quality_metrics_on_empty_tables(spark, stars):
    star = stars["full"]
    empty = type(star)(**{k: v.limit(0) for k, v in star.tables().items()})
    m = {r.metric: r.value for r in quality.quality_metrics(empty).collect()}
    assert m["total_goals"] is None and m["total_games"] == 0


def test_is_win_encodings_both_counted(stars):
    perf = stars["full"].fact_club_perf
    wins = perf.filter("won").groupBy("is_win").count().collect()
    assert {r.is_win for r in wins} == {"1", "win"}


ORACLE_NAMES = sorted(entry.oracle_sql())


@pytest.fixture(scope="module")
def duck_small(sf_small):
    return duck(sf_small)


@pytest.mark.parametrize("name", ORACLE_NAMES)
def test_matches_oracle(spark, duck_small, sf_small, name):
    res = compare(spark, duck_small, name, sf_small, entry.queries()[name],
                  entry.oracle_sql()[name])
    assert res["match"], res
    assert "type_diffs" not in res, res


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["full_name", "total_goals", "country_of_citizenship"]
    assert df.count() == 10


def test_report_status_matches_brute_force(spark, sf_small):
    status = {r.report: r for r in entry.queries()["report_status"](spark, sf_small).collect()}
    assert set(status) == set(R.report_names("full"))
    for name, row in status.items():
        assert row.status == "present", row
        assert row.row_count == entry.queries()[name](spark, sf_small).count(), name


def test_conform_quality_on_empty_tables(spark, sf_small):
    from matchlake.sources import adapter

    raw = {t: df.limit(0) for t, df in adapter.raw_tables(spark, sf_small).items()}
    rows = quality.conform_quality(raw, compact()).collect()
    assert len(rows) == 8
    assert all((r.rows_in, r.duplicates_dropped, r.rejected, r.rows_out, r.unparsed_dates)
               == (0, 0, 0, 0, 0) for r in rows), rows


def test_unordered_reports_have_same_rows_and_no_range_sort(stars):
    for name in R.report_names():
        if not R.takes_order(name):
            continue
        star = stars["compact" if name.endswith("compact") else "full"]
        a, b = R.REPORTS[name](star), R.REPORTS[name](star, ordered=False)
        assert sorted(map(tuple, a.collect()), key=repr) == \
            sorted(map(tuple, b.collect()), key=repr), name
        plan = b._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" not in plan, name


def test_editions_agree_on_appearance_totals(stars):
    """The editions differ in sentinels and stamps, not in appearance measures."""
    c = R.report06_compact(stars["compact"]).agg(F.sum("total_goals"), F.sum("total_assists"),
                                                   F.sum("apps")).first()
    f = R.report06_full(stars["full"]).agg(F.sum("total_goals"), F.sum("total_assists"),
                                             F.sum("total_appearances")).first()
    assert tuple(c) == tuple(f)
    fact = stars["compact"].fact_appearance.join(
        stars["compact"].dim_player.select("player_key"), "player_key", "left_semi")
    assert c[0] == _sum(fact, "goals")


def test_club_win_reports_agree(stars):
    star = stars["full"]
    r05 = {r.club_key: (r.total_wins, r.total_matches)
           for r in R.report05_full(star, k=10_000).collect()}
    r09 = {r.club_key: (r.home_wins + r.away_wins, r.home_games + r.away_games)
           for r in R.report09_full(star).collect()}
    r15 = {r.club_key: (r.total_wins, r.total_matches)
           for r in R.report15_full(star).collect()}
    assert r05 and r05 == r09
    assert all(r15[k] == v for k, v in r05.items() if k in r15)


# The order in which each report without a limit is read out.
ORDERS = {
    "report01_compact": [("number_of_clubs", "desc")], "report01_full": [("number_of_clubs", "desc")],
    "report02_compact": [("intl_apps", "desc")], "report04_compact": [("total_reds", "desc")],
    "report06_compact": [("total_goals", "desc")], "report06_full": [("goal_contribution", "desc")],
    "report07_compact": [("avg_attendance", "desc")], "report07_full": [("total_games", "desc")],
    "report09_full": [("home_win_pct", "desc")], "report10_compact": [("season_year", "asc")],
    "report10_full": [("season_year", "asc")], "report11_compact": [("avg_goals_per_player", "desc")],
    "report11_full": [("total_goals", "desc")], "report13_compact": [("player_count", "desc")],
    "report13_full": [("total_players", "desc")], "report14_compact": [("month", "asc")],
    "report14_full": [("month", "asc")], "report15_compact": [("squad_size", "desc")],
    "report15_full": [("foreigners_percentage", "desc")],
    "report02_full": [("international_appearances", "desc")], "report03_compact": [("total_goals", "desc")],
    "report03_full": [("total_goals", "desc"), ("goals_per_match", "desc")],
    "report04_full": [("total_red_cards", "desc"), ("total_yellow_cards", "desc")],
    "report05_compact": [("total_wins", "desc")],
    "report05_full": [("total_wins", "desc"), ("win_percentage", "desc"), ("goal_difference", "desc")],
    "report08_compact": [("total_assists", "desc")], "report08_full": [("total_assists", "desc")],
    "report12_compact": [("attendance", "desc")], "report12_full": [("attendance", "desc")],
}


def test_every_ordered_report_has_its_order_listed():
    assert set(R.REPORTS) - set(ORDERS) == {"report09_compact"}  # defined without an order
    assert {n for n in R.REPORTS if R.takes_order(n)} <= set(ORDERS)


@pytest.fixture(scope="module")
def with_nulls(stars):
    """Both stars with NULLs in what the reports sort by."""
    from pyspark.sql import functions as F

    out = {}
    for name, star in stars.items():
        tables = star.tables()
        club, game, perf = tables["dim_club"], tables["fact_game"], tables["fact_club_perf"]
        odd = F.col("club_key") % 3 == 0
        tables["dim_club"] = club.withColumns({c: F.when(~odd, F.col(c)) for c in ("squad_size",) if name == "compact"} | {
            c: F.when(~odd, F.col(c)) for c in ("foreigners_percentage",) if name == "full"})
        tables["fact_game"] = game.withColumns({
            "attendance": F.when(F.col("competition_key") != "3", F.col("attendance")),
            "season_year": F.when(F.col("season_year") != 1997, F.col("season_year"))})
        tables["fact_club_perf"] = perf.filter((F.col("club_key") % 4 != 0) | (F.col("hosting") == "Away"))
        out[name] = type(star)(**tables)
    return out


@pytest.mark.parametrize("name", sorted(ORDERS))
def test_reports_come_out_in_order(with_nulls, name):
    """NULLs last when descending, first when ascending, as Spark sorts by default."""
    params = {"season": 1998} if name.startswith("report03") else {}
    rows = R.REPORTS[name](with_nulls[name.split("_")[1]], **params).collect()

    def key(row):
        out = []
        for column, way in ORDERS[name]:
            v = row[column]
            out.append((v is None, 0 if v is None else -v) if way == "desc" else (v is not None, v or 0))
        return out

    assert len(rows) > 1 and [key(r) for r in rows] == sorted(key(r) for r in rows)
    if name in ("report07_compact", "report10_compact", "report15_compact", "report15_full", "report09_full"):
        assert any(r[ORDERS[name][0][0]] is None for r in rows), "the case has a NULL to place"

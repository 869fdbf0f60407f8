"""Readers, writers, layer paths and session defaults."""

import tempfile

import pytest

from matchlake.session import CLUSTER_CONF, apply_defaults
from matchlake.sources.io import (NULL_MARK, LayerPaths, check_format, ingest_all, read_csv, read_table, write_counted,
                                  write_csv, write_table)
from matchlake.sources.schemas import CLUBS


def test_inferred_csv_types_drift_but_declared_schema_holds(spark):
    path = tempfile.mkdtemp(prefix="matchlake-csv-") + "/t.csv"
    df = spark.createDataFrame([("1", "a"), ("null", "b")], "squad_size string, name string")
    df.coalesce(1).write.option("header", True).csv(path)
    inferred = read_csv(spark, path, infer=True)
    # A numeric column holding the text 'null' is inferred as text.
    assert dict(inferred.dtypes)["squad_size"] == "string"
    from pyspark.sql import types as T

    declared = read_csv(spark, path, T.StructType([CLUBS["squad_size"], CLUBS["name"]]))
    assert dict(declared.dtypes)["squad_size"] == "int"
    assert sorted(((r.squad_size, r.name) for r in declared.collect()), key=repr) == \
        [(1, "a"), (None, "b")]


def test_csv_round_trip_keeps_blanks_and_empty_strings(spark):
    path = tempfile.mkdtemp(prefix="matchlake-csv-") + "/t.csv"
    df = spark.createDataFrame([(" x ", ""), (None, "y")], "a string, b string")
    write_csv(df, path)
    back = read_csv(spark, path, df.schema, null_value=NULL_MARK)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)


def test_layer_paths():
    p = LayerPaths("/data/x")
    assert p.raw("players") == "/data/x/raw/players.csv"
    assert p.bronze("players") == "/data/x/bronze/players"
    f = p.for_edition("full")
    assert f.silver("games") == "/data/x/silver/full/games"
    assert f.fact("fact_game") == "/data/x/gold/full/fact/fact_game"
    assert f.report("report01_full") == "/data/x/gold/full/reports/report01_full"


def test_write_counted_observes_rows(spark):
    path = tempfile.mkdtemp(prefix="matchlake-w-") + "/t"
    assert write_counted(spark.range(1234), path) == 1234


def test_cluster_defaults_fill_only_unset(spark):
    # shuffle partitions was set at launch by the test session; it must be kept.
    before = spark.conf.get("spark.sql.shuffle.partitions")
    applied = apply_defaults(spark, {"spark.sql.shuffle.partitions": "20000",
                                     "spark.sql.files.maxPartitionBytes":
                                         CLUSTER_CONF["spark.sql.files.maxPartitionBytes"]})
    try:
        assert "spark.sql.shuffle.partitions" not in applied
        assert spark.conf.get("spark.sql.shuffle.partitions") == before
        assert "spark.sql.files.maxPartitionBytes" in applied
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_unknown_format_fails_early(spark):
    import pytest

    from matchlake.sources.io import check_format

    check_format(spark, "parquet")
    with pytest.raises(ValueError, match="not available"):
        check_format(spark, "no_such_format_xyz")


def test_csv_columns_matched_by_name(spark):
    from pyspark.sql import types as T

    path = tempfile.mkdtemp(prefix="matchlake-csv-") + "/t.csv"
    df = spark.createDataFrame([("b", "7", "extra"), ("a", "null", "x")],
                               "name string, squad_size string, unrelated string")
    df.coalesce(1).write.option("header", True).csv(path)
    schema = T.StructType([CLUBS["squad_size"], CLUBS["name"], CLUBS["average_age"]])
    got = read_csv(spark, path, schema)
    # Declared columns first; a column nobody declared follows as text.
    assert got.columns == ["squad_size", "name", "average_age", "unrelated"]
    assert dict(got.dtypes) == {"squad_size": "int", "name": "string", "average_age": "double", "unrelated": "string"}
    assert sorted(map(tuple, got.collect()), key=repr) == [(7, "b", None, "extra"), (None, "a", None, "x")]


def test_cluster_defaults_keep_runtime_settings(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64m")
    try:
        assert apply_defaults(spark, {"spark.sql.files.maxPartitionBytes": "256m"}) == []
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "64m"
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_partitioned_write_is_rebalanced(spark):
    import glob

    from matchlake.sources.io import write_table
    from pyspark.sql import functions as F

    base = tempfile.mkdtemp(prefix="matchlake-part-")
    df = spark.range(0, 20000, 1, 16).withColumn("season", F.col("id") % 4)
    write_table(df, f"{base}/plain", partition_by=["season"], rebalance=False)
    write_table(df, f"{base}/rebal", partition_by=["season"])
    plain = len(glob.glob(f"{base}/plain/*/*.parquet"))
    rebal = len(glob.glob(f"{base}/rebal/*/*.parquet"))
    assert rebal < plain
    assert spark.read.parquet(f"{base}/rebal").count() == 20000


def test_concurrent_submissions_keep_the_job_group(spark):
    from matchlake.session import run_concurrently

    sc = spark.sparkContext
    sc.setJobGroup("matchlake-test-group", "concurrency")
    try:
        seen = run_concurrently(spark, [lambda: sc.getLocalProperty("spark.jobGroup.id")] * 4, 4)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert seen == ["matchlake-test-group"] * 4


def _csv(spark, path, header, *rows):
    spark.createDataFrame([(",".join(r),) for r in (header, *rows)], "line string").coalesce(1).write.text(path)


def test_ingest_loses_nothing_in_silence(spark):
    base = LayerPaths(tempfile.mkdtemp(prefix="matchlake-lossless-"))
    _csv(spark, base.raw("appearances"), ["appearance_id", "Game_Id", "player_id", "goals", "minutes_played", "kit"],
         ["a", "7", "1", "2.0", "90.0", "red"], ["b", "8", "2", "2.5", "null", "blue"], ["c", "9", "3", "x", "", ""])
    status = {r.table_name: r for r in ingest_all(spark, base, ["appearances"]).collect()}["appearances"]
    assert (status.status, status.row_count, status.error) == ("ok", 3, "unparsed cells: goals 2")
    rows = {r.appearance_id: r for r in read_table(spark, base.bronze("appearances")).collect()}
    assert (rows["a"].game_id, rows["a"].goals, rows["a"].minutes_played, rows["a"].kit) == (7, 2, 90, "red")
    assert rows["b"].goals is None and rows["b"].minutes_played is None and rows["c"].goals is None


def test_a_missing_key_column_fails_the_table(spark):
    base = LayerPaths(tempfile.mkdtemp(prefix="matchlake-nokey-"))
    _csv(spark, base.raw("games"), ["id", "season"], ["1", "2014"])
    _csv(spark, base.raw("clubs"), ["club_id", "name"], ["1", "x"])
    status = {r.table_name: (r.status, r.error) for r in ingest_all(spark, base, ["games", "clubs"]).collect()}
    assert status["clubs"] == ("ok", None)
    assert status["games"] == ("failed", "ValueError: key column(s) missing: game_id")


def test_an_error_without_text_stays_in_its_table(spark, monkeypatch):
    from matchlake.sources import io

    base = LayerPaths(tempfile.mkdtemp(prefix="matchlake-empty-error-"))
    _csv(spark, base.raw("clubs"), ["club_id", "name"], ["1", "x"])
    _csv(spark, base.raw("games"), ["game_id"], ["1"])
    write = io.write_table

    def failing(df, path, *rest, **more):
        if path.endswith("clubs"):
            raise AssertionError
        return write(df, path, *rest, **more)

    monkeypatch.setattr(io, "write_table", failing)
    status = {r.table_name: (r.status, r.error) for r in ingest_all(spark, base, ["games", "clubs"]).collect()}
    assert status == {"games": ("ok", None), "clubs": ("failed", "AssertionError")}
    long = "x" * 500 + "\nsecond line"
    assert io.error_text(ValueError(long)) == f"ValueError: {long}"


def test_overwrite_is_full_in_a_dynamic_session(spark):
    path = tempfile.mkdtemp(prefix="matchlake-static-") + "/t"
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        write_table(spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string"), path, partition_by=["p"])
        write_table(spark.createDataFrame([(3, "c")], "v int, p string"), path, partition_by=["p"])
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert [r.v for r in read_table(spark, path).collect()] == [3]


@pytest.mark.parametrize("fmt", ["csv", "json", "text", "avro", "no-such-format"])
def test_formats_that_cannot_hold_a_table_are_refused(spark, fmt):
    with pytest.raises(ValueError):
        check_format(spark, fmt)


def test_partitioned_write_counts_above_the_shuffle(spark, tmp_path, monkeypatch):
    """Rows observed below a shuffle are counted twice when a map task runs again."""
    df = spark.range(1000).selectExpr("id", "id % 3 as part")
    plans, write = [], type(df).write

    def seen(self):
        plans.append(self._jdf.queryExecution().optimizedPlan().toString())
        return write.fget(self)
    monkeypatch.setattr(type(df), "write", property(seen))
    assert write_counted(df, str(tmp_path / "t"), partition_by=["part"]) == 1000
    assert plans[0].index("CollectMetrics") < plans[0].index("RebalancePartitions")
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1000

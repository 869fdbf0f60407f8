"""Data-quality outputs as DataFrames (one job each, no driver loops over data)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.clean import dedupe, int_or_null, normalize_nulls, repeated_keys, same_keys
from ..operators.combine import spread_join
from ..sources.io import footer_counts
from ..sources.schemas import SPECS, TableSpec
from .silver import COMPACT_TABLES, FULL_TABLES
from .star import Star


def layer_row_counts(layers: dict[str, dict[str, DataFrame]]) -> DataFrame:
    """(layer, table_name, row_count) for every table, as one union of global counts."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
               .select(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"),
                       "row_count")
             for layer, tables in layers.items() for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def written_row_counts(spark: SparkSession, layers: dict[str, dict[str, str]], fmt: str = "parquet") -> DataFrame:
    """``layer_row_counts`` of written tables (layer -> table -> path), from file footers: no data is read."""
    paths = {(layer, name): path for layer, tables in layers.items() for name, path in tables.items()}
    names = {f"{layer}/{name}": (layer, name) for layer, name in paths}
    counts = footer_counts(spark, {key: paths[pair] for key, pair in names.items()}, fmt)
    return spark.createDataFrame([(*names[key], n) for key, n in counts.items()],
                                 "layer string, table_name string, row_count bigint")


def report_summary(status: DataFrame) -> DataFrame:
    """One row over ``report_status``: how many of the reports are there (``15 of 15``), missing or unreadable."""
    counts = status.agg(F.count(F.lit(1)).alias("reports"), *[
        F.count_if(F.col("status") == s).alias(s) for s in ("present", "missing", "failed")])
    return counts.withColumn("headline", F.concat_ws(" of ", F.col("present").cast("string"), F.col("reports").cast("string")))


def quality_metrics(star: Star) -> DataFrame:
    """Long-format (metric, value): valid birth dates, known positions, goal,
    assist and game totals.  A total over an empty table is NULL, not an error."""
    players = star.dim_player.agg(
        F.count_if(F.col("date_of_birth").isNotNull()).alias("players_with_valid_dob"),
        F.count_if(F.col("position") != "Unknown").alias("players_with_position"))
    appearances = star.fact_appearance if star.player_totals is None else star.player_totals
    facts = appearances.agg(F.sum("goals").cast("bigint").alias("total_goals"),
                            F.sum("assists").cast("bigint").alias("total_assists"))
    games = star.fact_game.agg(F.count(F.lit(1)).alias("total_games"))

    def longform(df: DataFrame) -> DataFrame:
        pairs = ", ".join(f"'{c}', `{c}`" for c in df.columns)
        return df.selectExpr(f"stack({len(df.columns)}, {pairs}) AS (metric, value)")

    return longform(players).unionByName(longform(facts)).unionByName(longform(games))


def conform_quality(raw, ed) -> DataFrame:
    """Per conformed table: rows in, duplicates dropped, rows rejected for a
    missing required key, rows out, and date texts that did not parse.

    Per table: one partial-aggregated group-by on the keys (when the table is
    de-duplicated) and one global sum, all tables in one union (no driver loop
    over data, no distinct-aggregate expansion).  Rejects are counted per key,
    which is exact because every spec's required columns are among its keys
    when it de-duplicates.
    """
    tables = COMPACT_TABLES if ed.name == "compact" else FULL_TABLES
    parts = []
    for t in tables:
        spec = SPECS[t]
        n = normalize_nulls(raw[t], ed.null_tokens)
        types = {f.name: f.dataType for f in n.schema.fields}
        missing = None
        for c in spec.required:
            p = F.col(c).isNull()
            missing = p if missing is None else missing | p
        missing = missing if missing is not None else F.lit(False)
        unparsed = F.lit(0)
        for c in spec.dates:
            if isinstance(types[c], T.StringType):
                unparsed = unparsed + (F.col(c).isNotNull() & F.try_to_date(c).isNull()).cast("int")
        if spec.dedupe:
            if not set(spec.required) <= set(spec.keys):
                raise ValueError(f"{t}: required columns must be keys to count rejects")
            # One row per key (the NULL key is one group, as in the dedupe),
            # combined map-side; then a global sum over those rows.
            per_key = n.groupBy(*spec.keys).agg(
                F.count(F.lit(1)).alias("c"), F.max(missing.cast("int")).alias("m"),
                F.sum(unparsed).alias("u"))
            agg = per_key.agg(F.sum("c").alias("rows_in"), F.count(F.lit(1)).alias("kept"),
                              F.sum("m").alias("rejected"), F.sum("u").alias("unparsed_dates"))
        else:
            agg = n.agg(F.count(F.lit(1)).alias("rows_in"), F.count(F.lit(1)).alias("kept"),
                        F.sum(missing.cast("int")).alias("rejected"),
                        F.sum(unparsed).alias("unparsed_dates"))
        rows_in = F.coalesce(F.col("rows_in"), F.lit(0))
        row = agg.select(
            F.lit(t).alias("table_name"), rows_in.cast("bigint").alias("rows_in"),
            (rows_in - F.col("kept")).cast("bigint").alias("duplicates_dropped"),
            F.coalesce(F.col("rejected"), F.lit(0)).cast("bigint").alias("rejected"),
            (F.col("kept") - F.coalesce(F.col("rejected"), F.lit(0))).cast("bigint")
            .alias("rows_out"),
            F.coalesce(F.col("unparsed_dates"), F.lit(0)).cast("bigint").alias("unparsed_dates"))
        parts.append(row)
    return reduce(DataFrame.unionByName, parts)


def _row_key(spec: TableSpec) -> Column:
    """The key columns as one text, NULL as ``\\N``."""
    return F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("\\N")) for k in spec.keys or spec.required])


def _duplicates(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The distinct rows that ``dedupe`` leaves out, with ``copies``: how many of each.

    Only rows of repeated keys are read in full.  They are counted as whole rows and compared with the
    survivor of their key, both combined before their shuffles; the join splits a hot key."""
    repeated = repeated_keys(rows, keys)
    again = rows.join(repeated, same_keys(rows, repeated, keys), "left_semi")
    hashed = F.xxhash64(*keys)
    packed = F.struct(*[c for c in rows.columns if c not in keys])
    each = again.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("__rows")).withColumn("__h", hashed)
    kept = again.groupBy(*keys).agg(F.min(packed).alias("__kept")).select(
        hashed.alias("__h"), "__kept", *[F.col(k).alias(f"__{k}") for k in keys])
    joined = spread_join(each, kept, "__h")
    joined = joined.filter(reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]))
    copies = F.col("__rows") - F.when(packed.eqNullSafe(F.col("__kept")), 1).otherwise(0)
    return joined.withColumn("copies", copies).filter("copies > 0").select(*rows.columns, "copies")


def conform_rejects(raw, ed) -> DataFrame:
    """(table_name, reason, column_name, row_key, cell, copies, record): what conforming does not pass on.

    ``duplicate``: rows beyond the survivor of their key (equal rows once, with their number in
    ``copies``); ``missing key``: rows without a required column, after de-duplication; ``unparsed``: texts that are no
    date or season, whose row is kept with NULL.  ``record`` is the row as JSON.  Per table, the rows
    that came in are those that went out, the copies of duplicates and those of missing keys."""
    parts = []
    for t in COMPACT_TABLES if ed.name == "compact" else FULL_TABLES:
        spec, rows = SPECS[t], normalize_nulls(raw[t], ed.null_tokens)
        columns, types = rows.columns, {f.name: f.dataType for f in rows.schema.fields}

        def listed(df: DataFrame, reason: str, column: Column, cell: Column, copies: Column) -> DataFrame:
            return df.select(F.lit(t).alias("table_name"), F.lit(reason).alias("reason"), column.alias("column_name"),
                             _row_key(spec).alias("row_key"), cell.alias("cell"), copies.cast("bigint").alias("copies"),
                             F.to_json(F.struct(*columns)).alias("record"))

        none = F.lit(None).cast("string")
        if spec.dedupe:
            parts.append(listed(_duplicates(rows, list(spec.keys)), "duplicate", none, none, F.col("copies")))
        if spec.required:
            lacking = rows.filter(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in spec.required]))
            lacking = dedupe(lacking, spec.keys) if spec.dedupe else lacking
            names = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in spec.required])
            parts.append(listed(lacking, "missing key", names, none, F.lit(1)))
        texts = {c: F.try_to_date(c) for c in spec.dates if isinstance(types[c], T.StringType)}
        if t == "games":
            texts["season"] = int_or_null(F.col("season"))
        for c, value in texts.items():
            parts.append(listed(rows.filter(F.col(c).isNotNull() & value.isNull()), "unparsed", F.lit(c), F.col(c), F.lit(1)))
    return reduce(DataFrame.unionByName, parts)

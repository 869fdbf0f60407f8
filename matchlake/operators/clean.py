"""Cleaning operators of the conformed (silver) layer.

Each builds a single projection or one aggregation, so Catalyst pushes later
filters through them.  Projections stay in whole-stage codegen; the de-duplicating
aggregate packs a row into a struct, which Spark runs as a sort aggregate.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text sentinels that mean "no value".  Matching is exact and
# case-sensitive, so 'nULL' or ' null ' are kept as real text.
NULL_TOKENS_STRICT = ("null", "NULL", "Null")
NULL_TOKENS = ("null", "NULL", "Null", "")


def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def normalize_nulls(df: DataFrame, tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Turn sentinel text into SQL NULL in every top-level string column.

    Written as one ``selectExpr`` (a single round trip to the JVM however wide
    the table); the plan is the same CASE/IN projection the Column API builds.
    """
    toks = ", ".join(_literal(t) for t in tokens)
    exprs = []
    for f in df.schema.fields:
        c = _ident(f.name)
        if isinstance(f.dataType, T.StringType) and tokens:
            exprs.append(f"CASE WHEN {c} IN ({toks}) THEN CAST(NULL AS STRING) ELSE {c} END AS {c}")
        else:
            exprs.append(c)
    return df.selectExpr(*exprs)


def _check_fill_value(name: str, dtype: T.DataType, value) -> None:
    numeric = isinstance(dtype, T.NumericType)
    if isinstance(value, bool):
        ok = isinstance(dtype, T.BooleanType)
    elif isinstance(value, (int, float)):
        ok = numeric
    elif isinstance(value, str):
        ok = isinstance(dtype, T.StringType)
    else:
        ok = False
    if not ok:
        raise TypeError(f"default {value!r} does not fit column {name} of type "
                        f"{dtype.simpleString()}")


def fill_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """``na.fill`` with a per-column dict, checked against the schema first.

    Unlike a bare ``na.fill`` a missing column or a value of the wrong kind
    (text into a number, a number into text) raises instead of being ignored
    or silently converted.
    """
    if not defaults:
        return df
    types = {f.name: f.dataType for f in df.schema.fields}
    for name, value in defaults.items():
        if name not in types:
            raise KeyError(f"fill_defaults: no column {name!r}")
        _check_fill_value(name, types[name], value)
    return df.na.fill(defaults)


def fill_numeric(df: DataFrame, value: int | float = 0,
                 subset: Iterable[str] | None = None) -> DataFrame:
    """Fill NULL numeric columns (all of them, group keys included, unless ``subset``)."""
    if subset is None:
        return df.na.fill(value)
    return df.na.fill(value, subset=list(subset))


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows lacking any of ``columns`` (NOT NULL filter pushed to the scan)."""
    if not columns:
        return df
    cond = None
    for c in columns:
        p = F.col(c).isNotNull()
        cond = p if cond is None else cond & p
    return df.filter(cond)


def dedupe(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None) -> DataFrame:
    """Keep one row per key: the first by ``order_by`` (default: all other columns).

    Ascending, NULLs first, column by column; remaining ties fall to the other
    columns, so the survivor does not depend on partitioning.  Written as
    ``groupBy(keys).agg(min(struct(...)))``: every task reduces its rows of a key to
    one before the shuffle, so a key holding a third of all rows sends one row per
    task.  (A ``row_number = 1`` window also cuts before its shuffle on recent
    Spark versions; there the cut is the optimizer's choice, here it is the plan.)
    NULL keys form one group, as with ``dropDuplicates``.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    order = [c for c in (order_by or rest) if c not in keys]
    tail = [c for c in rest if c not in order]
    packed = F.struct(*[F.col(c) for c in order + tail]).alias("_keep")
    picked = df.groupBy(*keys).agg(F.min(packed).alias("_keep"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_keep.{c}").alias(c)
                           for c in df.columns])


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Equality of ``keys`` on both sides, where NULL equals NULL."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"__{k}"]) for k in keys])


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of more than one row, as ``__<key>``: a hash aggregate that reads the keys alone."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows")).filter("__rows > 1")
    return counts.select(*[F.col(k).alias(f"__{k}") for k in keys])


def dedupe_sparse(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None) -> DataFrame:
    """The rows of ``dedupe``, for tables in which few keys repeat.

    Keys are counted first (a hash aggregate over the keys alone); rows of a key that occurs
    once pass as they are, without a sort, and without a shuffle where the repeated keys are small enough for
    a broadcast.  Only rows of repeated keys are compared column by column.  A reader that needs two
    columns reads two, and all columns of the repeated keys' rows.  The input is scanned three times, so
    it should be a stored table rather than a long plan."""
    keys = list(keys)
    if set(df.columns) == set(keys):
        return df.dropDuplicates(keys)
    repeated = repeated_keys(df, keys)
    alone = df.join(repeated, same_keys(df, repeated, keys), "left_anti")
    again = df.join(repeated, same_keys(df, repeated, keys), "left_semi")
    return alone.unionByName(dedupe(again, keys, order_by))


def to_date_safe(c: Column, dtype: T.DataType, strict: bool = False) -> Column:
    if isinstance(dtype, (T.DateType,)):
        return c
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.to_date(c)
    return F.to_date(c) if strict else F.try_to_date(c)


def conform_dates(df: DataFrame, columns: Sequence[str], strict: bool = False) -> DataFrame:
    """Conform text/timestamp columns to DATE under the same name.

    Malformed text becomes NULL (``try_to_date``); ``strict=True`` keeps the
    ANSI behaviour of raising on it.  Timestamps lose their time of day.
    """
    if not columns:
        return df
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({c: to_date_safe(F.col(c), types[c], strict) for c in columns})


def int_or_null(c: Column) -> Column:
    """Text to INT, NULL where it does not parse (``'2012/13'``), ANSI-safe."""
    return c.try_cast("int")

"""Measured table statistics, and joins that are planned by them.

Spark takes the size of a file for the size of its rows: a compressed table of a few megabytes
may hold gigabytes, and is then broadcast; a table cut down by filters or an aggregate is taken for
large.  ``measure`` counts rows, bytes in memory and distinct keys in one aggregate; they are kept
beside the table and read by the joins here instead of the estimate.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.combine import spread_join
from ..sources.io import write_table

MOST_BROADCAST_BYTES = 64 << 20
_FIXED = 8             # bytes of a slot in a row
_VARIABLE = (T.StringType, T.BinaryType)


@dataclass(frozen=True)
class TableStats:
    """Rows, bytes that they take in memory, and about how many distinct values the keys have."""

    rows: int
    bytes: int
    distinct: dict[str, int] = field(default_factory=dict)


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row in Spark's row format: a slot per column, and the contents of texts."""
    width = F.lit(_FIXED * (len(df.columns) + 1)).cast("bigint")
    for f in df.schema.fields:
        if isinstance(f.dataType, _VARIABLE):
            width = width + F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0))
        elif isinstance(f.dataType, T.ArrayType):
            width = width + _FIXED * F.greatest(F.coalesce(F.size(F.col(f"`{f.name}`")), F.lit(0)), F.lit(0))
    return width


def measure(df: DataFrame, keys: Sequence[str] = ()) -> TableStats:
    """One pass, combined in every task; distinct keys are estimated (5 %) from sketches."""
    row = df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("bytes"),
                 *[F.approx_count_distinct(k).alias(f"d{i}") for i, k in enumerate(keys)]).first()
    return TableStats(row["rows"], int(row["bytes"]), {k: row[f"d{i}"] for i, k in enumerate(keys)})


def store_stats(spark: SparkSession, path: str, stats: dict[str, TableStats]) -> None:
    """Statistics of several tables as one small table."""
    rows = [(name, json.dumps(asdict(s))) for name, s in stats.items()]
    write_table(spark.createDataFrame(rows, "table_name string, stats string").coalesce(1), path)


def load_stats(spark: SparkSession, path: str) -> dict[str, TableStats]:
    return {r["table_name"]: TableStats(**json.loads(r["stats"])) for r in spark.read.parquet(path).collect()}  # one row a table


def join_by_stats(left: DataFrame, right: DataFrame, on: str | Sequence[str], right_stats: TableStats,
                  how: str = "inner", limit: int = MOST_BROADCAST_BYTES) -> DataFrame:
    """``left.join(right, on, how)``: the right side is broadcast if it was measured to fit, whatever its files
    weigh, and else shuffled and merged, with hot keys split (``spread_join``)."""
    if right_stats.bytes <= limit:
        return left.join(F.broadcast(right), on, how)
    return spread_join(left, right.hint("merge"), on, how)


@dataclass(frozen=True)
class Dimension:
    """A table to join to a fact: its key column is named as in the fact."""

    df: DataFrame
    key: str
    stats: TableStats
    how: str = "inner"


def kept_share(fact: TableStats, dim: Dimension) -> float:
    """About which part of the fact's rows a join keeps."""
    if dim.how not in ("inner", "left_semi", "leftsemi", "semi"):
        return 1.0
    known = fact.distinct.get(dim.key) or dim.stats.rows
    return min(1.0, dim.stats.distinct.get(dim.key, dim.stats.rows) / max(1, known))


def star_join(fact: DataFrame, fact_stats: TableStats, dimensions: Sequence[Dimension],
              limit: int = MOST_BROADCAST_BYTES) -> DataFrame:
    """The fact with all dimensions: first those that are broadcast and keep the fewest rows, last those whose
    join shuffles the fact.  Rows and columns do not depend on the order."""
    columns = list(fact.columns) + [c for d in dimensions for c in d.df.columns
                                    if c != d.key and "semi" not in d.how and c not in fact.columns]
    out = fact
    for d in sorted(dimensions, key=lambda d: (d.stats.bytes > limit, kept_share(fact_stats, d), d.stats.bytes)):
        out = join_by_stats(out, d.df, d.key, d.stats, d.how, limit)
    return out.select(columns)

"""Tables clustered by a key: joins and aggregates on that key need no exchange.

A bucketed table is an external table of the session catalog: its rows are dealt to a fixed number of
files by a hash of the key, and the number and key are known to the planner.  Path-based
tables cannot carry that, so ``write_bucketed`` writes them beside the files and ``read_bucketed``
registers the table for as long as it takes to resolve it; nothing stays in the catalog, and any session
that can read the folder can use it.

When to use it: the same large tables are joined on one key again and again, and no key is
hot.  A bucket is read by one task, so a key with a third of all rows makes one long task, which AQE cannot
split; for such tables the plain layers with ``spread_join`` are the better form.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..sources.io import remove_path
from .edition import Edition
from .star import fact_appearance
from .totals import player_totals

BUCKET_BYTES = 256 << 20
_SPEC = "_buckets.json"


def bucket_count(size: int, target: int = BUCKET_BYTES) -> int:
    """Buckets for a table of ``size`` bytes: a power of two, so that tables of different sizes still fit
    each other (the planner joins n and 2n buckets without moving the smaller side)."""
    n = 1
    while n * target < size:
        n *= 2
    return n


def write_bucketed(df: DataFrame, path: str, by: Sequence[str], buckets: int, fmt: str = "parquet") -> DataFrame:
    """Write ``df`` clustered and sorted by ``by``, one file a bucket, and return it read back."""
    spark = df.sparkSession
    name = f"matchlake_{uuid.uuid4().hex}"
    remove_path(spark, path)
    try:
        (df.repartition(buckets, *by).write.format(fmt).bucketBy(buckets, *by).sortBy(*by)
         .option("path", path).saveAsTable(name))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # external: the files stay
    spec = {"schema": df.schema.json(), "by": list(by), "buckets": buckets, "format": fmt}
    _file(spark, path, write=json.dumps(spec))
    return read_bucketed(spark, path)


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """A table of ``write_bucketed``, with its clustering known to the planner."""
    spec = json.loads(_file(spark, path))
    schema = T.StructType.fromJson(json.loads(spec["schema"]))
    quoted = lambda names: ", ".join(f"`{n}`" for n in names)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    name = f"matchlake_{uuid.uuid4().hex}"
    location = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING {spec['format']} CLUSTERED BY ({quoted(spec['by'])}) "
              f"SORTED BY ({quoted(spec['by'])}) INTO {spec['buckets']} BUCKETS LOCATION '{location}'")
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def _file(spark: SparkSession, path: str, write: str | None = None) -> str:
    """The description beside the files (a few hundred bytes), on any Hadoop file system."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop
    where = hadoop.fs.Path(f"{path}/{_SPEC}")
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if write is not None:
        out = fs.create(where, True)
        out.write(bytearray(write.encode()))
        out.close()
        return write
    stream = fs.open(where)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def appearance_fact(silver, base: str, ed: Edition, buckets: int) -> DataFrame:
    """The appearance fact from conformed tables bucketed by game, itself bucketed by player.

    The merge join of appearances and games reads both tables bucket by bucket; the only
    shuffles are those that write the buckets."""
    appearances = write_bucketed(silver["appearances"], f"{base}/appearances", ["game_id"], buckets)
    games = write_bucketed(silver["games"], f"{base}/games", ["game_id"], buckets)
    fact = fact_appearance(appearances, games, ed, spread=False)
    return write_bucketed(fact, f"{base}/fact_appearance", ["player_key"], buckets)


def totals(fact: DataFrame) -> DataFrame:
    """Per-player totals of a fact bucketed by player: every group lies in one bucket, so nothing is exchanged."""
    return player_totals(fact)

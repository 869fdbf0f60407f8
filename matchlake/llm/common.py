"""Small helpers that the operators of this folder share."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import remove_scratch, scratch_path

_PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_shipped: set[str] = set()

# White space that separates words: space, tab, line feed, vertical tab, form feed, return.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_made: ContextVar[list[str] | None] = ContextVar("_made", default=None)


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[None]:
    """Scratch tables that ``stored`` makes inside go when it ends: what reads them must have been
    ``written`` by then."""
    paths: list[str] = []
    before = _made.set(paths)
    try:
        yield
    finally:
        _made.reset(before)
        for path in paths:
            remove_scratch(spark, path)


def written(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` and read it back."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch(spark: SparkSession, name: str) -> str:
    """A scratch folder, which goes with those of ``stored``."""
    path = scratch_path(spark, name)
    if (paths := _made.get()) is not None:
        paths.append(path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a scratch table and read it back: lineage ends there, and
    lost executors cost no recomputation of what led to it."""
    return written(df, scratch(df.sparkSession, name))


def path_exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """Words between white space, as an array."""
    return F.filter(F.split(text, SPACES), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application, so that a job
    also runs where it was put on no worker's path."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    path = os.path.join(tempfile.mkdtemp(prefix="matchlake-code-"), "matchlake.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(_PACKAGE):
            for name in names:
                if name.endswith(".py"):
                    file = os.path.join(folder, name)
                    out.write(file, os.path.relpath(file, os.path.dirname(_PACKAGE)))
    context.addPyFile(path)
    _shipped.add(context.applicationId)

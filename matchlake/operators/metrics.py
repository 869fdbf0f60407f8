"""Aggregate building blocks and deterministic top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def count_where(pred: Column) -> Column:
    """Number of rows where ``pred`` holds (NULL counts as false)."""
    return F.sum(F.when(pred, 1).otherwise(0))


def sum_where(pred: Column, value) -> Column:
    """Sum of ``value`` over rows where ``pred`` holds, 0 elsewhere."""
    return F.sum(F.when(pred, _c(value)).otherwise(0))


def ratio(num, den, scale: float | None = None, digits: int | None = None,
          guard: bool = False) -> Column:
    """``num / den`` (optionally ``* scale`` and rounded half-up).

    Division by zero gives NULL (``try_divide``) instead of an ANSI error.
    ``guard=True`` also returns NULL when ``den <= 0``.
    """
    n, d = _c(num), _c(den)
    q = F.try_divide(n.cast("double"), d.cast("double"))
    if guard:
        q = F.when(d > 0, q)
    if scale is not None:
        q = q * F.lit(float(scale))
    if digits is not None:
        q = F.round(q, digits)
    return q


def top_k(df: DataFrame, k: int, order: Sequence[Column], tie: Sequence[str] = ()) -> DataFrame:
    """First ``k`` rows by ``order``, ties broken by the ``tie`` columns ascending.

    Planned as ``TakeOrderedAndProject``: each task keeps its own best k and
    only those reach the final merge, so no full sort or range shuffle.
    """
    return df.orderBy(*order, *[F.col(t).asc_nulls_last() for t in tie]).limit(k)


MOST_BROADCAST = 10_000  # rows of a top-k that are broadcast


def top_k_late(stats: DataFrame, dim: DataFrame, key: str, k: int, order: Sequence[Column],
               columns: Sequence[str]) -> DataFrame:
    """First ``k`` rows of ``stats`` whose ``key`` (unique on both sides) is in ``dim``, with ``columns`` of either.

    The cut is made on statistics alone: the key is proven to exist by a semi join on ``dim``'s
    keys, the k rows are taken, and only then are attributes fetched, for those k keys.  While k is at
    most ``MOST_BROADCAST`` the k rows are broadcast, and the semi join against them goes below
    whatever builds ``dim`` (its de-duplicating aggregate), so no row of ``dim`` beyond them is
    shuffled; above that both joins are left to Spark.  Same rows and order as joining all of
    ``dim`` first and cutting then."""
    top = top_k(stats.join(dim.select(key), key, "left_semi"), k, order, tie=[key])
    wanted = dim.select(key, *[c for c in columns if c != key and c not in stats.columns])
    if k <= MOST_BROADCAST:
        wanted = wanted.join(F.broadcast(top.select(key)), key, "left_semi")
        top = F.broadcast(top)
    return top_k(wanted.join(top, key), k, order, tie=[key]).select(*columns)

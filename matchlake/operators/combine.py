"""Equi-joins that AQE can split, and the conflict-resolving "merge join"."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SIDE_ONLY = {"left_semi", "leftsemi", "semi", "left_anti", "leftanti", "anti"}
_RIGHT = {"right", "rightouter", "right_outer"}
_FULL = {"full", "fullouter", "full_outer", "outer"}

_SPREAD = "__spread"
_BUCKETS = 1 << 20


def spread_join(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner") -> DataFrame:
    """``left.join(right, on, how)`` whose hot keys AQE can split.

    A join input that keeps the partitioning of an aggregate (a de-duplicated
    table in the same plan) has no exchange of its own, and AQE then leaves a key
    that holds a third of all rows in one task.  A second join key, a hash of the
    first on both sides, is no partitioning that an aggregate provides: both inputs
    get an exchange and a partition above the skew threshold is read by several
    tasks, for any number of hot keys.  Where one side is small enough for a
    broadcast nothing is exchanged at all.  Keys of different types are joined
    plainly, since equal values of them may hash differently.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if any(left.schema[k].dataType != right.schema[k].dataType for k in keys):
        return left.join(right, keys, how)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(_BUCKETS))
    joined = left.withColumn(_SPREAD, bucket).join(right.withColumn(_SPREAD, bucket), [*keys, _SPREAD], how)
    return joined.drop(_SPREAD)


def merge_join(left: DataFrame, right: DataFrame, on: str | Sequence[str],
               how: str = "inner", spread: bool = True) -> DataFrame:
    """Join on same-named keys and resolve name clashes.

    Output columns, in this order: the keys once; every left column in left
    order, where a column also present on the right becomes
    ``coalesce(left, right)``; then right-only columns in right order.  For
    outer joins that keep right-only rows the key is ``coalesce(l.k, r.k)``, so
    those rows keep their key.  Semi and anti joins return the left columns.

    Hot keys of the left side are split (see ``spread_join``).  A right or full
    join cannot be split on that side as it is, so it is written as the inner or left
    join and the right rows whose key the left lacks.  ``spread=False`` joins on the keys alone, which
    tables clustered by them need to be joined without an exchange.
    """
    keys = [on] if isinstance(on, str) else list(on)
    how_n = how.lower()
    if how_n in _SIDE_ONLY:
        return left.join(right.select(*keys), keys, how_n)
    missing = [k for k in keys if k not in left.columns or k not in right.columns]
    if missing:
        raise KeyError(f"merge_join: key(s) {missing} missing on one side")
    main = "inner" if how_n in _RIGHT else "left" if how_n in _FULL else how_n
    renamed = right.withColumnsRenamed({c: f"__r_{c}" for c in right.columns if c not in keys})
    joined = spread_join(left, renamed, keys, main) if spread else left.join(renamed, keys, main)
    out = _merge_select(joined, left, right, keys)
    if how_n not in _RIGHT | _FULL:
        return out
    # The distinct keys of the left are combined before their shuffle, so none is hot.
    alone = right.join(left.select(*keys).distinct(), keys, "left_anti")
    types = {f.name: f.dataType for f in out.schema.fields}
    alone = alone.select(*[(F.col(c) if c in right.columns else F.lit(None)).cast(types[c]).alias(c) for c in out.columns])
    return out.unionByName(alone)


def _merge_select(joined: DataFrame, left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    out = [F.col(k) for k in keys]
    for c in left.columns:
        if c not in keys:
            out.append(F.coalesce(F.col(c), F.col(f"__r_{c}")).alias(c) if c in right.columns else F.col(c))
    out += [F.col(f"__r_{c}").alias(c) for c in right.columns if c not in keys and c not in left.columns]
    return joined.select(out)

"""Mixing sources to target weights by systematic sampling.

Targets: sources by code point (null last) weigh 3, 1, 2, repeating, and share
``1.5 *`` all words; a target stops at ``2 *`` its source's words and the excess
goes to the others by weight.  Every document of a source expects
``rate = target / source words`` copies (at most 2).  Along the source's order
the expected copies are summed up, one random offset per source is added, and a
document is emitted once per integer the sum crosses.

The order within a source is (leading two digits and number of digits of the
size, md5 of doc_id, doc_id): neighbours are of like size, so each size class
gets its share of copies and the words taken come near the target.

Prefix sums at scale: a row's position is the sum of three offsets, of its size
class in the source, of its md5 bucket in the class, and its place in the bucket.
Windows only ever hold one bucket, the buckets of one class or the classes of
one source, so a source with a third of all rows (or one text copied that often)
spreads over as many tasks as it has buckets.  Sources are few enough for one
task to rank (one row per source); no document passes through it.

Defined cases: null text has size 0, is in the order like any other and takes 0;
a null source is a source; rows that share doc_id are told apart only by their
place; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import text_of, word_count

# Fixed values of the mix.
WEIGHTS = (3, 1, 2)
BUDGET = 1.5
MOST = 2
SEED = "mix-1"
ROWS_PER_BUCKET = 100_000

SOURCE, CLASS, BUCKET = "__source", "__class", "__bucket"


def source_targets(sizes: DataFrame) -> DataFrame:
    """Target of each source, from rows (``__source``, ``__size``).

    Water filling without iteration: by rising size / weight, a source is at its
    cap exactly if the share it would get of what the sources before it leave is
    above the cap."""
    one = sizes.groupBy(SOURCE).agg(F.sum("__size").alias("source_size"))
    rank = F.row_number().over(W.orderBy(F.col(SOURCE).asc_nulls_last()))
    one = one.withColumn("__weight", F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]),
                                                  ((rank - 1) % len(WEIGHTS) + 1).cast("int")).cast("long"))
    upto = W.orderBy((F.col("source_size") / F.col("__weight")).asc(), F.col(SOURCE).asc_nulls_last())
    before = upto.rowsBetween(W.unboundedPreceding, -1)
    after = upto.rowsBetween(0, W.unboundedFollowing)
    everything = W.partitionBy()
    left = F.lit(BUDGET) * F.sum("source_size").over(everything) - F.coalesce(
        F.sum(F.lit(MOST) * F.col("source_size")).over(before), F.lit(0))
    one = one.withColumns({"__left": left, "__weights": F.sum("__weight").over(after)})
    one = one.withColumn("__capped", F.col("__weight") * F.col("__left") / F.col("__weights") > MOST * F.col("source_size"))
    rest = F.lit(BUDGET) * F.sum("source_size").over(everything) - F.sum(
        F.when(F.col("__capped"), MOST * F.col("source_size")).otherwise(0)).over(everything)
    weights = F.sum(F.when(F.col("__capped"), 0).otherwise(F.col("__weight"))).over(everything)
    target = F.when(F.col("__capped"), (MOST * F.col("source_size")).cast("double")).otherwise(
        F.col("__weight") * rest / weights)
    return one.withColumn("target", target.cast("double")).select(SOURCE, "source_size", "target")


def offset_of(source: Column) -> Column:
    """In [0, 1), from the seed and the source."""
    name = F.concat(F.lit(SEED + ":"), F.coalesce(source, F.lit("(null)")))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(float(2 ** 32))


def mix(docs: DataFrame, carry: list[str]) -> DataFrame:
    """Rows of ``docs`` with ``size``, ``source_size``, ``target``, ``__copies``
    (0, 1 or 2) and the ``carry`` columns under ``__c<i>``."""
    digits = F.length(F.col("__size").cast("string"))
    rows = docs.select(*[F.col(f"`{c}`").alias(f"__c{i}") for i, c in enumerate(carry)],
                       F.col("doc_id").alias("__id"), F.col("source").cast("string").alias(SOURCE),
                       word_count(text_of()).alias("__size"))
    rows = rows.withColumns({
        CLASS: F.concat(F.lpad(digits.cast("string"), 2, "0"), F.substring(F.col("__size").cast("string"), 1, 2)),
        "__md5": F.md5(F.coalesce(F.col("__id").cast("string"), F.lit("")).cast("binary"))})
    # Two hex digits (256 buckets a class), one more for each 16 times as many rows beyond.
    total = docs.count()
    prefix = max(2, math.ceil(math.log(max(1, total / ROWS_PER_BUCKET), 16)))
    rows = rows.withColumn(BUCKET, F.substring("__md5", 1, prefix))

    keys = [SOURCE, CLASS, BUCKET]
    buckets = rows.groupBy(*keys).agg(F.count("*").alias("__n"), F.sum("__size").alias("__size"))
    classes = buckets.groupBy(SOURCE, CLASS).agg(F.sum("__n").alias("__n"))
    targets = source_targets(buckets)

    def before(*by):
        return W.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(W.unboundedPreceding, -1)

    place = lambda *by: F.coalesce(F.sum("__n").over(before(*by)), F.lit(0))
    classes = classes.withColumn("__class_at", place(SOURCE, CLASS)).drop("__n")
    buckets = buckets.withColumn("__bucket_at", place(SOURCE, CLASS, BUCKET)).drop("__n", "__size")

    def joined(left, right, on):
        right = right.select(*[F.col(k).alias(f"{k}_r") for k in on], *[c for c in right.columns if c not in on])
        same = F.lit(True)
        for k in on:
            same = same & F.col(k).eqNullSafe(F.col(f"{k}_r"))
        return left.join(right, same).drop(*[f"{k}_r" for k in on])

    classes = joined(classes, targets, [SOURCE])
    buckets = joined(buckets, classes, [SOURCE, CLASS])
    in_bucket = W.partitionBy(*keys).orderBy("__md5", "__id")
    rows = rows.withColumn("__at", F.row_number().over(in_bucket))
    rows = joined(rows, buckets, keys)
    at = F.col("__class_at") + F.col("__bucket_at") + F.col("__at")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    start = offset_of(F.col(SOURCE))
    copies = F.floor(start + at * rate) - F.floor(start + (at - 1) * rate)
    return rows.withColumn("__copies", F.least(F.lit(MOST), copies).cast("long")).select(
        *[f"__c{i}" for i in range(len(carry))], F.col("__size").alias("size"), "source_size", "target", "__copies")


def emit(docs: DataFrame) -> DataFrame:
    """The mixed corpus: each row of ``docs`` as often as it is taken."""
    df = mix(docs, docs.columns).filter("__copies > 0")
    df = df.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
    return df.select(*[F.col(f"__c{i}").alias(c) for i, c in enumerate(docs.columns)])


def report(docs: DataFrame) -> DataFrame:
    df = mix(docs, ["doc_id", "source"])
    return df.select(F.col("__c0").alias("doc_id"), "size", "source_size", "target",
                     (F.col("__copies") * F.col("size")).alias("taken"), F.col("__c1").alias("source"))

"""Sharding by sampled splitters, under the law ``bytes``: shard sizes are near equal.

1. Draw keys (crc32 of the text) with probability in proportion to the size; the
   sample has about ``SAMPLE`` keys whatever the size of the corpus.
2. Quantiles of the sample are the splitters of ``RANGES`` key ranges.
3. An aggregate gives the exact bytes of each range.  A range above twice the unit (a ``RANGES``th
   of all bytes, at most ``CELL_BYTES``) is cut into equal intervals of its keys, which crc32 spreads evenly.
   Only keys that alone are above the unit (a text copied very often, which no splitter can divide) are
   dealt by a hash of doc_id into cells of their own; the other keys of their interval lie
   before and after them, so equal texts below that size share a cell, and cells are in key order at any size.
4. Cells in key order have exact byte and row offsets; a window inside each cell
   gives every row its position in the whole order, and so its shard: the byte
   position of its middle, in 24ths of all bytes.  Equal texts of one cell go
   together by the middle of their group while the group is under 1 % of a shard;
   larger groups are divided row by row.

The order is (range, interval, cell, crc32, doc_id); ``slot`` is the row's place in it less
that of the shard's first row.  The largest window is one cell.  The offsets of cells
are summed in one task (a row per 128 MB of input, or per range while that is more) and
broadcast while they are at most ``MOST_BROADCAST``.  Statistics are taken from a stored
table of keys and sizes; the rows themselves are shuffled once.

A row repeated with its doc_id and text is no key that can be dealt: all its copies share one cell.

Defined cases: null text has no bytes (size 8, crc32 0); repeated rows are rows of
their own; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import stored

SHARDS = 24
SAMPLE = 20_000        # expected size of the key sample
RANGES = 480           # key ranges before subdivision
CELL_BYTES = 128 << 20  # of a cell, the unit that one task sorts
MOST_BROADCAST = 50_000  # cells
GROUP_SHARE = 0.01     # a group of equal texts under this part of a shard stays whole
ROW_BYTES = 8          # counted for each row besides its text
CELL = ["__range", "__part", "__cell"]
KEYS = 1 << 32         # crc32


def sized(docs: DataFrame, carry: list[str]) -> DataFrame:
    raw = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    return docs.select(*[F.col(f"`{c}`").alias(f"__c{i}") for i, c in enumerate(carry)],
                       F.col("doc_id").alias("__id"), (F.octet_length(raw) + ROW_BYTES).cast("long").alias("__size"),
                       F.crc32(raw).alias("__crc"))


def splitters(keys: DataFrame, total: int) -> list[int]:
    """Quantile boundaries of a size-weighted sample of the keys."""
    draw = F.pmod(F.xxhash64("__id", "__crc", "__size"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    drawn = keys.filter(draw < F.col("__size") * F.lit(SAMPLE / max(total, 1)))
    drawn = sorted(map(tuple, drawn.groupBy("__crc").count().collect()))  # about SAMPLE at most, by its rate
    n, seen, cuts = sum(c for _, c in drawn), 0, set()
    for key, count in drawn:
        # The ranks n * i // RANGES that fall on this key.
        first = max(1, -(-seen * RANGES // n))
        if first < RANGES and n * first // RANGES < seen + count:
            cuts.add(key)
        seen += count
    return sorted(cuts)


def with_range(rows: DataFrame, cuts: list[int]) -> DataFrame:
    """``__range``: the number of splitters at or below the key."""
    at = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col("__crc"))) if cuts else F.lit(0)
    return rows.withColumn("__range", at)


def with_part(rows: DataFrame, cuts: list[int], parts: dict[int, int]) -> DataFrame:
    """``__part``: which of the equal intervals of its range holds the key, in a range that has several."""
    part = F.lit(0)
    if parts:
        bounds = [0, *cuts, KEYS]
        known = F.create_map(*[x for r, n in sorted(parts.items()) for x in (
            F.lit(r), F.struct(F.lit(bounds[r]).cast("long").alias("low"), F.lit(bounds[r + 1]).cast("long").alias("high"),
                               F.lit(n).cast("long").alias("n")))])
        at = F.element_at(known, F.col("__range"))
        inside = F.floor((F.col("__crc") - at["low"]).cast("double") / (at["high"] - at["low"]) * at["n"]).cast("long")
        part = F.coalesce(F.least(inside, at["n"] - 1), F.lit(0))
    return rows.withColumn("__part", part.cast("long"))


HOT = "array<struct<crc: bigint, n: bigint>>"


def with_cell(rows: DataFrame, hot: DataFrame | None) -> DataFrame:
    """``__cell`` of a row within its interval: 0 before the first overfull key, 1 to n for the rows of that key by
    doc_id, n + 1 for the keys up to the next one, and so on.  ``hot``: (range, part, overfull keys)."""
    if hot is None:
        return rows.withColumn("__cell", F.lit(0).cast("long"))
    rows = rows.join(hot, ["__range", "__part"], "left").withColumn("__hot", F.coalesce("__hot", F.array().cast(HOT)))
    below = F.aggregate(F.filter("__hot", lambda h: h["crc"] < F.col("__crc")), F.lit(0).cast("long"),
                        lambda n, h: n + h["n"] + 1)
    mine = F.get(F.filter("__hot", lambda h: h["crc"] == F.col("__crc")), F.lit(0))["n"]
    dealt = F.coalesce(F.pmod(F.xxhash64(F.lit("cell"), "__id"), mine) + 1, F.lit(0).cast("long"))
    return rows.withColumn("__cell", below + dealt).drop("__hot")


class Layout:
    """What the statistics fix: total, splitters, subdivisions, offsets of cells."""

    def __init__(self, docs: DataFrame, shards: int = SHARDS):
        keys = stored(sized(docs, []), "shard-keys")
        self.shards = shards
        self.total = keys.agg(F.coalesce(F.sum("__size"), F.lit(0))).first()[0]
        self.cuts = splitters(keys, self.total)
        unit = max(1, min(self.total // RANGES, CELL_BYTES))
        ranges = with_range(keys, self.cuts).groupBy("__range").agg(F.sum("__size").alias("b")).collect()  # RANGES at most
        self.parts = {r["__range"]: -(-r["b"] // unit) for r in ranges if r["b"] > 2 * unit}
        self.hot = self._overfull(keys, unit)
        cells = self._celled(keys).groupBy(*CELL).agg(F.sum("__size").alias("__b"), F.count("*").alias("__n"))
        before = W.orderBy(*CELL).rowsBetween(W.unboundedPreceding, -1)
        cells = cells.select(*CELL, F.coalesce(F.sum("__b").over(before), F.lit(0)).alias("__cell_b"),
                             F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__cell_n"))
        cells = stored(cells, "shard-cells")
        self.cells = F.broadcast(cells) if cells.count() <= MOST_BROADCAST else cells
        first = self._placed(keys).groupBy("__shard").agg(F.min("__at").alias("at")).collect()  # one row per shard
        self.first = {r["__shard"]: r["at"] for r in first}

    def _overfull(self, keys: DataFrame, unit: int) -> DataFrame | None:
        """Keys above ``unit`` (fewer than ``total / unit``) with the number of their cells, by interval.  Keys are
        counted singly only in the intervals above it, and in the map tasks first."""
        if not self.parts:
            return None
        keys = with_part(with_range(keys, self.cuts), self.cuts, self.parts)
        of = ["__range", "__part"]
        full = keys.groupBy(*of).agg(F.sum("__size").alias("__b")).filter(F.col("__b") > unit).select(*of)
        full = stored(full, "shard-full")
        few = full.count()
        if not few:
            return None
        full = F.broadcast(full) if few <= MOST_BROADCAST else full
        each = keys.join(full, of, "left_semi").groupBy(*of, "__crc").agg(
            F.sum("__size").alias("__b"), F.count("*").alias("__n")).filter(f"__b > {unit} and __n > 1")
        hot = each.groupBy(*of).agg(F.sort_array(F.collect_list(F.struct(
            F.col("__crc").cast("long").alias("crc"), F.ceil(F.col("__b") / unit).cast("long").alias("n")))).cast(HOT).alias("__hot"))
        hot = stored(hot, "shard-hot")
        n = hot.count()
        return None if not n else F.broadcast(hot) if n <= MOST_BROADCAST else hot

    def _celled(self, rows: DataFrame) -> DataFrame:
        return with_cell(with_part(with_range(rows, self.cuts), self.cuts, self.parts), self.hot)

    def _placed(self, rows: DataFrame) -> DataFrame:
        """Adds ``__shard`` and ``__at``, the place in the whole order."""
        rows = self._celled(rows).join(self.cells, CELL)
        order = W.partitionBy(*CELL).orderBy("__crc", "__id", "__size")
        peers = W.partitionBy(*CELL).orderBy("__crc").rangeBetween(W.unboundedPreceding, W.currentRow)
        rows = rows.withColumns({
            "__rank": F.row_number().over(order),
            "__end": F.sum("__size").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)),
            "__group_end": F.sum("__size").over(peers)})
        rows = rows.withColumn("__group", F.sum("__size").over(W.partitionBy(*CELL, "__crc")))
        # Twice the middle of the group or of the row, so that it is a whole number.
        whole = F.col("__group") <= F.lit(GROUP_SHARE * self.total / self.shards)
        middle = 2 * F.col("__cell_b") + F.when(whole, 2 * F.col("__group_end") - F.col("__group")).otherwise(
            2 * F.col("__end") - F.col("__size"))
        rows = rows.withColumns({"__middle": middle, "__at": F.col("__cell_n") + F.col("__rank") - 1})
        return rows.withColumn("__shard", F.expr(
            f"cast(least({self.shards - 1}, __middle * {self.shards} div {2 * max(self.total, 1)}) as int)"))

    def place(self, docs: DataFrame, carry: list[str]) -> DataFrame:
        """Every row of ``docs``: ``carry`` columns under ``__c<i>``, size, text_crc32, shard, slot."""
        rows = self._placed(sized(docs, carry))
        first = F.create_map(*[F.lit(x) for item in sorted(self.first.items()) for x in item]) if self.first else None
        slot = F.col("__at") - F.element_at(first, F.col("__shard")) if self.first else F.lit(0)
        return rows.select(*[f"__c{i}" for i in range(len(carry))], F.col("__size").alias("size"),
                           F.col("__crc").alias("text_crc32"), F.lit("bytes").alias("law"),
                           F.col("__shard").alias("shard"), slot.cast("long").alias("slot"),
                           F.lit(None).cast("int").alias("grown_shard"))


def report(docs: DataFrame) -> DataFrame:
    return Layout(docs).place(docs, ["doc_id"]).withColumnRenamed("__c0", "doc_id")


def sharded(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with their ``shard`` and ``slot`` (an input column of
    one of these names gives way to them)."""
    carry = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    df = Layout(docs).place(docs, carry)
    return df.select(*[F.col(f"__c{i}").alias(c) for i, c in enumerate(carry)], "shard", "slot")

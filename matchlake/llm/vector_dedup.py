"""Near-duplicate vectors by int8 tile products with rigorous error bounds.

Vectors whose cosine is at least a threshold link.  A unit vector x is held as
``s * q + e``: int8 codes q, a scale s, and the norm of the remainder e, which is measured, not
estimated.  For two vectors

    | x . y  -  s_x s_y (q_x . q_y) |  <=  e_x + e_y + e_x e_y ,

so the product of codes tells most pairs apart: below the threshold less the bound there is no
link, at or above the threshold plus the bound there is one.  Only pairs in between are
recomputed from the given components in double precision.

1. Equal vectors are one class (two 64-bit hashes of the components); a class is compared once,
   with its number of rows as weight, so copies never meet in pairs.
2. Some classes are pivots (those of the least hash, about one for each ``TILE`` classes and
   at most ``MOST_PIVOTS``, which bounds what is broadcast); every class belongs to the cell of its
   nearest pivot, and a cell is dealt into tiles of about ``TILE`` classes.
3. A class is sent to every other tile of its own cell, and to the tiles of those cells that
   hold a vector within reach: neither the bisector of the two pivots nor the cell's
   largest angle rules it out.  Both tests follow from the triangle inequality, so no link is lost.
4. One task compares one pair of tiles, block by block.  It returns a sum of weights per class and
   the links of a spanning forest, never all pairs: both are linear in the tiles.
5. Sums give ``n_links``; connected components of the forests give ``component_id``.

Codes are multiplied as float32, in which a sum of products below 2^24 is exact; longer vectors
are multiplied in slices.  The work on vectors in no way clustered grows with the square of their number (the
cells then rule out little); in clustered ones with the pairs of neighbouring cells.

Defined cases: null vectors, those of length zero, of norm zero, or with a null or
non-finite component link with nothing; vectors of different lengths never link; a null id
never names a component unless all in it are null; repeated rows are vectors of their own;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.combine import spread_join
from .common import ship, stored
from .ngram_join import components

THRESHOLD = 0.95
TILE = 8_192          # classes of a tile, about
MOST_PIVOTS = 512
BLOCK = 2_048         # rows of a product of codes
SLACK = 1e-9          # above any rounding error of the bounds
MOST_TASKS = 50_000
EXACT = 1 << 24       # integers that float32 holds
_STEPS = 127


# ---------------------------------------------------------------- codes and products

def scaled(rows: np.ndarray) -> np.ndarray:
    """Rows divided by a power of two (exactly), so that no square overflows or vanishes."""
    most = np.abs(rows).max(axis=1)
    return np.ldexp(rows, -np.frexp(most)[1][:, None])


class Codes:
    """Rows with their int8 codes (as float32), scales and norms of the remainders."""

    def __init__(self, rows: np.ndarray):
        self.rows = scaled(rows)
        self.norm = np.sqrt(np.einsum("ij,ij->i", self.rows, self.rows))
        unit = self.rows / self.norm[:, None]
        self.scale = np.abs(unit).max(axis=1) / _STEPS
        codes = np.rint(unit / self.scale[:, None])
        self.codes = codes.astype(np.float32)
        rest = unit - codes * self.scale[:, None]
        self.error = np.sqrt(np.einsum("ij,ij->i", rest, rest)) + SLACK

    def product(self, a: slice, other: "Codes", b: slice) -> np.ndarray:
        width = EXACT // (_STEPS * _STEPS)
        x, y = self.codes[a], other.codes[b]
        if x.shape[1] <= width:
            return x @ y.T
        return sum((x[:, k:k + width] @ y[:, k:k + width].T).astype(np.float64) for k in range(0, x.shape[1], width))

    def cosine(self, i: np.ndarray, other: "Codes", j: np.ndarray) -> np.ndarray:
        """In double precision, pair by pair."""
        out = np.empty(len(i))
        step = max(1, 4_000_000 // max(1, self.rows.shape[1]))
        for k in range(0, len(i), step):
            x, y = i[k:k + step], j[k:k + step]
            out[k:k + step] = np.einsum("ij,ij->i", self.rows[x], other.rows[y]) / (self.norm[x] * other.norm[y])
        return out


def tile_links(a: Codes, b: Codes, threshold: float, told: list[int] | None = None):
    """Blocks of linked pairs (i, j): indices into ``a`` and ``b``, and of ``a`` is ``b``, i < j.

    ``told``: gets how many pairs were recomputed."""
    same = a is b
    for m in range(0, len(a.norm), BLOCK):
        for n in range(m if same else 0, len(b.norm), BLOCK):
            rows, cols = slice(m, m + BLOCK), slice(n, n + BLOCK)
            product = a.product(rows, b, cols)
            e, f = a.error[rows].max(), b.error[cols].max()
            least = (threshold - (e + f + e * f)) / (a.scale[rows].max() * b.scale[cols].max())
            # No pair of the block below ``least`` can link, if ``least`` is positive.
            i, j = np.nonzero(product >= np.float32(least) * (1 - 1e-6) if least > 0 else np.ones_like(product, bool))
            about = product[i, j].astype(np.float64)
            i, j = i + m, j + n
            if same and m == n:
                keep = i < j
                i, j, about = i[keep], j[keep], about[keep]
            about *= a.scale[i] * b.scale[j]
            bound = a.error[i] + b.error[j] + a.error[i] * b.error[j]
            linked = about - bound >= threshold
            open_ = np.nonzero(~linked & (about + bound >= threshold))[0]
            if told is not None:
                told.append(len(open_))
            if len(open_):
                linked[open_] = a.cosine(i[open_], b, j[open_]) >= threshold
            if linked.any():
                yield i[linked], j[linked]


class Forest:
    """Nodes 0 to n - 1 and the links that first connected them."""

    def __init__(self, n: int):
        self.root = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def _find(self, x: int) -> int:
        while self.root[x] != x:
            self.root[x] = self.root[self.root[x]]
            x = self.root[x]
        return x

    def _flat(self) -> None:
        while not np.array_equal(up := self.root[self.root], self.root):
            self.root = up

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        """Rounds: one link of each node ``i`` that still leaves its component."""
        while True:
            self._flat()
            apart = self.root[i] != self.root[j]
            i, j = i[apart], j[apart]
            if not len(i):
                return
            nodes, first = np.unique(i, return_index=True)
            for x, y in zip(nodes.tolist(), j[first].tolist()):
                p, q = self._find(x), self._find(y)
                if p != q:
                    self.root[max(p, q)] = min(p, q)
                    self.links.append((x, y))


# ---------------------------------------------------------------- cells

def _matrix(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a list column, filled up with zeros, and their lengths."""
    size = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(size) and (size == width).all():
        return values.reshape(len(size), width), size
    out = np.zeros((len(size), width))
    out[np.repeat(np.arange(len(size)), size), np.concatenate([np.arange(k) for k in [*size, 0]])] = values
    return out, size


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = scaled(rows)
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def _to_cells(pivots: np.ndarray):
    """Rows (cls, m, vec) -> also the cell, and the cosine with its pivot."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                near = _unit(_matrix(batch.column(2), pivots.shape[1])[0]) @ pivots.T
                cell = near.argmax(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(near[np.arange(len(cell)), cell])],
                    names=["cls", "m", "vec", "cell", "near"])
    return run


def _to_tiles(pivots: np.ndarray, widest: np.ndarray, begins: np.ndarray, threshold: float):
    """Rows (cls, m, vec, cell) -> one row (a, b, side, cls, m, vec) for each pair of tiles to compare it in.

    ``widest``: the largest angle of a cell's members with its pivot (below zero: the cell is empty);
    ``begins``: the first tile of each cell, and the number of tiles."""
    reach = math.acos(threshold) + 1e-6
    chord = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-6
    gaps = np.sqrt(np.maximum(0, 2 - 2 * (pivots @ pivots.T)))
    cells = np.arange(len(pivots))
    counts = np.diff(begins)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1_000):
                part = batch.slice(at, 1_000)
                cls, cell = part.column(0).to_numpy(), part.column(3).to_numpy()
                near = _unit(_matrix(part.column(2), pivots.shape[1])[0]) @ pivots.T
                own = near[np.arange(len(cell)), cell][:, None]
                meets = (own - near <= gaps[cell] * chord) & (np.arccos(np.clip(near, -1, 1)) <= widest + reach)
                meets |= cells == cell[:, None]
                # Tiles are dealt by a mixed class number, the same for every copy of the row.
                mixed = (cls.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
                tile = begins[cell] + (mixed % np.maximum(1, counts[cell]).astype(np.uint64)).astype(np.int64)
                row, to = np.nonzero(meets & (counts > 0))
                copies = counts[to]
                row = np.repeat(row, copies)
                other = np.repeat(begins[to], copies) + np.arange(len(row)) - np.repeat(np.cumsum(copies) - copies, copies)
                mine = tile[row]
                a, b = np.minimum(mine, other), np.maximum(mine, other)
                for k in range(0, len(row), 20_000):
                    s = slice(k, k + 20_000)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(a[s]), pa.array(b[s]), pa.array((mine[s] > other[s]).astype(np.int32)),
                         *(part.column(c).take(pa.array(row[s])) for c in range(3))],
                        names=["a", "b", "side", "cls", "m", "vec"])
    return run


FOUND = "v long, w long, n long"   # a class and the weight of its links; or a link of the forest, without n
_FOUND = pa.schema([("v", pa.int64()), ("w", pa.int64()), ("n", pa.int64())])


def _compare(width: int, threshold: float):
    """All rows of one pair of tiles -> rows of FOUND."""
    def run(table: pa.Table) -> pa.Table:
        vec = table.column("vec").combine_chunks()
        rows, size = _matrix(vec, width)
        cls, m, side = (table.column(c).to_numpy() for c in ("cls", "m", "side"))
        one = table.column("a")[0].as_py() == table.column("b")[0].as_py()
        groups = [np.arange(len(cls))] if one else [np.nonzero(side == k)[0] for k in (0, 1)]
        if not all(len(g) for g in groups):
            return _FOUND.empty_table()
        codes = [Codes(rows[g]) for g in groups]
        left, right = groups[0], groups[-1]
        forest, weight = Forest(len(cls)), np.zeros(len(cls), np.int64)
        for i, j in tile_links(codes[0], codes[-1], threshold):
            i, j = left[i], right[j]
            if (size != width).any():
                even = size[i] == size[j]
                i, j = i[even], j[even]
            np.add.at(weight, i, m[j])
            np.add.at(weight, j, m[i])
            forest.add(i, j)
        some = np.nonzero(weight)[0]
        ends = np.array(forest.links, np.int64).reshape(-1, 2)
        none, nodes = pa.nulls(len(some), pa.int64()), cls[some]
        return pa.Table.from_arrays([
            pa.concat_arrays([pa.array(nodes), pa.array(cls[ends[:, 0]])]),
            pa.concat_arrays([none, pa.array(cls[ends[:, 1]])]),
            pa.concat_arrays([pa.array(weight[some]), pa.nulls(len(ends), pa.int64())])], schema=_FOUND)
    return run


# ---------------------------------------------------------------- the join

def _rows(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec, k1, k2): the keys are null for vectors that link with nothing."""
    kind = vectors.schema[vec_col].dataType
    exact = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    vec = F.col(vec_col).cast("array<float>" if exact else "array<double>")
    rows = vectors.select(F.col(id_col).alias("id"), vec.alias("vec"))
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.col("vec").isNotNull() & ~bad & F.exists("vec", lambda x: x != 0)
    return rows.withColumn("usable", F.coalesce(usable, F.lit(False))).select(
        "id", "vec", *[F.when(F.col("usable"), F.xxhash64(F.lit(k), "vec")).alias(k) for k in ("k1", "k2")])


def links(classes: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of FOUND for stored classes (cls, m, vec): weights of linked classes, and links that
    connect what links connect."""
    spark = classes.sparkSession
    ship(spark)
    n, width = classes.agg(F.count("*"), F.max(F.size("vec"))).first()
    if not n:
        return spark.createDataFrame([], FOUND)
    pivots = classes.orderBy(F.xxhash64("cls")).limit(min(MOST_PIVOTS, -(-n // TILE))).select("vec").collect()
    given = np.zeros((len(pivots), width))
    for k, (vec,) in enumerate(pivots):
        given[k, :len(vec)] = vec
    pivots = _unit(given)
    kind = classes.schema["vec"].dataType.simpleString()
    cells = stored(classes.select("cls", "m", "vec").mapInArrow(
        _to_cells(pivots), f"cls long, m long, vec {kind}, cell int, near double"), "cells")
    widest, counts = np.full(len(pivots), -10.0), np.zeros(len(pivots), np.int64)
    for cell, members, least in cells.groupBy("cell").agg(F.count("*"), F.min("near")).collect():  # one row a pivot
        widest[cell], counts[cell] = math.acos(min(1.0, max(-1.0, least))), -(-members // TILE)
    begins = np.concatenate([[0], np.cumsum(counts)])
    tiles = int(begins[-1])
    pairs = cells.select("cls", "m", "vec", "cell").mapInArrow(
        _to_tiles(pivots, widest, begins, threshold), f"a long, b long, side int, cls long, m long, vec {kind}")
    pairs = pairs.repartition(min(MOST_TASKS, tiles * (tiles + 1) // 2), "a", "b")
    return stored(pairs.groupBy("a", "b").applyInArrow(_compare(width, threshold), FOUND), "links")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                    threshold: float = THRESHOLD) -> DataFrame:
    """(id, n_links, component_id) for every row of ``vectors``.

    ``threshold``: above 0, at most 1."""
    if not 0 < threshold <= 1:
        raise ValueError(f"threshold {threshold} is not above 0 and at most 1")
    rows = _rows(vectors, id_col, vec_col)
    usable = rows.filter("k1 is not null")
    classes = usable.groupBy("k1", "k2").agg(F.count("*").alias("m"), F.min("id").alias("least"), F.first("vec").alias("vec"))
    classes = stored(classes.withColumn("cls", F.monotonically_increasing_id()), "classes")  # numbered once, in the file
    found = links(classes, threshold)
    weights = found.filter("n is not null").groupBy(F.col("v").alias("cls")).agg(F.sum("n").alias("others"))
    root = components(found.filter("n is null").select(F.col("v").alias("a"), F.col("w").alias("b")))
    named = classes.select("k1", "k2", "m", "least", "cls").join(weights, "cls", "left")
    named = named.join(root.withColumnRenamed("v", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = spread_join(named, least, "root").select(
        "k1", "k2", (F.col("m") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id")
    linked = spread_join(usable.select("id", "k1", "k2"), named, ["k1", "k2"]).select("id", "n_links", "component_id")
    alone = rows.filter("k1 is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone)


def report(vectors: DataFrame) -> DataFrame:
    return near_duplicates(vectors).select(F.col("id").alias("vec_id"), "n_links", "component_id",
                                           F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))

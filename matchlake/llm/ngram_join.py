"""N-gram Jaccard join by T-occurrence search with DivideSkip.

Two documents link when the Jaccard similarity of their sets of 5-word shingles is
at least 0.75; every document gets the smallest doc_id that links reach.  The
result is exact (up to 64-bit hashes of shingles standing for them).

A document of n shingles can only link to one that holds T = ceil(0.75 n) of them.

1. One scan hashes shingles.  Equal sets are one class from here on; copies never
   meet in pairs.  Each class sends the first ``n - T + k`` shingles of a global order
   (k = max(1, n // 16)) to be counted: two classes that link share k of them (the
   smaller k of the two), so a class with too few shared ones has no partner.  The order is
   the hash, with shingles that a sample shows in 1 % of the documents last; any
   order gives the same result, this one keeps lists short.
2. The classes left send all their shingles; ``u`` of them are in another class
   as well.  With u < T a class has no partner.
3. Inverted lists by rising length: the lists of a class's ``u - T + 1`` rarest shared
   shingles tell which classes may link at all.  Connected classes form clusters.
4. Inside a cluster every class outside its largest component searches the others:
   the short lists are merged and counted, candidates reaching T - L are
   probed by binary search in the L long lists, and the overlap is compared exactly.
   Candidates that links already connect are skipped: they add no link to the result.
   A cluster above ``BLOCK`` shingles is dealt into blocks: first each block by itself,
   then pairs of blocks whose classes are not yet connected.
5. Connected components of the links give ``component_id``.

Nothing of size of the corpus reaches the driver; representatives are broadcast only after
counting them (``MOST_BROADCAST``), otherwise joined by shuffle.

Defined cases: null text, empty text and text without words have no shingles and are
linked with nothing; repeated rows are copies; a null doc_id never names a component
unless all in it are null; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import ship, stored

WORDS = 5                   # per shingle
MORE = 16                   # k = n // MORE shingles beyond the least prefix
SAMPLE = 4_000              # documents, about, to find common shingles in
COMMON = 0.01               # share of the sample
MOST_BROADCAST = 1_000_000  # representatives
BLOCK = 1_000_000           # shingles of a cluster in one task
MU = 0.0085                 # weighs probes against merging when the long lists are chosen

_KNOWN_WORDS = 100_000      # hashes that a task remembers


def least_overlap(n):
    """T: the least overlap of a linked pair in which one set has ``n`` shingles."""
    return -(-3 * n // 4)


# ---------------------------------------------------------------- shingles

class _Ids(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _KNOWN_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                     0xFF51AFD7ED558CCD], np.uint64)


def _finish(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(raw: bytes | None, ids: _Ids) -> np.ndarray:
    """Sorted distinct hashes.  ``bytes.lower`` and ``bytes.split`` know only ASCII
    letters and ASCII white space, as the definition of words asks."""
    words = raw.lower().split() if raw else []
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(ids.__getitem__, words), np.uint64, len(words))
    width = min(WORDS, len(h))
    n = len(h) - width + 1
    mixed = np.full(n, width, np.uint64)
    for k in range(width):
        mixed += (h[k:k + n] ^ (h[k:k + n] >> np.uint64(32))) * _FACTORS[k]
    return np.unique(_finish(mixed))


def _signed(a: np.ndarray) -> np.ndarray:
    return a.view(np.int64)


def _class_of(s: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    values = np.concatenate([*arrays, np.zeros(0, np.uint64)])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(_signed(values)))


SETS = "doc_id long, txt long, n_shingles long, cls long, prefix array<long>"


def _scan(common: np.ndarray):
    """Rows (doc_id, txt, raw) -> a row of SETS each; ``common`` shingles come last in the order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _Ids()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sizes, classes, prefixes = [], [], []
                for raw in part.column(2):
                    s = shingles(raw.as_py(), ids)
                    n = len(s)
                    if len(common) and n:
                        last = np.isin(s, common, assume_unique=True)
                        order = np.concatenate([s[~last], s[last]])
                    else:
                        order = s
                    sizes.append(n)
                    classes.append(_class_of(s) if n else None)
                    prefixes.append(order[:n - least_overlap(n) + max(1, n // MORE)])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(sizes, pa.int64()), pa.array(classes, pa.int64()),
                     _lists(prefixes)], names=["doc_id", "txt", "n_shingles", "cls", "prefix"])
    return run


def _all_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (cls, raw) -> (s, cls, n) for each shingle of the rows whose class is ``cls``
    (a doc_id may occur again with another text); without a class, of every row."""
    ids = _Ids()
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            out, classes, sizes = [], [], []
            for cls, raw in zip(part.column(0).to_pylist(), part.column(1)):
                s = shingles(raw.as_py(), ids)
                if len(s) and (cls is None or _class_of(s) == cls):
                    out.append(s)
                    classes.append(cls or 0)
                    sizes.append(len(s))
            yield pa.RecordBatch.from_arrays(
                [pa.array(_signed(np.concatenate([*out, np.zeros(0, np.uint64)]))),
                 pa.array(np.repeat(np.array(classes, np.int64), sizes)),
                 pa.array(np.repeat(np.array(sizes, np.int64), sizes))], names=["s", "cls", "n"])


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (s, cls) sorted -> (cls, k): how many of its shingles are in another class too.
    Streams: of the list that goes on, only its first class and the last one are kept."""
    open_s = first = last = None
    spread = False                             # the open list has two classes or more
    for batch in batches:
        s, cls = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        if not len(s):
            continue
        told = []
        new_s = np.concatenate([[open_s is None or s[0] != open_s], s[1:] != s[:-1]])
        new = new_s | np.concatenate([[new_s[0] or cls[0] != last], cls[1:] != cls[:-1]])
        # Lists of this batch; one that began before is list 0.
        group = np.cumsum(new_s) - (1 if new_s[0] else 0)
        carried = not new_s[0]
        distinct = np.bincount(group, weights=new).astype(np.int64)
        many = distinct >= 2
        if carried:
            was = spread
            many[0] = spread or distinct[0] >= 1
            if many[0] and not was:
                told.append(np.array([first]))  # its first class was held back until a second came
        told.append(cls[new & many[group]])
        tail = group == group[-1]
        begins = int(np.argmax(tail))
        if not (carried and group[-1] == 0):
            first = cls[begins]
        spread = bool(many[-1])
        open_s, last = s[-1], cls[-1]
        k = np.concatenate(told)
        if len(k):
            values, counts = np.unique(k, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(counts.astype(np.int64))], names=["cls", "k"])


# ---------------------------------------------------------------- search inside a cluster

def link_classes(sizes: np.ndarray, tokens: list[np.ndarray], group: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links (pairs of indices) that connect what links connect: DivideSkip.

    ``sizes``: set sizes; ``tokens``: the shared shingles of each set; ``group``: labels of
    sets that are known to be connected."""
    m = len(sizes)
    group = np.arange(m) if group is None else group.copy()
    counts = np.array([len(t) for t in tokens])
    owner = np.repeat(np.arange(m), counts)
    _, token = np.unique(np.concatenate(tokens), return_inverse=True)
    order = np.argsort(token, kind="stable")   # each list in rising order of its sets
    member, ends = owner[order], np.cumsum(np.bincount(token))
    begins = np.concatenate([[0], ends[:-1]])
    length = ends - begins
    at = np.concatenate([[0], np.cumsum(counts)])
    # Sets whose shingles are the most common first: the middle of a group of near copies.
    weight = np.array([length[token[at[i]:at[i + 1]]].sum() / max(1, sizes[i]) for i in range(m)])
    queue, done, links = np.argsort(-weight, kind="stable"), np.zeros(m, bool), []

    def search(x: int) -> np.ndarray:
        lists = token[at[x]:at[x + 1]]
        lists = lists[np.argsort(length[lists], kind="stable")]
        least = least_overlap(int(sizes[x]))
        if len(lists) < least:
            return np.zeros(0, np.int64)
        longest = int(length[lists[-1]])
        n_long = min(least - 1, int(least / (MU * np.log2(max(2, longest)) + 1)))
        short, long = lists[:len(lists) - n_long], lists[len(lists) - n_long:]
        merged = np.sort(np.concatenate([member[begins[t]:ends[t]] for t in short]), kind="stable")
        found, count = np.unique(merged, return_counts=True)
        near = ((count >= least - n_long) & (group[found] != group[x])
                & (4 * sizes[found] >= 3 * sizes[x]) & (4 * sizes[x] >= 3 * sizes[found]))
        found, count = found[near], count[near]
        for k, t in enumerate(long):           # the longest last
            if not len(found):
                break
            postings = member[begins[t]:ends[t]]
            place = np.minimum(np.searchsorted(postings, found), len(postings) - 1)
            count = count + (postings[place] == found)
            still = count + (len(long) - 1 - k) >= least
            found, count = found[still], count[still]
        return found[7 * count >= 3 * (sizes[found] + sizes[x])]  # overlap / union >= 3 / 4

    size = np.bincount(group, minlength=m)
    largest = int(np.argmax(size))

    def settle(x: int) -> None:
        """Search all others for ``x`` and connect it to what it links to."""
        nonlocal largest
        done[x] = True
        for y in search(x):
            a, b = group[x], group[y]
            if a == b:
                continue
            links.append((x, int(y)))
            if size[a] < size[b]:
                a, b = b, a
            group[group == b] = a
            size[a] += size[b]
            size[b] = 0
            if size[a] > size[largest]:
                largest = int(a)

    settle(int(queue[0]))
    # Of two sets in different components one is outside the largest, and searches.
    while len(todo := queue[(~done[queue]) & (group[queue] != largest)]):
        for x in todo:
            if group[x] != largest:
                settle(int(x))
    return links


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (cluster, part, cls, n, known, toks), those of a part together -> links (a, b)."""
    def rows():
        for batch in batches:
            toks = batch.column(5)
            for i, head in enumerate(zip(*(batch.column(c).to_pylist() for c in range(5)))):
                yield *head, toks[i].values.to_numpy(zero_copy_only=False)

    out: list[tuple[int, int]] = []
    for _, part in groupby(rows(), key=lambda r: r[:2]):
        part = list({r[2]: r for r in part}.values())
        if len(part) > 1:
            classes = [r[2] for r in part]
            known = np.unique(np.array([r[4] for r in part], np.int64), return_inverse=True)[1]
            out += [(classes[x], classes[y]) for x, y in link_classes(
                np.array([r[3] for r in part], np.int64), [r[5] for r in part], known)]
        if len(out) > 50_000:
            yield _pairs(out)
            out = []
    if out:
        yield _pairs(out)


def _pairs(out) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["a", "b"])


# ---------------------------------------------------------------- connected components

def components(edges: DataFrame) -> DataFrame:
    """(v, root): the smallest node of each component, for every node of ``edges`` (a, b).

    Alternating star contraction: each round hangs neighbours on smaller nodes,
    with a minimum per node that is pre-aggregated before the shuffle; a few rounds suffice
    also for long chains.  Each round is written, so lineage stays short."""
    def least(e):
        return e.groupBy(F.col("a").alias("k")).agg(F.min("b").alias("m"))

    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()
    edges = stored(edges, "edges")
    before = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            return edges.select(F.col("a").alias("v"), F.col("b").alias("root")).union(
                edges.select("b", "b")).distinct()
        before = now
        both = edges.union(edges.select("b", "a"))
        low = least(both).withColumn("m", F.least("k", "m"))
        large = both.join(low, F.col("a") == F.col("k")).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a > b").distinct()
        low = least(large)
        small = large.join(low, F.col("a") == F.col("k"))
        hung = small.filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stored(hung.union(low.select("k", "m")).filter("a > b").distinct(), "edges")


# ---------------------------------------------------------------- the join

def _raw(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("txt"),
                       text.cast("binary").alias("raw"))


def _common(rows: DataFrame) -> np.ndarray:
    """Shingles in 1 % of a sample of the documents.  At most the mean number of
    shingles divided by that share, so their size is bounded."""
    total = rows.count()
    if total < SAMPLE:
        return np.zeros(0, np.uint64)
    million = max(1, 1_000_000 * SAMPLE // total)
    sample = rows.filter(F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1_000_000)) < million)
    flat = sample.select(F.lit(None).cast("long").alias("cls"), "raw").mapInArrow(_all_shingles, "s long, cls long, n long")
    often = flat.groupBy("s").count().filter(F.col("count") >= max(2, COMMON * SAMPLE)).select("s")
    return np.sort(np.array([r[0] for r in often.collect()], np.int64).view(np.uint64))


def classes(docs: DataFrame) -> DataFrame:
    """(doc_id, txt, n_shingles, cls, prefix), stored."""
    ship(docs.sparkSession)
    rows = _raw(docs)
    return stored(rows.mapInArrow(_scan(_common(rows)), SETS), "shingles")


def _searchable(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """(cls, n, toks): the classes that may have a partner, with their shared shingles, rarest first."""
    counted = sets.select(F.explode("prefix").alias("s"), "cls")
    counted = counted.repartition("s").sortWithinPartitions("s", "cls").mapInArrow(_shared, "cls long, k long")
    counted = counted.groupBy(F.col("cls").alias("c")).agg(F.sum("k").alias("k"))
    reps = sets.filter("n_shingles > 0").groupBy("cls").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"))
    # A partner has at least T shingles, and so a k of at least T // MORE.
    need = F.expr(f"greatest(1, cast(ceil(0.75 * n) as long) div {MORE})")
    reps = stored(reps.join(counted, F.col("cls") == F.col("c")).filter(F.col("k") >= need).select("cls", "rep"), "reps")
    small = reps.count() <= MOST_BROADCAST
    rows = _raw(docs).join(F.broadcast(reps) if small else reps, F.col("doc_id").eqNullSafe(F.col("rep")))
    flat = rows.select("cls", "raw").mapInArrow(_all_shingles, "s long, cls long, n long")
    listed = W.partitionBy("s")
    flat = flat.withColumn("df", F.count("*").over(listed)).filter("df > 1")
    lists = flat.groupBy("cls").agg(F.first("n").alias("n"), F.collect_list(F.struct("df", "s")).alias("toks"))  # one document each
    lists = lists.withColumn("toks", F.array_distinct(F.transform(F.sort_array("toks"), lambda t: t["s"])))
    return stored(lists.filter(F.size("toks") >= F.ceil(0.75 * F.col("n"))), "lists")


def _search(parts: DataFrame) -> DataFrame:
    parts = parts.select("cluster", "part", "cls", "n", "known", "toks")
    return parts.repartition("cluster", "part").sortWithinPartitions("cluster", "part", "cls").mapInArrow(_links, "a long, b long")


def links(lists: DataFrame) -> DataFrame:
    """(a, b): links between classes, enough of them to connect what links connect."""
    short = F.slice("toks", F.lit(1), (F.size("toks") - F.ceil(0.75 * F.col("n")) + 1).cast("int"))
    postings = lists.select("cls", F.explode(short).alias("s"))
    near = postings.withColumn("m", F.min("cls").over(W.partitionBy("s"))).filter("cls > m")
    clusters = stored(components(near.select(F.col("cls").alias("a"), F.col("m").alias("b"))), "clusters")
    rows = lists.join(clusters, F.col("cls") == F.col("v")).withColumnRenamed("root", "cluster").drop("v")
    weights = rows.groupBy(F.col("cluster").alias("w")).agg(F.sum(F.size("toks")).alias("weight"))
    weights = weights.select("w", F.ceil(F.col("weight") / BLOCK).cast("int").alias("blocks"))
    rows = rows.join(weights, F.col("cluster") == F.col("w")).drop("w")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    found = stored(_search(rows.withColumns({"part": F.col("block").cast("string"), "known": F.col("cls")})), "links")
    # Clusters of several blocks: pairs of blocks, unless they are connected already.
    wide = rows.filter("blocks > 1")
    if wide.isEmpty():
        return found
    label = components(found)
    wide = wide.join(label, F.col("cls") == F.col("v"), "left").withColumn("known", F.coalesce("root", "cls"))
    apart = wide.groupBy(F.col("cluster").alias("w")).agg(F.min("known").alias("lo"), F.max("known").alias("hi")).filter("lo < hi")
    wide = wide.join(apart, F.col("cluster") == F.col("w"), "left_semi")
    other = F.explode(F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: b != F.col("block")))
    wide = wide.withColumn("other", other).withColumn("part", F.concat_ws(
        "-", F.least("block", "other").cast("string"), F.greatest("block", "other").cast("string")))
    return stored(found.union(_search(wide)), "links")


def joined(docs: DataFrame) -> DataFrame:
    """(doc_id, txt, n_shingles, component_id) for every row of ``docs``."""
    sets = classes(docs)
    root = components(links(_searchable(docs, sets)))
    named = sets.filter("n_shingles > 0").groupBy(F.col("cls").alias("c")).agg(F.min("doc_id").alias("least"))
    named = named.join(root, F.col("c") == F.col("v"), "left").withColumn("root", F.coalesce("root", "c"))
    least = named.groupBy(F.col("root").alias("r")).agg(F.min("least").alias("component_id"))
    named = named.join(least, F.col("root") == F.col("r")).select("c", "component_id")
    rows = sets.select("doc_id", "txt", "n_shingles", "cls").join(named, F.col("cls") == F.col("c"), "left")
    return rows.select("doc_id", "txt", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id"))
                       .otherwise(F.col("doc_id")).alias("component_id"))


def report(docs: DataFrame) -> DataFrame:
    return joined(docs).select("doc_id", "n_shingles", "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest doc_id; rows
    without shingles stay."""
    spare = "_" * max(2, *[len(c) - len(c.lstrip("_")) + 1 for c in docs.columns])  # begins no column of docs
    keep, txt, n, count = (spare + c for c in ("keep", "txt", "n", "rows"))
    rows = stored(joined(docs).filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy(
        F.col("doc_id").alias(keep), F.col("txt").alias(txt)).agg(
        F.count("*").alias(count), F.max("n_shingles").alias(n)), "keep")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(keep)) & (
        F.xxhash64(F.col("text").cast("string")) == F.col(txt))
    again = rows.filter((F.col(count) > 1) & (F.col(n) > 0))
    if again.isEmpty():
        return docs.join(rows, same, "left_semi")
    # Rows repeated with their doc_id: one of each.
    once = docs.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return docs.join(rows.filter((F.col(count) == 1) | (F.col(n) == 0)), same, "left_semi").unionByName(once)

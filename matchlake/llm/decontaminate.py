"""Benchmark decontamination by hash sets of normalised n-grams.

A broadcast table of the benchmark's windows (13 words; a shorter item is one
window) is looked up from every window of every document; hits are verified word
by word, and the words inside them are marked.  ``contaminated`` documents (hit
words at least a twentieth of all) can be removed.

Executors hash the windows of the benchmark's items; what is broadcast are flat arrays: the sorted hashes,
where each window lies in the items' normalised text, and that text, against which hits are
verified.  A bitmap over the hashes' low bits answers most lookups.  The benchmark is taken in blocks of at most
``BLOCK_WORDS`` words (about 40 bytes a word, on the driver and in a Python worker); a larger one takes one pass over the
documents for each block, which adds to the marks of the passes before, so no broadcast grows with it.

Defined cases: null or empty text has no words, is not contaminated and, as a
benchmark item, matches nothing; an item without id still marks words and is
listed as the empty string; repeated items count once by item_id; repeated documents are
judged each by itself; an empty benchmark marks nothing; extra columns are ignored, or carried along by ``remove``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, stored

WIDTH = 13
BLOCK_WORDS = 2_000_000    # words of benchmark items broadcast at once
SHARE = 20                 # contaminated: hit words * SHARE >= words

# Bytes that separate words become spaces, A-Z becomes a-z; digits, letters and all bytes from 0x80 stay.
_NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)
_REMEMBERED = 100_000


def words_of(raw: bytes | None) -> list[bytes]:
    return raw.translate(_NORMAL).split() if raw else []


class _Hashes(dict):
    """Word -> 64-bit hash; a task remembers some."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def hashes_of(words: list[bytes], known: _Hashes) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def _step(rolled: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Hashes of windows with one more word each."""
    rolled = (rolled ^ ids) * _MIX
    return rolled ^ (rolled >> np.uint64(29))


def _rolled(ids: np.ndarray, width: int) -> np.ndarray:
    """Hash of each window of ``width`` words."""
    n = len(ids) - width + 1
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = _step(out, ids[k:k + n])
    return out


INDEX = "item string, width int, text binary, hashes binary, begins binary, ends binary"


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Items (i, t) -> their normalised text, and hash, begin and end of every window in it."""
    known = _Hashes()
    for batch in batches:
        rows = []
        for item, raw in zip(*(c.to_pylist() for c in batch.columns)):
            words = words_of(raw)
            if words:
                width = min(WIDTH, len(words))
                ends = np.cumsum([len(w) + 1 for w in words]) - 1
                begins = np.concatenate([[0], ends[:-1] + 1])
                n = len(words) - width + 1
                rows.append((item, width, b" ".join(words), _rolled(hashes_of(words, known), width).tobytes(),
                             begins[:n].astype(np.int64).tobytes(), ends[width - 1:].astype(np.int64).tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 6, [
            pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary()])], names=[
            "item", "width", "text", "hashes", "begins", "ends"])


class Windows:
    """Windows of one block of benchmark items, by width: sorted hashes, places in ``text``, items."""

    def __init__(self, rows: list[tuple]):
        """``rows``: those of INDEX."""
        self.items = [r[0] for r in rows]
        self.text = b"\n".join(bytes(r[2]) for r in rows)
        at = np.concatenate([[0], np.cumsum([len(r[2]) + 1 for r in rows])]).astype(np.int64)
        self.by_width = {}
        for width in sorted({r[1] for r in rows}):
            mine = [k for k, r in enumerate(rows) if r[1] == width]
            hashes, begins, ends = (np.concatenate([np.frombuffer(rows[k][c], t) for k in mine])
                                    for c, t in ((3, np.uint64), (4, np.int64), (5, np.int64)))
            owner = np.repeat(np.array(mine, np.int32), [len(rows[k][3]) // 8 for k in mine])
            order = np.argsort(hashes, kind="stable")
            bits = max(10, int(16 * len(hashes)).bit_length())
            low = np.uint64((1 << bits) - 1)
            seen = np.zeros(1 << bits, bool)
            seen[(hashes & low).astype(np.int64)] = True
            self.by_width[width] = (hashes[order], (begins + at[owner])[order], (ends + at[owner])[order], owner[order], seen, low)

    def mark(self, raw: bytes | None, known: _Hashes | None = None) -> tuple[int, np.ndarray, set[str]]:
        """Number of words, marks of hit words, items found."""
        words = words_of(raw)
        hit, items = np.zeros(len(words), bool), set()
        if not words or not self.by_width:
            return len(words), hit, items
        ids = hashes_of(words, _Hashes() if known is None else known)
        rolled = np.zeros(len(words), np.uint64)
        for width in range(1, min(len(words), max(self.by_width)) + 1):
            n = len(words) - width + 1
            rolled = _step(rolled[:n], ids[width - 1:])
            if width not in self.by_width:
                continue
            hashes, begins, ends, owner, seen, low = self.by_width[width]
            maybe = np.flatnonzero(seen[(rolled & low).astype(np.int64)])
            first = np.searchsorted(hashes, rolled[maybe])
            for i, k in zip(maybe.tolist(), first.tolist()):
                window = None
                while k < len(hashes) and hashes[k] == rolled[i]:
                    window = window or b" ".join(words[i:i + width])
                    if self.text[begins[k]:ends[k]] == window:      # word by word
                        hit[i:i + width] = True
                        items.add(self.items[owner[k]])
                    k += 1
        return len(words), hit, items


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple]]:
    """The benchmark's windows in blocks by a hash of the item, each of about ``BLOCK_WORDS`` words."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("i"),
                             F.col("text").cast("string").cast("binary").alias("t"))
    # An upper bound of the words, without tokenising: every second byte.
    most = items.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0] // 2
    n = max(1, -(-most // BLOCK_WORDS))
    for k in range(n):
        block = items.filter(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k) if n > 1 else items
        yield [tuple(r) for r in block.mapInArrow(_index, INDEX).collect()]


MARKS = "n_words long, n_hit long, bits binary, items array<string>"
MARKS_TYPE = "struct<n_words: long, n_hit: long, bits: binary, items: array<string>>"


def _marker(spark, items) -> Column:
    """Scalar function (text, earlier marks) -> marks with those of ``items`` added."""
    shared = spark.sparkContext.broadcast(Windows(items))

    @F.pandas_udf(MARKS)
    def mark(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        windows, known = shared.value, _Hashes()
        for texts, bits, found in parts:
            out = []
            for raw, old, had in zip(texts, bits, found):
                n, hit, items = windows.mark(raw, known)
                if old is not None and len(old):
                    hit |= np.unpackbits(np.frombuffer(old, np.uint8), count=n).astype(bool)
                items.update(had if had is not None else ())
                out.append((n, int(hit.sum()), np.packbits(hit).tobytes() if hit.any() else b"", sorted(items)))
            yield pd.DataFrame(out, columns=["n_words", "n_hit", "bits", "items"])

    return mark


def mark(docs: DataFrame, benchmark: DataFrame, carry: list[str]) -> DataFrame:
    """``carry`` columns under ``__c<i>``, n_words, n_hit, items and contaminated of every row."""
    spark = docs.sparkSession
    ship(spark)
    kept = [f"__c{i}" for i in range(len(carry))]
    df = docs.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(carry, kept)],
                     F.col("text").cast("string").cast("binary").alias("__raw"),
                     F.lit(None).cast(MARKS_TYPE).alias("__m"))
    for k, items in enumerate(_blocks(benchmark)):
        if k:  # more than one block: write what there is, so that one broadcast is in use at a time
            df = stored(df, "decontaminate")
        df = df.withColumn("__m", _marker(spark, items)("__raw", "__m.bits", "__m.items"))
    return df.select(*kept, "__m.n_words", "__m.n_hit", "__m.items",
                     F.expr(f"__m.n_hit > 0 and {SHARE} * __m.n_hit >= __m.n_words").alias("contaminated"))


def remove(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without its contaminated rows."""
    df = mark(docs, benchmark, docs.columns).filter(~F.col("contaminated"))
    return df.select(*[F.col(f"__c{i}").alias(c) for i, c in enumerate(docs.columns)])


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    df = mark(docs, benchmark, ["doc_id"])
    return df.select(F.col("__c0").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                     F.sha2(F.concat_ws(",", F.sort_array("items")), 256).alias("items_sha256"), "contaminated")

"""Spelling variants by PartEnum signatures of letter multisets.

A word's letters are a multiset, that is a binary vector with one dimension per (letter,
how-many-th occurrence).  One edit changes that vector in at most two places: a replaced
letter in two, an inserted or deleted one in one.  PartEnum makes such a bound an exact
equi-join: the letters are divided into parts, and vectors that differ in at most k
places agree on all parts but k, so a signature for every choice of the parts that are
kept finds every pair.

1. One scan counts the words (combined before the shuffle); those with ``LEAST_CHARS``
   code points and ``LEAST_COUNT`` occurrences are the vocabulary.
2. The letters of the vocabulary (an alphabet of at most ``[a-zÀ-ÿ]``, counted by Spark) are dealt
   into parts of about equal weight.
3. Words of one length differ in two places: ``PARTS_EQUAL`` parts less two.  Words whose lengths differ by
   one differ in one place: ``PARTS_OTHER`` parts less one.  A signature also holds the
   length and two thirds of the word: an edit leaves two of three thirds alone, so this loses
   nothing, and a bucket stays small where many words have the same letters.
4. Words with equal signatures are joined, and ``levenshtein`` verifies each pair.
5. Every word points to its form; roots follow by pointer doubling: a form has at least
   twice the occurrences, so chains are at most log2 of the largest count long, and
   the rounds the logarithm of that.

All steps are equi-joins and keyed aggregates on words; only letter counts reach the driver.
Joins that meet an aggregate go through ``spread_join``, so AQE can split a frequent form.

Defined cases: null and empty texts, and texts without letters, have no words; a null doc_id counts as
the empty text in the checksum; repeated rows count again; an empty table, or one without a
word frequent enough, gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.combine import spread_join
from .common import ship, stored

LEAST_CHARS = 5
LEAST_COUNT = 3
DAMAGE = 97        # one run in so many loses a code point
PARTS_EQUAL = 3    # parts of the letters for words of one length; two may differ
PARTS_OTHER = 2    # for words whose lengths differ by one; one may differ
THIRDS = 3

_RUN = re.compile(r"[a-zÀ-ÿ]{%d,}" % LEAST_CHARS)  # shorter runs never make a word
_LONG = 1_000_000  # code points from which the runs of a text are taken in parts
_HELD = 300_000    # words that a task combines before it sends them


def _counted(damage: int | None):
    """Rows (id, text) -> (word, n), combined over many texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, int] = {}
        for batch in batches:
            for i, text in zip(*batch.columns):
                seed = zlib.crc32(f"{i.as_py()}:".encode())
                for runs in _runs(text.as_py().lower().decode()):  # of bytes: A-Z only
                    for word, n in runs.items():
                        if damage and not (h := zlib.crc32(word.encode(), seed)) % damage:
                            at = h % len(word)
                            word = word[:at] + word[at + 1:]
                            if len(word) < LEAST_CHARS:
                                continue
                        total[word] = total.get(word, 0) + n
                if len(total) >= _HELD:
                    yield _counts(total)
                    total = {}
        if total:
            yield _counts(total)
    return run


def _counts(total: dict[str, int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())],
                                      names=["word", "k"])


def _runs(text: str) -> Iterator[Counter]:
    """The long runs of a text with their counts, of a long text in parts."""
    if len(text) < _LONG:
        yield Counter(_RUN.findall(text))
        return
    found = _RUN.finditer(text)
    while part := Counter(m[0] for m in islice(found, _LONG // 8)):
        yield part


def vocabulary(docs: DataFrame, damage: int | None = DAMAGE) -> DataFrame:
    """(word, n): words of the texts with their occurrences, those that are frequent enough.

    With ``damage``, a run whose checksum with its doc_id is a multiple of it loses one code point."""
    ship(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
                       F.col("text").cast("string").cast("binary").alias("text")).filter("text is not null")
    words = rows.mapInArrow(_counted(damage), "word string, k long")
    return words.groupBy("word").agg(F.sum("k").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def parts(words: DataFrame, n: int) -> list[str]:
    """The letters in ``n`` parts of about equal weight (at most the alphabet is collected)."""
    counts = words.select(F.explode(F.split("word", "")).alias("c")).filter("c <> ''").groupBy("c").count().collect()
    out, weight = [""] * n, [0] * n
    for c, k in sorted(counts, key=lambda r: (-r[1], r[0])):
        i = weight.index(min(weight))
        out[i] += c
        weight[i] += k
    return out


def _signatures(letters: Column, length: Column, word: Column, longer: bool, deal: list[str], places: int) -> Column:
    """One hash per choice of ``places`` parts left out and of the third left out.

    ``length`` is that of the shorter word of a pair; ``longer``: ``word`` has one code point more, which
    the third left out holds.  Equal hashes of different signatures only cost a verification."""
    cuts = [F.floor(length * i / THIRDS).cast("int") for i in range(THIRDS + 1)]
    rest = [F.concat_ws("|", F.substring(word, F.lit(1), cuts[t]),
                        F.substring(word, cuts[t + 1] + (2 if longer else 1), F.length(word))) for t in range(THIRDS)]
    out = []
    for k, gone in enumerate(combinations(range(len(deal)), places)):
        kept = F.translate(letters, "".join(deal[i] for i in gone), "")
        out += [F.xxhash64(F.lit(k), F.lit(t), length, kept, rest[t]) for t in range(THIRDS)]
    return F.array(*out)


def near_pairs(words: DataFrame, deal_equal: list[str], deal_other: list[str]) -> DataFrame:
    """(word, other, other_n): both directions of every pair of ``words`` (word, n) exactly one edit apart."""
    letters = F.array_join(F.array_sort(F.split("word", "")), "")
    rows = words.select("word", "n", letters.alias("letters"), F.length("word").alias("size"))

    def signed(name: str, length: Column, longer: bool, deal: list[str], places: int) -> DataFrame:
        signs = _signatures(F.col("letters"), length, F.col("word"), longer, deal, places)
        signed = rows.select(F.col("word").alias(name), F.col("n").alias(f"n_{name}"), signs.alias("sig"))
        return signed.select(name, f"n_{name}", F.explode("sig").alias("sig"))

    def verified(a: DataFrame, b: DataFrame, extra: Column) -> DataFrame:
        return a.join(b, "sig").filter(extra & (F.levenshtein("x", "y", 1) == 1)).select("x", "n_x", "y", "n_y")

    same = signed("x", F.col("size"), False, deal_equal, 2)
    found = verified(same, same.withColumnsRenamed({"x": "y", "n_x": "n_y"}), F.col("x") < F.col("y"))
    shorter = signed("x", F.col("size"), False, deal_other, 1)
    longer = signed("y", F.col("size") - 1, True, deal_other, 1)
    found = found.unionByName(verified(shorter, longer, F.length("x") < F.length("y"))).distinct()
    both = F.array(*[F.struct(F.col(a).alias("word"), F.col(b).alias("other"), F.col(f"n_{b}").alias("other_n"))
                     for a, b in ("xy", "yx")])
    return found.select(F.inline(both))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for rows (word, form), where form leads on or is a last one: pointer doubling."""
    at = forms.select("word", F.col("form").alias("root"))
    while True:
        step = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        after = stored(spread_join(at, step, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        at = after.select("word", "root")
        if after.filter("moved").isEmpty():
            return at


def variants(words: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for a vocabulary (word, n), stored by the caller.

    ``form``: the near word of largest n, ties by code point, if it has at least twice the n; ``root``: the last
    form that forms lead to, or the word itself."""
    letters = words.select("word")
    near = near_pairs(words, parts(letters, PARTS_EQUAL), parts(letters, PARTS_OTHER))
    # One row per word after a combine; the largest n first, then the least word.
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct(
        (-F.col("other_n")).alias("less"), F.col("other").alias("form"))).alias("best"))
    best = best.select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))
    told = words.join(best, "word", "left")
    leads = F.col("form_n") >= 2 * F.col("n")
    told = stored(told.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(leads, F.col("form")).alias("form"),
                              F.when(leads, F.col("form_n")).alias("form_n")), "forms")
    roots = _roots(told.filter("form is not null"))
    return told.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def report(docs: DataFrame) -> DataFrame:
    words = stored(vocabulary(docs), "vocabulary")
    return variants(words).select("word", "form", "root", "n", "n_near", "form_n")

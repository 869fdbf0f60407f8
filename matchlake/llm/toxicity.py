"""Toxicity by maximum-scoring segments.

Training (labelled rows that are not held out, at most about ``MOST_LABELS`` of them):
documents containing a word are counted per class; a word's log-odds has a Dirichlet
prior centred on that of its leading 6, 5 and 4 letters in turn, so rare forms of a toxic
stem lean on the stem.  Words score their log-odds where most documents with them are toxic
and a likelihood ratio rules out chance among all words tested; all others score a small
negative drift.

Scoring (every document, whole text): a linear scan (Ruzzo and Tompa) finds all
maximal-scoring segments of the text; extreme-value theory turns a segment's score S in
a text of N words into its surprise ``lambda S - ln(K N)``, and those above 0 are the
toxic passages.  Lambda solves ``sum p(s) exp(lambda s) = 1`` over the scores of words in
clean documents, K is its maximum-likelihood estimate.  The total surprise becomes a
probability by a logistic curve.  Lambda, K and the curve are fitted on two folds, each scored
by the words counted in the other, so no document vouches for its own words.

Plan: the labelled rows, a bounded set, are broadcast to the documents (no text is
shuffled); word counts are added up in the tasks before one small shuffle; the significant
words (at most one in ``LEAST_DOCS`` of the words counted) are broadcast for scoring.

Defined cases: null or empty text has no passages and the score of a text without any
evidence; repeated rows score alike; of repeated labels the largest counts, null labels none;
without labels of both classes every score is the share of toxic labels (0 without labels);
a null doc_id is not held out.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from hashlib import blake2b
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from .common import ship, stored, text_of

MOST_LABELS = 200_000       # labelled rows that the words are learnt from
PRIOR = 10.0                # documents that the prior of a word is worth
LEAST_DOCS = 4              # toxic documents that a word must be in
LEAST_SHARE = 0.5           # of the documents with a scored word, how many are toxic
CHANCE = 3.0                # how much rarer than one in the words tested chance must be, in nats
DRIFT = 0.25                # score of other words, negative
MOST_SCORE = 8.0
THRESHOLD = 0.3             # of ``predicted``
NEAR = 0.75                 # Jaccard similarity of near copies
BLOCK_WORDS = 500_000       # words that are counted at a time, plus those of one text
BANDS, BAND = 10, 4         # min-hashes: rows with NEAR in common share a band in 98 of 100 cases
HELD_OUT = 2                # crc32(doc_id as text) mod 4

_WORD = re.compile(r"[^\W\d_]+")
_STEMS = (6, 5, 4)
_BLANKED = bytes(c if c > 127 or chr(c).isalpha() else 32 for c in range(256))   # ASCII letters and all others stay
_STRIDE = 1024              # shingles that a sketch takes at a time: 40 rows of them fit a core's cache
_ODD = np.random.default_rng(5).integers(1 << 62, size=BANDS * BAND, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def words_of(text: str) -> list[str]:
    """What ``_WORD`` finds in the lowered text; the pattern reads only what ASCII cannot tell."""
    plain = text.lower().encode("utf-8", "surrogatepass").translate(_BLANKED).decode("utf-8", "surrogatepass")
    pieces = plain.split()
    if plain.isascii() or all(map(str.isalpha, pieces)):
        return pieces
    return [w for piece in pieces for w in ((piece,) if piece.isalpha() else _WORD.findall(piece))]


def keys_of(word: str) -> list[str]:
    """The word and its stems, longest first; a stem ends in ``*``."""
    return [word, *(word[:n] + "*" for n in _STEMS if len(word) > n)]



def _surprise(clean: float, toxic: float, base: float) -> float:
    """Log-likelihood ratio of the share of toxic documents against ``base``."""
    n = clean + toxic
    return (toxic * math.log(toxic / (n * base)) if toxic else 0.0) + (
        clean * math.log(clean / (n * (1 - base))) if clean else 0.0)


def log_odds(counts: dict[str, tuple[float, float]], total: tuple[float, float]) -> dict[str, float]:
    """Score of each significant key, from its (clean, toxic) document counts."""
    base = total[1] / (total[0] + total[1])
    least = CHANCE + math.log(1 + sum(t >= LEAST_DOCS for _, t in counts.values()))
    out: dict[str, float] = {}
    known: dict[str, float] = {}

    def share(key: str, stem: str) -> float:
        """Expected share of toxic among the documents with ``key``."""
        if key in known:
            return known[key]
        shorter = [stem[:n] + "*" for n in _STEMS if len(stem) > n]
        parent = next((k for k in shorter if k in counts), None)
        q = share(parent, parent[:-1]) if parent else base
        clean, toxic = counts[key]
        clean, toxic = clean + PRIOR * (1 - q), toxic + PRIOR * q
        known[key] = toxic / (clean + toxic)
        score = math.log(toxic / clean) - math.log(total[1] / total[0])
        if counts[key][1] >= LEAST_DOCS and known[key] >= LEAST_SHARE and _surprise(*counts[key], base) > least:
            out[key] = min(MOST_SCORE, score)
        return known[key]

    for key in counts:
        share(key, key.rstrip("*"))
    return out


class Scores(dict):
    """Score of a word: its own, or that of its longest scored stem, or the drift."""

    def __init__(self, scored: dict[str, float], whole: frozenset[str]):
        super().__init__()
        self.scored, self.whole = scored, whole
        self.stems = {k[:-1]: v for k, v in scored.items() if k.endswith("*")}
        self.begins = frozenset(k[:min(_STEMS)] for k in self.stems)

    def __missing__(self, word: str) -> float:
        value = -DRIFT
        if word in self.scored:
            value = self.scored[word]
        elif word[:min(_STEMS)] in self.begins and word not in self.whole:     # a word counted often enough speaks for itself
            value = next((self.stems[word[:n]] for n in _STEMS if len(word) > n and word[:n] in self.stems), -DRIFT)
        if len(self) > 500_000:
            self.clear()
        self[word] = value
        return value


def segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (begin, end, score), in linear time: each
    positive run is merged with those before it while that raises the score."""
    out: list[list] = []                       # begin, end, sum before, sum up to the end, nearest with a smaller sum before
    sums = list(accumulate(scores, initial=0.0))
    end, n = 0, len(scores)
    for begin in [i for i, score in enumerate(scores) if score > 0]:
        if begin < end:
            continue                           # in the run of the one before
        end = begin + 1
        while end < n and scores[end] > 0:
            end += 1
        before, total = sums[begin], sums[end]
        while True:
            j = len(out) - 1
            while j >= 0 and out[j][2] >= before:
                j = out[j][4]                  # those between have larger sums before them
            if j < 0 or out[j][3] >= total:
                break
            begin, before = out[j][0], out[j][2]
            del out[j:]
        out.append([begin, end, before, total, j])
    return [(b, e, hi - lo) for b, e, lo, hi, _ in out]


@dataclass
class Model:
    scored: dict[str, float] = field(default_factory=dict)
    whole: frozenset[str] = frozenset()
    rate: float = 1.0       # lambda
    k: float = 1.0
    curve: tuple[float, float] = (-30.0, 0.0)

    def passages(self, words: list[str], scores: Scores) -> list[tuple[int, int, float]]:
        """Segments with their surprise, those above 0."""
        s = list(map(scores.__getitem__, words))
        found = segments(s) if words and max(s) > 0 else []
        cost = math.log(max(self.k * len(words), 1e-300)) if words else 0.0
        return [(b, e, x) for b, e, v in found if (x := self.rate * v - cost) > 0]

    def probability(self, surprise: float) -> float:
        a, b = self.curve
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, a + b * math.log1p(surprise)))))


# ---------------------------------------------------------------- training

def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == HELD_OUT


@lru_cache(1 << 16)
def _digest(word: str) -> bytes:
    return blake2b(word.encode("utf-8", "replace"), digest_size=8).digest()


def _runs(text: str) -> np.ndarray:
    """Hashes of the runs of five words, one after another; a shorter text is one run."""
    hashes = np.frombuffer(b"".join(map(_digest, text.lower().split())) or bytes(8), "<u8")
    n = max(len(hashes) - 4, 1)
    out = np.zeros(n, np.uint64)
    for k in range(min(5, len(hashes))):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[k:k + n]
        out ^= out >> np.uint64(29)
    return out


def shingles_of(text: str) -> np.ndarray:
    """Hashes of the distinct runs of five words."""
    return np.unique(_runs(text))


def sketch_of(shingles: np.ndarray) -> np.ndarray:
    """Minima of the shingles, which may repeat, under ``BANDS * BAND`` hash functions."""
    out = np.full(BANDS * BAND, np.iinfo(np.uint64).max, np.uint64)
    odd = _ODD[:, None]
    for at in range(0, len(shingles), _STRIDE):
        mixed = shingles[at:at + _STRIDE] ^ (odd >> np.uint64(7))
        mixed *= odd
        mixed ^= mixed >> np.uint64(31)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(30)
        np.minimum(out, mixed.min(axis=1), out=out)
    return out.view(np.int64)


def _sketched(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in parts:
        yield pd.DataFrame({"id": part["id"], "h": part["h"], "toxic": part["toxic"],
                            "sketch": [sketch_of(_runs(t)) for t in part["text"]]})


class Leaders:
    """The rows of a band that later ones are compared with."""

    def __init__(self, row: tuple[int, int], sketch: np.ndarray):
        self.rows, self.sketches = [row], np.array([sketch])

    def nearest(self, row: tuple[int, int], sketch: np.ndarray) -> tuple[int, int] | None:
        """The leader most alike, if it may be a near copy; a row like none becomes one."""
        n = len(self.rows)
        alike = (self.sketches[:n] == sketch).mean(axis=1)
        j = int(alike.argmax())
        found = self.rows[j] if alike[j] >= NEAR - 0.2 else None      # about; the texts decide
        if alike[j] < 0.95:
            if n == len(self.sketches):
                self.sketches = np.concatenate([self.sketches, np.empty_like(self.sketches)])
            self.sketches[n] = sketch
            self.rows.append(row)
        return found


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row of a band with the row before it whose sketch is most alike.  Bands come
    one after another, rows in order of (id, h); a band may go on in the next batch."""
    band, leaders = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        toxic, slot, low, row_id, h = (batch.column(c).to_numpy(zero_copy_only=False)
                                       for c in ("toxic", "slot", "low", "id", "h"))
        sketches = batch.column("sketch").flatten().to_numpy().reshape(len(h), -1)
        begins = np.ones(len(h) + 1, bool)
        begins[1:-1] = (toxic[1:] != toxic[:-1]) | (slot[1:] != slot[:-1]) | (low[1:] != low[:-1])
        begins[0] = band != (toxic[0], slot[0], low[0])
        out = []
        alone = begins[:-1] & begins[1:]
        alone[-1] = False                       # the next batch may go on with it
        for i in np.flatnonzero(~alone).tolist():
            row = (row_id[i], h[i])
            if begins[i]:
                leaders = Leaders(row, sketches[i])
            elif (to := leaders.nearest(row, sketches[i])) is not None:
                out.append((*row, *to))
        band = (toxic[-1], slot[-1], low[-1])
        columns = np.array(out, np.int64).reshape(-1, 4).T
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["id", "h", "id2", "h2"])


def _near(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The pairs whose texts have a Jaccard similarity of at least ``NEAR``."""
    for part in parts:
        keep = []
        for one, two in zip(part["text"], part["text2"]):
            a, b = shingles_of(one), shingles_of(two)
            same = len(np.intersect1d(a, b, assume_unique=True))
            keep.append(same >= NEAR * (len(a) + len(b) - same))
        yield part.loc[keep, ["id", "h"]]


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic, fold) of at most about ``MOST_LABELS`` labelled rows that are not held
    out, without near copies of rows with the same label: copies of a toxic document would
    make all its words look toxic.

    A row goes if an earlier one, in order of the id, has its label and shares ``NEAR`` of
    their 5-word shingles.  Rows with a band of min-hashes in common are compared by
    their sketches, the most alike pair of a row and a band by the texts."""
    ship(docs.sparkSession)
    known = labels.filter(~held_out() & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy(F.col("doc_id").alias("__id")).agg(F.max("toxic").cast("int").alias("toxic"))
    n = known.count()
    if n > MOST_LABELS:
        draw = F.pmod(F.xxhash64(F.lit("label"), "__id"), F.lit(1 << 30))
        known = known.filter(draw < (1 << 30) * MOST_LABELS // n)
    known = known.withColumn("fold", (F.pmod(F.xxhash64(F.lit("fold"), "__id"), F.lit(2))).cast("int"))
    # The texts are fetched once, bounded by MOST_LABELS; a hash tells rows of one id apart.
    rows = docs.select(F.col("doc_id").alias("__doc"), text_of().alias("text")).join(
        F.broadcast(known), F.col("__doc") == F.col("__id"))
    rows = rows.select(F.col("__id").cast("long").alias("id"), F.xxhash64("text").alias("h"), "toxic", "fold", "text")
    rows = stored(rows, "toxic-rows")
    sketches = rows.select("id", "h", "toxic", "text").mapInPandas(_sketched, "id long, h long, toxic int, sketch array<long>")
    sketches = stored(sketches, "toxic-sketches")
    sketches = sketches.dropDuplicates(["id", "h"])
    bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)),
                        lambda i: F.struct(i.alias("slot"), F.xxhash64(F.slice("sketch", i * BAND + 1, BAND)).alias("low")))
    banded = sketches.select("id", "h", (F.col("toxic") > 0).alias("toxic"), F.inline(bands), "sketch")
    # Bands are read one after another in sorted partitions: most have one row, too little for a group each.
    banded = banded.repartition("toxic", "slot", "low").sortWithinPartitions("toxic", "slot", "low", "id", "h")
    pairs = banded.mapInArrow(_pairs, "id long, h long, id2 long, h2 long")
    pairs = stored(pairs.distinct(), "toxic-pairs")
    named = pairs.select("id", "h").union(pairs.select("id2", "h2")).distinct()
    texts = rows.join(F.broadcast(named), ["id", "h"]).select("id", "h", "text")
    texts = stored(texts.dropDuplicates(["id", "h"]), "toxic-texts")
    others = texts.select(F.col("id").alias("id2"), F.col("h").alias("h2"), F.col("text").alias("text2"))
    copies = pairs.join(texts, ["id", "h"]).join(others, ["id2", "h2"]).select("id", "h", "text", "text2")
    copies = copies.mapInPandas(_near, "id long, h long").distinct()
    kept = stored(sketches.select("id", "h").join(copies, ["id", "h"], "left_anti"), "toxic-labels")
    return rows.join(F.broadcast(kept), ["id", "h"]).select("text", "toxic", "fold")


COUNTS = "key string, c0 long, t0 long, c1 long, t1 long"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per key, class and fold, added up for each block; key '' has all keys."""
    for batch in batches:
        into = 2 * batch.column("fold").to_numpy(zero_copy_only=False).astype(np.int64)
        into += batch.column("toxic").to_numpy(zero_copy_only=False) > 0
        said, many = [], []
        for i, text in enumerate(batch.column("text"), 1):
            found = set(words_of(text.as_py()))
            many.append(len(found))
            said.extend(found)
            if len(said) >= BLOCK_WORDS or i == batch.num_rows:
                block, said = pa.array(said, pa.string()), []
                yield _counted(block, many, into[i - len(many):i])
                many = []


def _counted(said: pa.Array, many: list[int], into: np.ndarray) -> pa.RecordBatch:
    """Counts of the distinct words ``said`` by texts that have so ``many`` each."""
    said = said.dictionary_encode()
    words, code = said.dictionary, said.indices.to_numpy().astype(np.int64)
    doc = np.repeat(np.arange(len(many)), many)
    keys, counts = [words], [_tally(code, into[doc], len(words))]
    for n in _STEMS:                            # those of the distinct words, then once a document
        longer = pc.greater(pc.utf8_length(words), n)
        stems = pc.utf8_slice_codeunits(words.filter(longer), 0, n).dictionary_encode()
        stem = np.full(len(words), -1)
        stem[longer.to_numpy(zero_copy_only=False)] = stems.indices.to_numpy()
        least = max(len(stems.dictionary), 1)
        has = stem[code] >= 0
        once = np.unique(doc[has] * least + stem[code[has]])
        keys.append(pc.binary_join_element_wise(stems.dictionary, "*", ""))
        counts.append(_tally(once % least, into[once // least], len(stems.dictionary)))
    counts = np.concatenate(counts)
    return pa.RecordBatch.from_arrays(
        [pa.concat_arrays([pa.array([""]), *keys]), *map(pa.array, np.vstack([counts.sum(axis=0), counts]).T.copy())],
        ["key", "c0", "t0", "c1", "t1"])


def _tally(key: np.ndarray, into: np.ndarray, keys: int) -> np.ndarray:
    """How often each key comes with each of the four classes and folds."""
    return np.bincount(key * 4 + into, minlength=keys * 4).reshape(keys, 4)


def _fold_scores(first: Model, second: Model):
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scores = [Scores(m.scored, m.whole) for m in (first, second)]
        for part in parts:
            out = []
            for text, toxic, fold in zip(part["text"], part["toxic"], part["fold"]):
                words = words_of(text)
                s = list(map(scores[1 - fold].__getitem__, words))
                found = segments(s) if words and max(s) > 0 else []
                out.append((int(toxic > 0), len(words), [v for _, _, v in found],
                            [x for x in s if x > 0] if not toxic else []))
            yield pd.DataFrame(out, columns=["toxic", "n", "found", "positive"])
    return run


def _lambda(positive: list[float], words: int) -> float:
    """Solves the scale of the extreme-value law by bisection; half a word more is
    counted as positive, so that it exists when no clean word is."""
    values = np.array([*positive, MOST_SCORE / 2])
    weights = np.array([*np.ones(len(positive)), 0.5]) / (words + 1)
    rest = 1 - weights.sum()
    low, high = 1e-6, 1.0
    excess = lambda x: (weights * np.exp(np.minimum(700, x * values))).sum() + rest * math.exp(-x * DRIFT) - 1
    while excess(high) < 0 and high < 1e3:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return high


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic regression of y on x by Newton's method, with a weak prior."""
    a, b = math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)), 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a + b * x, -30, 30)))
        w = p * (1 - p)
        gradient = np.array([(y - p).sum(), ((y - p) * x).sum() - 0.01 * b])
        hessian = np.array([[w.sum() + 1e-6, (w * x).sum()], [(w * x).sum(), (w * x * x).sum() + 0.01]])
        step = np.linalg.solve(hessian, gradient)
        step *= min(1.0, 5 / max(1e-9, np.abs(step).max()))
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(a), max(0.0, float(b))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    rows = training_rows(docs, labels)
    counted = rows.mapInArrow(_count, COUNTS).groupBy("key").agg(*[F.sum(c).alias(c) for c in ("c0", "t0", "c1", "t1")])
    counted = stored(counted, "toxic-words")
    total = counted.filter("key = ''").first()
    if total is None or not (total["c0"] + total["c1"] and total["t0"] + total["t1"]):
        n = rows.agg(F.count("*"), F.sum((F.col("toxic") > 0).cast("long"))).first()
        share = (n[1] or 0) / n[0] if n[0] else 0.0
        return Model(curve=(math.log(max(share, 1e-13) / max(1 - share, 1e-13)), 0.0))
    # What may become significant, and words counted often enough to differ from their stem;
    # their number is bounded by that of the training rows.
    often = counted.filter(f"key != '' and (t0 + t1 >= {LEAST_DOCS} or (c0 + t0 + c1 + t1 >= {int(2 * PRIOR)} "
                           "and key not like '%*'))").collect()
    folds = [{r["key"]: (r[f"c{i}"], r[f"t{i}"]) for r in often} for i in (0, 1)]
    both = {k: (folds[0][k][0] + folds[1][k][0], folds[0][k][1] + folds[1][k][1]) for k in folds[0]}

    def model(counts, clean, toxic) -> Model:
        if not clean or not toxic:
            return Model()
        scored = log_odds({k: v for k, v in counts.items() if sum(v)}, (clean, toxic))
        whole = frozenset(k for k, v in counts.items() if not k.endswith("*") and k not in scored
                          and sum(v) >= 2 * PRIOR and any(stem in scored for stem in keys_of(k)[1:]))
        return Model(scored, whole)

    halves = [model(folds[i], total[f"c{i}"], total[f"t{i}"]) for i in (0, 1)]
    scored = rows.mapInPandas(_fold_scores(*halves), "toxic int, n long, found array<double>, positive array<double>")
    scored = scored.collect()                   # numbers of at most about MOST_LABELS rows
    clean = [r for r in scored if not r["toxic"]]
    rate = _lambda([x for r in clean for x in r["positive"]], sum(r["n"] for r in clean))
    sums = sum(r["n"] * math.exp(-rate * max(r["found"], default=0.0)) for r in clean)
    k = len(clean) / sums if sums else 1.0
    full = model(both, total["c0"] + total["c1"], total["t0"] + total["t1"])
    full.rate, full.k = rate, k
    surprise = [sum(max(0.0, rate * v - math.log(max(k * r["n"], 1e-300))) for v in r["found"]) for r in scored]
    full.curve = _curve(np.log1p(np.array(surprise)), np.array([r["toxic"] for r in scored], float))
    return full


# ---------------------------------------------------------------- scoring

RESULT = StructType([StructField("score", DoubleType()), StructField("n_passages", LongType()),
                     StructField("start", IntegerType()), StructField("end", IntegerType())])


def scorer(spark, model: Model) -> Column:
    """Function of a text: its score, how many passages it has, and the code points
    where the most surprising one begins and ends."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf(RESULT)
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        scores = Scores(model.scored, model.whole)
        for part in parts:
            out = []
            for text in part:
                found = model.passages(words_of(text), scores)
                begin = end = None
                if found:
                    first, last, _ = max(found, key=lambda p: p[2])
                    # Lowering changes the length of a few letters; then offsets are those of the lowered text.
                    at = [m.span() for m in _WORD.finditer(text.lower())]
                    begin, end = at[first][0], at[last - 1][1]
                out.append((model.probability(sum(p[2] for p in found)), len(found), begin, end))
            frame = pd.DataFrame(out, columns=["score", "n_passages", "start", "end"])
            yield frame.astype({"start": "Int32", "end": "Int32"})

    return score


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = train(docs, labels)
    df = docs.select("doc_id", held_out().alias("held_out"), scorer(docs.sparkSession, model)(text_of()).alias("__s"))
    return df.select("doc_id", "held_out", F.col("__s.score").alias("score"),
                     (F.col("__s.score") >= THRESHOLD).cast("int").alias("predicted"),
                     F.col("__s.n_passages").alias("n_passages"), F.col("__s.start").alias("passage_start"),
                     F.col("__s.end").alias("passage_end"))

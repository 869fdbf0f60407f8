"""URL filter: listed rules first, then words of the host and the path.

A rule (host, path) fits its host and all subdomains when the path starts with the
rule's; the longest fitting rule decides.  Other urls are judged by a multinomial naive
Bayes classifier over words.  Names like ``cheappills`` are cut into words by Viterbi
search for the most likely sequence under a unigram model.

Training covers all pages.  The unigram model counts, over distinct hosts, the
pieces between dots, hyphens and digits; its words are the lexicon below and all pieces, also
those seen once, of at most ``LONGEST`` letters that are no sequence of lexicon words.  Words that
make up ``SHARE`` of all (at most ``1 / SHARE``) are broadcast; of the others, those inside a
piece are joined to each distinct piece by a shuffle of its substrings.
The classifier's examples are the distinct (host, shape of path) pairs: unwanted if they hold
an unwanted word of the lexicon, wanted otherwise; the lexicon itself adds ``PRIOR``
examples per word.  It has the exact counts of every token in both classes.  Tokens that make
up ``SHARE`` of either class (at most ``2 / SHARE``) are broadcast with their log odds; the
log odds of the rest, none of them frequent, are joined to the pages' tokens by a shuffle.
Pages are scored once per shape and get the score by a join on it.

Defined cases: a null url, or one without ``://``, has empty host and path, no rule
and the verdict of a url without words (allow); repeated rows are judged alike; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, stored

# The rules.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)

# The lexicon.
UNWANTED = frozenset("""
ad ads adserver adult affiliate bet bets betting bingo bonus casino cheap cheat cialis click clicks counterfeit crack cracked
dating doubleclick drugs escort escorts farm free gamble gambling hack hacked hookup jackpot keygen loan loans lottery
malware meds nude payday phishing pharma pharmacy pill pills poker popup porn promo replica roulette scam sex sexy slots spam
steroids torrent track tracker tracking viagra virus warez webcam win winner xxx
""".split())
# Of these, the ones that are harmless by themselves: they count as evidence, but make no example unwanted.
WEAK = frozenset("ad bonus cheap click clicks dating farm free promo track tracking win winner".split())
WANTED = frozenset("""
about academy api archive art article articles blog blogs book books calendar city class code college community contact course
daily data design dev digital docs download edu education events family film food forum gallery garden gov group guide health help
history home house image images index info international journal kids lab law learn library life local mail map maps market media
mobile museum music national nature network news online open page pages paper people photo photos post posts press product products
project radio recipe recipes research review reviews school science search service services shop site social society sport
sports static store story student studio support team tech technology test time times tips tools topic town travel
university user video weather web wiki world write www
""".split())

SHARE = 1 / 20_000
PRIOR = 5.0
SMOOTH = 200.0             # tokens
LONGEST = 24               # letters of a word
_PIECE = re.compile(r"[^\W\d_]+|\d+")


# ---------------------------------------------------------------- parts and rules

def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule as text, and its verdict; null without one."""
    name = verdict = F.lit(None).cast("string")
    for rule_host, rule_path, decision in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, rule_host + rule_path).otherwise(name)
        verdict = F.when(fits, decision).otherwise(verdict)
    return name, verdict


# ---------------------------------------------------------------- words

class Unigrams:
    """Word model: counts of words; an unknown word costs ten times as much per letter.
    ``total`` is that of all words where ``counts`` has a part of them."""

    def __init__(self, counts: dict[str, float], total: float | None = None):
        self.total = (sum(counts.values()) if total is None else total) + 1.0
        self.log = {w: math.log(n / self.total) for w, n in counts.items() if n > 0}
        self.unknown = -math.log(self.total) - 1.0

    def split(self, name: str, rare: dict[str, float] | None = None) -> list[str]:
        """The most likely words whose concatenation is ``name``.  ``rare``: counts of words
        of ``name`` that the model's own counts lack."""
        more = {w: math.log(n / self.total) for w, n in (rare or {}).items()}
        best, back = [0.0] + [-math.inf] * len(name), [0] * (len(name) + 1)
        for end in range(1, len(name) + 1):
            for begin in range(max(0, end - LONGEST), end):
                word = name[begin:end]
                cost = self.log.get(word)
                if cost is None:
                    cost = more.get(word)
                if cost is None:
                    cost = self.unknown - (end - begin) * math.log(10)
                if best[begin] + cost > best[end]:
                    best[end], back[end] = best[begin] + cost, begin
        words, end = [], len(name)
        while end:
            words.append(name[back[end]:end])
            end = back[end]
        return words[::-1]


def pieces(text: str) -> list[str]:
    """Runs of letters; a run of digits is ``0``."""
    return ["0" if p.isdigit() else p for p in _PIECE.findall(text.lower())]


def key_of(piece: str) -> str:
    """Short name of a piece: itself, or a digest of a very long one."""
    return piece if len(piece) <= 32 else "#" + hashlib.md5(piece.encode()).hexdigest()


def lexicon_counts() -> dict[str, float]:
    return {w: PRIOR for w in UNWANTED | WANTED}


# ---------------------------------------------------------------- training

def shape_of(path: Column) -> Column:
    """The path with digits as 0: it has the same words."""
    return F.regexp_replace(F.lower(path), r"\d+", "0")


def id_of(host: Column, shape: Column) -> Column:
    """Short key of a shape: a host has no slash, and a path that is not empty begins with one."""
    return F.md5(F.concat(host, shape))


def _shapes(pages: DataFrame) -> DataFrame:
    """Distinct (host, shape)."""
    url = F.col("url").cast("string")
    return stored(pages.select(host_of(url).alias("host"), shape_of(path_of(url)).alias("shape")).distinct(), "url-shapes")


def train_unigrams(shapes: DataFrame) -> tuple[DataFrame, Unigrams]:
    """The counts ``n`` of all words as a stored table, and the model of the frequent ones."""
    hosts = shapes.select("host").filter("host != ''").distinct()
    words = hosts.select(F.explode(F.regexp_extract_all(F.lower("host"), F.lit(r"\p{L}+"), F.lit(0))).alias("w"))
    lexicon = lexicon_counts()
    known = Unigrams(lexicon)

    @F.pandas_udf("boolean")
    def is_word(names: pd.Series) -> pd.Series:
        return names.map(lambda w: w in lexicon or not all(p in lexicon for p in known.split(w))).astype(bool)

    counted = words.groupBy("w").agg(F.count("*").cast("double").alias("n")).filter(F.length("w") <= LONGEST)
    listed = shapes.sparkSession.createDataFrame(sorted(lexicon.items()), "w string, n double")
    counted = counted.filter(is_word("w")).unionByName(listed).groupBy("w").agg(F.sum("n").alias("n"))
    counted = stored(counted, "url-unigrams")
    total = counted.agg(F.sum("n")).first()[0]
    counted = counted.withColumn("frequent", F.col("n") >= SHARE * total)
    return counted, Unigrams({r["w"]: r["n"] for r in counted.filter("frequent").collect()}, total)


def _named(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Shapes with the pieces of host and path, and their sides."""
    for part in parts:
        both = [(pieces(host), pieces(shape)) for host, shape in zip(part["host"], part["shape"])]
        yield pd.DataFrame({"id": part["id"], "example": part["host"] != "", "names": [h + p for h, p in both],
                            "keys": [[key_of(x) for x in h + p] for h, p in both], "n_host": [len(h) for h, _ in both]})


def _substrings(shared):
    """Substrings of each piece that may be words, without the frequent words."""
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frequent, out = shared.value.log, []
        for part in parts:
            for key, piece in zip(part["key"], part["piece"]):
                inside = {piece[b:e] for e in range(1, len(piece) + 1) for b in range(max(0, e - LONGEST), e)}
                out += [(key, w) for w in inside if w not in frequent]
                if len(out) > 100_000:
                    yield pd.DataFrame(out, columns=["key", "w"])
                    out = []
        yield pd.DataFrame(out, columns=["key", "w"], dtype=str)
    return run


def _cut(shared):
    """Pieces cut into words."""
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unigrams = shared.value
        for part in parts:
            rare = [{r["w"]: r["n"] for r in found} if found is not None else {} for found in part["rare"]]
            yield pd.DataFrame({"key": part["key"], "cut": [
                unigrams.split(piece, r) if piece != "0" else [piece] for piece, r in zip(part["piece"], rare)]})
    return run


def worded_shapes(shapes: DataFrame) -> DataFrame:
    """(id, example, words, bad): the tokens of each shape, whether it is a training example
    (it has a host), and whether it is unwanted as one."""
    counted, unigrams = train_unigrams(shapes)
    shared = shapes.sparkSession.sparkContext.broadcast(unigrams)
    named = stored(shapes.withColumn("id", id_of(F.col("host"), F.col("shape"))).mapInPandas(
        _named, "id string, example boolean, names array<string>, keys array<string>, n_host int"), "url-named")
    distinct = named.select(F.explode(F.arrays_zip("keys", "names")).alias("p"))
    distinct = stored(distinct.groupBy(F.col("p.keys").alias("key")).agg(F.min("p.names").alias("piece")), "url-pieces")
    inside = distinct.filter("piece != '0'").mapInPandas(_substrings(shared), "key string, w string")
    rare = inside.join(counted.filter("not frequent").select("w", "n"), "w")
    rare = rare.groupBy("key").agg(F.collect_list(F.struct("w", "n")).alias("rare"))
    cuts = stored(distinct.join(rare, "key", "left").mapInPandas(_cut(shared), "key string, cut array<string>"), "url-cuts")

    # A piece such as www is in most shapes: its rows are a hot key, which AQE splits.
    at = named.select("id", "n_host", F.posexplode("keys").alias("at", "key")).join(cuts, "key")
    side = F.when(F.col("at") < F.col("n_host"), "host:").otherwise("path:")
    at = at.select("id", "at", F.transform("cut", lambda w: F.concat(side, w)).alias("words"))
    at = at.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("at", "words"))).alias("all"))
    at = at.select("id", F.flatten("all.words").alias("words"))
    strong = F.array(*[F.lit(f"{s}:{w}") for s in ("host", "path") for w in sorted(UNWANTED - WEAK)])
    words = F.coalesce(F.col("words"), F.expr("cast(array() as array<string>)"))
    worded = named.select("id", "example").join(at, "id", "left").select("id", "example", words.alias("words"))
    return stored(worded.withColumn("bad", F.arrays_overlap("words", strong)), "url-worded")


class Bayes:
    """Log odds of unwanted over wanted, per token.  Both classes are smoothed with
    ``SMOOTH`` tokens of the corpus as a whole, so a token that is everywhere says nothing.

    ``odds``: the log odds of every token as a stored table; ``frequent``: those that make
    up ``SHARE`` of a class."""

    def __init__(self, worded: DataFrame):
        spark = worded.sparkSession
        examples = worded.filter("example")
        n = {r["bad"]: r["count"] for r in examples.groupBy("bad").count().collect()}
        # The share of unwanted examples says little about a new host: it weighs no more than one word.
        self.prior = max(-2.0, min(0.0, math.log((n.get(True, 0) + 1) / (n.get(False, 0) + 1))))

        hints = spark.createDataFrame([(f"{side}:{w}", 0, 0, PRIOR * (w in UNWANTED), PRIOR * (w in WANTED))
                                       for w in sorted(UNWANTED | WANTED) for side in ("host", "path")],
                                      "w string, bad long, good long, hint_bad double, hint_good double")
        seen = examples.select(F.explode("words").alias("w"), F.col("bad").cast("long").alias("bad"))
        seen = seen.select("w", "bad", (1 - F.col("bad")).alias("good"), F.lit(0.0).alias("hint_bad"), F.lit(0.0).alias("hint_good"))
        counted = seen.unionByName(hints).groupBy("w").agg(*[F.sum(c).alias(c) for c in hints.columns[1:]])
        counted = stored(counted, "url-words")
        words, bad, good = counted.agg(F.count("*"), F.sum("bad"), F.sum("good")).first()

        smooth = F.lit(SMOOTH) * (F.col("bad") + F.col("good") + 1) / F.lit(float(bad + good + words))
        share = {c: (F.col(c) + F.col(f"hint_{c}") + smooth) / F.lit(total + SMOOTH) for c, total in (("bad", bad), ("good", good))}
        frequent = (F.col("bad") >= SHARE * bad) & (F.col("bad") > 0) | (F.col("good") >= SHARE * good) & (F.col("good") > 0)
        self.odds = stored(counted.select("w", F.log(share["bad"] / share["good"]).alias("odds"), frequent.alias("frequent")), "url-odds")
        self.frequent = {r["w"]: r["odds"] for r in self.odds.filter("frequent").collect()}


def train(pages: DataFrame) -> tuple[DataFrame, Bayes]:
    """The shapes with their tokens, and the log odds of these."""
    ship(pages.sparkSession)
    worded = worded_shapes(_shapes(pages))
    return worded, Bayes(worded)


# ---------------------------------------------------------------- scoring

def _known(shared):
    """Shapes with the sum of their frequent tokens, and the list of the others."""
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        odds = shared.value
        for part in parts:
            yield pd.DataFrame({"id": part["id"],
                                "known": [math.fsum(odds.get(w, 0.0) for w in words) for words in part["words"]],
                                "rest": [[w for w in words if w not in odds] for words in part["words"]]})
    return run


def scores(worded: DataFrame, bayes: Bayes) -> DataFrame:
    """(id, score): log odds that a page of the shape is unwanted."""
    shared = worded.sparkSession.sparkContext.broadcast(bayes.frequent)
    known = stored(worded.select("id", "words").mapInPandas(
        _known(shared), "id string, known double, rest array<string>"), "url-known")
    rest = known.select("id", F.posexplode("rest").alias("at", "w")).join(bayes.odds.filter("not frequent"), "w")
    # Added up in the order of the url, so that the sum is the same in every run.
    rest = rest.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("at", "odds"))).alias("rest"))
    rest = rest.select("id", F.aggregate("rest", F.lit(0.0), lambda total, x: total + x["odds"]).alias("more"))
    score = F.lit(bayes.prior) + F.col("known") + F.coalesce(F.col("more"), F.lit(0.0))
    return stored(known.join(rest, "id", "left").select("id", score.alias("score")), "url-scores")


def report(pages: DataFrame) -> DataFrame:
    url = F.col("url").cast("string")
    scored = scores(*train(pages))
    df = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    df = df.withColumn("id", id_of(F.col("host"), shape_of(F.col("path")))).join(scored, "id", "left")
    rule, verdict = rule_of(F.col("host"), F.col("path"))
    by_words = F.when(F.col("score") > 0, "block").otherwise("allow")
    return df.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, by_words).alias("verdict"), "score")

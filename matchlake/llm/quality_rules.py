"""Quality rules by weak supervision.

Each rule looks at a few counts of a document and votes good (1), bad (-1) or
abstains (0).  Expectation-maximisation over the counts of vote patterns (at
most ``3 ** len(RULES)`` of them, whatever the size of the corpus) estimates how
often each rule votes how on good and on bad documents; a document is kept when
its posterior probability of being good reaches ``threshold``.  A base rule (fewer than 20
words, or over 30 % of them in repeated windows) rejects beforehand.

Plan: one scan computes the counts (array functions inside the row; no shuffle)
and writes them as a scratch table, one aggregate groups the vote patterns, and
the fitted weights come back as literals in a projection.  No Python runs on the
executors.

Defined cases: null or empty text has no words and fails the base rule; repeated
rows are judged each by itself; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, text_of, words_of

WINDOW = 8

# The bounds between which a rule abstains.  Every rule can vote either way on documents that
# pass the base rule.
RULES: dict[str, tuple[str, str]] = {
    # rule: (bad when, good when)
    "symbols": ("n_symbols > 0.10 * n_words", "n_symbols <= 0.02 * n_words"),
    "capitals": ("n_upper > 0.40 * n_letters", "n_upper <= 0.15 * n_letters"),
    "letters": ("n_letters < 0.60 * word_chars", "n_letters >= 0.88 * word_chars"),
    "lines": ("n_dup_lines > 0.30 * n_lines and n_dup_lines >= 3", "n_dup_lines <= 0.05 * n_lines"),
    "windows": ("n_repeat_words > 0.20 * n_words", "n_repeat_words <= 0.02 * n_words"),
    "echoes": ("n_echoes > 0.25 * n_words", "n_echoes <= 0.05 * n_words"),
    "word_length": ("word_chars > 12 * n_words or word_chars < 2.2 * n_words",
                    "word_chars between 3 * n_words and 9 * n_words"),
    "marks": ("n_marks > 0.20 * n_words", "n_marks <= 0.05 * n_words"),
    "line_words": ("n_words < 3 * n_lines", "n_words >= 6 * n_lines"),
}

SHARE_GOOD, RIGHT_GOOD, RIGHT_BAD = 0.85, 0.998, 0.2

FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_lines", "n_letters", "n_upper", "n_marks", "n_echoes")


def _repeated(words: str) -> list[dict[str, Column]]:
    """Steps (columns added one after another) to the number of words inside
    windows of ``WINDOW`` words that occur twice or more."""
    n = F.size(words)
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    windows = F.when(n >= WINDOW, F.transform(
        F.sequence(F.lit(0), n - WINDOW),
        lambda i: F.xxhash64(*[F.get(F.col("__hash"), i + k) for k in range(WINDOW)])))
    some = F.size(F.array_distinct("__win")) < F.size("__win")
    pairs = F.when(some, F.sort_array(F.transform(
        "__win", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))

    def twice(p, j):
        same = (F.get(F.col("__pairs"), j - 1)["h"] == p["h"]) | (F.get(F.col("__pairs"), j + 1)["h"] == p["h"])
        return F.when(same, p["i"])

    starts = F.sort_array(F.filter(F.transform("__pairs", twice), lambda i: i.isNotNull()))
    reach = F.transform("__starts", lambda p, j: F.least(
        F.lit(WINDOW), F.coalesce(F.get(F.col("__starts"), j + 1) - p, F.lit(WINDOW))))
    covered = F.coalesce(F.aggregate(reach, F.lit(0), lambda a, x: a + x), F.lit(0))
    return [{"__hash": hashes}, {"__win": windows}, {"__pairs": pairs}, {"__starts": starts},
            {"n_repeat_words": covered.cast("long")}]


def with_features(docs: DataFrame, carry: list[str]) -> DataFrame:
    """``carry`` columns (as ``__c0``, ``__c1`` ... so that no name can clash) and the counts."""
    df = docs.select(*[F.col(f"`{c}`").alias(f"__c{i}") for i, c in enumerate(carry)],
                     text_of().alias("__text"))
    df = df.withColumn("__words", words_of(F.col("__text")))
    for step in _repeated("__words"):
        df = df.withColumns(step)
    lines = F.filter(F.split("__text", "\n", -1), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))
    df = df.withColumn("__lines", lines)
    length = lambda c: F.length(c).cast("long")
    without = lambda pattern: length(F.regexp_replace("__text", pattern, ""))
    df = df.withColumns({
        "n_words": F.size("__words").cast("long"),
        "word_chars": length(F.concat_ws("", "__words")),
        "n_echoes": F.size(F.filter("__words", lambda w, i: w == F.get(F.col("__words"), i - 1))).cast("long"),
        "n_marks": F.size(F.filter("__words", lambda w: ~w.rlike(r"[\p{L}\p{N}]"))).cast("long"),
        "n_symbols": length("__text") - without(r"[#*$%&|<>]+"),
        "n_lines": F.size("__lines").cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "n_letters": length("__text") - without(r"\p{L}+"),
        "n_upper": length("__text") - without(r"\p{Lu}+"),
    })
    return df.select(*[f"__c{i}" for i in range(len(carry))], *FEATURES)


def votes() -> dict[str, Column]:
    return {f"__v_{r}": F.when(F.expr(bad), -1).when(F.expr(good), 1).otherwise(0)
            for r, (bad, good) in RULES.items()}


def fit(patterns: dict[tuple[int, ...], int], rounds: int = 100) -> tuple[float, list[dict]]:
    """Expectation-maximisation over counts of vote patterns.

    Returns the log odds of a good document and, for each rule, the log odds that
    a vote adds; an abstention adds nothing.  The priors, worth one document in a
    hundred, fix which class is good: a rule seldom calls a good document bad
    (1 - ``RIGHT_GOOD``), and catches one bad document in five (``RIGHT_BAD``), since each
    looks for one kind of junk."""
    total = sum(patterns.values())
    n = len(RULES)
    if not total:
        return 0.0, [{-1: 0.0, 1: 0.0} for _ in range(n)]
    strength = 1 + 0.01 * total
    share = SHARE_GOOD
    right = [{1: RIGHT_GOOD, -1: RIGHT_BAD} for _ in range(n)]  # P(vote = class | class, the rule votes)
    weights: list[dict] = []
    prior = 0.0
    for _ in range(rounds):
        weights = [{1: math.log(r[1] / (1 - r[-1])), -1: math.log((1 - r[1]) / r[-1])} for r in right]
        prior = math.log(share / (1 - share))
        good_mass, hits = 0.0, [{1: [0.0, 0.0], -1: [0.0, 0.0]} for _ in range(n)]
        for pattern, count in patterns.items():
            logit = prior + sum(w[v] for w, v in zip(weights, pattern) if v)
            p = 1 / (1 + math.exp(-max(-60.0, min(60.0, logit))))
            good_mass += p * count
            for hit, v in zip(hits, pattern):
                if v:
                    hit[1][0] += p * count * (v == 1)
                    hit[1][1] += p * count
                    hit[-1][0] += (1 - p) * count * (v == -1)
                    hit[-1][1] += (1 - p) * count
        share = min(0.99, max(0.5, (good_mass + SHARE_GOOD * strength) / (total + strength)))
        right = [{1: min(0.999, max(0.7, (h[1][0] + RIGHT_GOOD * strength) / (h[1][1] + strength))),
                  -1: min(0.95, max(0.02, (h[-1][0] + RIGHT_BAD * strength) / (h[-1][1] + strength)))} for h in hits]
    return prior, weights


def judge(docs: DataFrame, carry: list[str], threshold: float = 0.5) -> DataFrame:
    """Counts, ``base_failed``, ``posterior`` and ``kept`` of every row, and the
    ``carry`` columns under ``__c<i>``."""
    df = stored(with_features(docs, carry), "quality")
    base = F.expr("n_words < 20 or 100 * n_repeat_words > 30 * n_words")
    # Documents that the base rule rejects need no verdict, and would teach the rules its kind of junk only.
    voted = df.filter(~base).select(*[v.alias(k) for k, v in votes().items()])
    rows = voted.groupBy(*voted.columns).count().collect()  # at most 3 ** rules rows
    prior, weights = fit({tuple(r[:-1]): r["count"] for r in rows})
    logit = F.lit(prior)
    for (_, vote), w in zip(votes().items(), weights):
        logit = logit + F.when(vote == 1, w[1]).when(vote == -1, w[-1]).otherwise(0.0)
    posterior = 1 / (1 + F.exp(-logit))
    return df.withColumns({"base_failed": base, "posterior": posterior,
                           "kept": ~base & (posterior >= threshold)})


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with its columns."""
    df = judge(docs, docs.columns).filter("kept")
    return df.select(*[F.col(f"__c{i}").alias(c) for i, c in enumerate(docs.columns)])


def report(docs: DataFrame) -> DataFrame:
    df = judge(docs, ["doc_id"])
    return df.select(F.col("__c0").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                     "n_repeat_words", "base_failed", "kept", "posterior")

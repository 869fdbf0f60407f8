"""Small tables with the awkward rows that every operator must take."""

from __future__ import annotations

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          # Columns that an operator might use as names of its own.
          "size long, shard int, cls long, n_words long, score double, root long, __size long, toxic int, fold int, "
          "__id long, __h long, __keep long, __keep_txt long, ___n long")


def vocabulary(seed: int, n: int = 400) -> list[str]:
    rnd = random.Random(seed)
    return ["".join(rnd.choice(["ka", "lo", "mi", "te", "ru", "éa", "zu"]) for _ in range(rnd.randint(1, 4))) for _ in range(n)]


def prose(rnd: random.Random, n: int, words: list[str]) -> str:
    out = [rnd.choice(words) for _ in range(n)]
    return "".join(w + rnd.choice([" ", " ", " ", ", ", ".\n"]) for w in out).strip()


def documents(seed: int = 7) -> list[tuple]:
    """(doc_id, text, source): nulls, empty and long texts, copies, near copies, junk."""
    rnd, words = random.Random(seed), vocabulary(seed)
    rows: list[tuple] = [(i, prose(rnd, rnd.randint(1, 120), words), f"s{i % 4}") for i in range(60)]
    base = prose(rnd, 90, words)
    rows += [(100 + i, base, "hot") for i in range(25)]                       # copies
    for i in range(12):                                                       # near copies
        w = base.split(" ")
        for _ in range(1 + i % 3):
            w[rnd.randrange(len(w))] = "other"
        rows.append((200 + i, " ".join(w), "hot"))
    passage = prose(rnd, 60, words)
    rows += [(300 + i, prose(rnd, 70, words) + "\n" + passage, "hot") for i in range(8)]
    rows += [(400, None, "s0"), (401, "", "s1"), (402, " \n\t ", None), (403, "one", None), (404, "ONE", None),
             (405, "a b c d", "s2"), (406, "A B  C\nD", "s2"), (407, "### $$$ %%% &&& " * 30, "s3"),
             (408, prose(rnd, 20_000, words), "s3"), (409, "line again\n" * 50, "s0"),
             (410, "same words here again " * 40, "s0"), (411, "x" * 50_000, "s1"), (412, "𝒳 ünï cödé " * 12, "s1")]
    rows += [rows[3], rows[3], (None, "no id at all " * 9, "s2"), (None, None, None)]
    return rows


def frame(spark, rows: list[tuple]):
    """``documents`` with all its columns and clashing ones."""
    return spark.createDataFrame(
        [(i, t, "en", s, len(t or ""), 1, 2, 3, 4, 0.5, 6, 7, 1, 1, 8, 8, 8, 8, 8) for i, t, s in rows], SCHEMA)


def rows_of(df) -> list[tuple]:
    return [tuple(r) for r in df.collect()]

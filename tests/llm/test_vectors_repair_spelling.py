"""Vector near-duplicates, conversation repair and spelling groups against brute force."""

import hashlib
import heapq
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchlake.llm import conversation_repair as repair
from matchlake.llm import spelling_groups as spelling
from matchlake.llm import vector_dedup as vectors

from . import cases


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


# ---------------------------------------------------------------- vectors

def usable(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute_vectors(rows, threshold=0.95):
    """(id, n_links, component_id) of rows (id, vector), compared pair by pair."""
    links, n = [], len(rows)
    for i in range(n):
        for j in range(i + 1, n):
            x, y = rows[i][1], rows[j][1]
            if usable(x) and usable(y) and len(x) == len(y):
                x, y = vectors.scaled(np.array([x, y], float))
                if x @ y / (math.sqrt(x @ x) * math.sqrt(y @ y)) >= threshold:
                    links.append((i, j))
    count, root = Counter(i for pair in links for i in pair), components(range(n), links)
    least = defaultdict(list)
    for i, r in root.items():
        least[r].append(rows[i][0])
    return Counter((rows[i][0], count[i], min((x for x in least[root[i]] if x is not None), default=None)) for i in range(n))


def vector_rows(dim=16, seed=5):
    rnd = np.random.default_rng(seed)
    rows = [rnd.normal(size=dim) for _ in range(120)]
    for spread in (0.02, 0.1, 0.18, 0.25):                       # groups about the threshold
        middle = rnd.normal(size=dim)
        rows += [middle + spread * rnd.normal(size=dim) for _ in range(25)]
    chain = rnd.normal(size=dim)
    for _ in range(12):                                          # only neighbours link
        chain = chain + 0.25 * rnd.normal(size=dim)
        rows.append(chain)
    rows = [v.astype(np.float32).astype(float).tolist() for v in rows]
    rows += [rows[3]] * 30 + [[-x for x in rows[3]], [1000 * x for x in rows[4]]]
    rows += [None, [], [0.0] * dim, [0.0, -0.0], [1.0, None], [float("nan")] + [1.0] * (dim - 1),
             [float("inf")] * dim, rows[5][:4], rows[5][:4], [1.0], [2.0], [-3.0]]
    ids = [i * 7 % 1009 for i in range(len(rows))]
    return [*zip(ids, rows), (None, rows[0]), (None, rows[150]), (3, rows[7]), (3, rows[7]), (None, None)]


def vector_frame(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, 1, 2, 3.0, 4) for i, v in rows],
                                 f"vec_id long, embedding array<{kind}>, label int, cls long, m double, k1 long").repartition(3)


@pytest.mark.parametrize("kind,tile", [("float", 8192), ("float", 16), ("double", 16)])
def test_vectors_equal_brute_force(spark, monkeypatch, kind, tile):
    """Small tiles: many cells, so the tests of what is within reach count."""
    monkeypatch.setattr(vectors, "TILE", tile)
    rows = vector_rows()
    got = vectors.report(vector_frame(spark, rows, kind)).collect()
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in got) == brute_vectors(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_vectors_of_an_empty_table_and_other_thresholds(spark):
    empty = vector_frame(spark, [])
    assert vectors.report(empty).collect() == [] and vectors.report(empty.filter("false")).columns == [
        "vec_id", "n_links", "component_id", "kept"]
    only_bad = vector_frame(spark, [(1, None), (2, [0.0])])
    assert sorted(map(tuple, vectors.report(only_bad).collect())) == [(1, 0, 1, True), (2, 0, 2, True)]
    rows = [(i, v) for i, v in vector_rows() if v][:180]
    got = vectors.near_duplicates(vector_frame(spark, rows), threshold=0.6).collect()
    assert Counter(map(tuple, got)) == brute_vectors(rows, 0.6)
    with pytest.raises(ValueError):
        vectors.near_duplicates(empty, threshold=0.0)


def test_codes_are_within_their_bounds():
    rnd = np.random.default_rng(1)
    rows = rnd.normal(size=(200, 64)) * np.exp(rnd.normal(size=(200, 1)) * 20)
    codes = vectors.Codes(rows)
    unit = rows / np.linalg.norm(rows, axis=1)[:, None]
    about = codes.product(slice(None), codes, slice(None)) * np.outer(codes.scale, codes.scale)
    e = codes.error
    assert (np.abs(unit @ unit.T - about) <= e[:, None] + e + np.outer(e, e)).all()
    assert np.abs(codes.codes).max() == 127 and (codes.codes == np.rint(codes.codes)).all()
    long = vectors.Codes(rnd.normal(size=(20, 5000)))          # sums beyond 2^24 are taken in slices
    exact = long.codes.astype(np.int64) @ long.codes.astype(np.int64).T
    assert (long.product(slice(None), long, slice(None)) == exact).all()


def test_only_open_pairs_are_recomputed():
    """A group far above the threshold and strangers need no double precision."""
    rnd = np.random.default_rng(2)
    middle = rnd.normal(size=64)
    rows = np.vstack([middle + 0.01 * rnd.normal(size=(300, 64)), rnd.normal(size=(300, 64))])
    codes, told = vectors.Codes(rows), []
    linked = sum(len(i) for i, _ in vectors.tile_links(codes, codes, 0.95, told))
    assert linked == 300 * 299 // 2 and sum(told) < 50


def test_blocks_of_a_tile_find_the_same_links(monkeypatch):
    rnd = np.random.default_rng(6)
    rows = np.vstack([m + 0.15 * rnd.normal(size=(20, 8)) for m in rnd.normal(size=(10, 8))])
    codes = vectors.Codes(rows)
    pairs = lambda: {p for i, j in vectors.tile_links(codes, codes, 0.95) for p in zip(i.tolist(), j.tolist())}
    whole = pairs()
    monkeypatch.setattr(vectors, "BLOCK", 7)
    assert pairs() == whole and len(whole) > 100
    forest = vectors.Forest(len(rows))
    forest.add(*np.array(sorted(whole)).T)
    assert len(forest.links) < len(rows) and components(range(200), forest.links) == components(range(200), whole)


def test_equal_vectors_are_compared_once(spark, monkeypatch):
    seen = []
    real = vectors.links
    monkeypatch.setattr(vectors, "links", lambda classes, t: seen.append(classes.count()) or real(classes, t))
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(500)] + [(1000 + i, [1.0, float(i), 0.0]) for i in range(40)]
    got = {r.vec_id: r for r in vectors.report(vector_frame(spark, rows)).collect()}
    assert seen == [41] and all(got[i].n_links == 499 and got[i].component_id == 0 for i in range(500))


# ---------------------------------------------------------------- conversation repair

def damaged(rows):
    """Rows (conv_id, turn, role, text) after damage, by the contract's words."""
    out = []
    for conv, turn, role, text in rows:
        said = [" " if x is None else x for x in (conv, turn, role, text)]
        kind = zlib.crc32(f"{said[0]}:{said[1]}".encode()) % 20
        role, text = said[2], said[3]
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def cheapest(symbols):
    """(cost, audit) by best-first search over (cost, audit): symbols are (initial, must go, truncated)."""
    queue, seen = [(0, "", 0, 0)], set()
    while queue:
        cost, audit, at, state = heapq.heappop(queue)
        if (at, state) in seen:
            continue
        seen.add((at, state))
        if at == len(symbols) and state in (0, 3):
            return cost, audit
        step = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}[state]
        for role in "ua":
            if role in step:
                heapq.heappush(queue, (cost + 2, audit + "I", at, step[role]))
        if at < len(symbols):
            initial, gone, truncated = symbols[at]
            heapq.heappush(queue, (cost + 3, audit + "D", at + 1, state))
            if not gone:
                if initial in step:
                    heapq.heappush(queue, (cost + truncated, audit + "K", at + 1, step[initial]))
                for role in "ua":
                    if role in step:
                        heapq.heappush(queue, (cost + 2 + truncated, audit + "R", at + 1, step[role]))


def brute_repair(rows, damage=damaged):
    groups = defaultdict(list)
    for row in damage(rows):
        groups[row[0]].append(row)
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted(groups[conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).hexdigest()))
        symbols, seen, n, illegal = [], set(), Counter(), 0
        for _, _, role, text in mine:
            core = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else ""
            seen.add((role, text))
            n[fault] += 1
            symbols.append((role[:1], fault in ("blank", "duplicate"), int(fault == "truncated")))
        initials = [s[0] for s in symbols]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = cheapest(symbols)
        state, kept, at = 0, [], 0
        for letter in audit:
            role, text = ("assistant" if state == 2 else "user"), ""
            if letter != "I":
                own, text = mine[at][2:]
                role = own if letter == "K" else role
                at += 1
            if letter != "D":
                kept.append(f"{role}:{text}")
                state = {"s": 1, "u": 2, "a": 3}[role[0]]
        assert re.fullmatch("(s?(ua)+)?", "".join(k[0] for k in kept))
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit,
                     hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


def conversation_rows(seed=11, many=150):
    rnd, rows = random.Random(seed), []
    texts = ["Yes.", "No!", "Why?", "well", "and then ", "ok. \n", "", " \t", None, "Yes. ", "naïve…", "So. "]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, "", "unknown", "Assistant"]
    for conv in range(many):
        role = "user"
        for turn in range(rnd.randint(1, 12)):
            role = rnd.choice(roles) if rnd.random() < 0.3 else {"user": "assistant"}.get(role, "user")
            text = rnd.choice(texts) if rnd.random() < 0.4 else f"turn {turn} of {conv}{rnd.choice('.?!,')}"
            rows.append((conv, rnd.choice([turn, turn, turn, turn * 2, None]), role, text))
    rows += [(None, t, "user", "no id.") for t in range(4)] + [(-1, None, None, None), (-2, 5, "assistant", "alone.")]
    rows += rows[:6]                                             # repeated rows
    rows += [(9_000 + c, t, "user", "u.") for c in range(300) for t in range(1)]   # some lose their only row
    return rows


def conversation_frame(spark, rows, kind="long"):
    return spark.createDataFrame([(None if c is None else str(c) if kind == "string" else c, *r, "x", 1, "y") for c, *r in rows],
                                 f"conv_id {kind}, turn long, role string, text string, key string, seq long, audit string").repartition(4)


def told(df):
    rows = df.collect()
    out = {r.conv_id: tuple(r)[1:] for r in rows}
    assert len(out) == len(rows)
    return out


def test_repair_equals_brute_force(spark):
    rows = conversation_rows()
    got, want = told(repair.report(conversation_frame(spark, rows))), brute_repair(rows)
    assert got == want
    assert any(w[6] == "" and w[7] == hashlib.sha256(b"").hexdigest() for w in want.values())
    assert set("KRDI") <= set("".join(w[6] for w in want.values()))


def test_repair_in_small_pieces(spark):
    """Conversations that span several pieces, and one that holds a third of all rows, give the same rows."""
    rows = conversation_rows(seed=12, many=60)
    rnd = random.Random(3)
    rows += [(500, t, rnd.choice(["user", "assistant"]), rnd.choice(["Same.", f"t{t}.", f"t{t}"])) for t in range(len(rows) // 2)]
    df = conversation_frame(spark, rows)
    cut = repair.pieces(repair._damaged(df), 3)
    assert cut.agg(F.max(F.length("symbols"))).first()[0] == 3
    out = repair.repaired(repair._damaged(df), df.select("conv_id"), 3)
    assert told(out.select(repair.report(df).columns)) == brute_repair(rows)


def test_repair_of_text_ids_and_of_an_empty_table(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Hello."), (2, 0, "system", "Be kind."), (3, 0, "assistant", "So?")]
    got = told(repair.repaired(conversation_frame(spark, rows, "string"), conversation_frame(spark, rows, "string").select("conv_id"))
               .select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"))
    assert got == {str(k): v for k, v in brute_repair(rows, damage=list).items()}
    assert repair.report(conversation_frame(spark, [])).collect() == []


def test_matrices_of_rules_equal_those_of_their_symbols():
    rnd = random.Random(4)
    texts = ["".join(rnd.choice("uauauasXUo") for _ in range(rnd.randint(1, 40))) for _ in range(30)]
    rules = ["ua", "au", chr(repair.FIRST_RULE) + "u", chr(repair.FIRST_RULE) * 2]
    of = repair.evaluate(rules)
    plain = lambda m: {k: (c, str(a)) for k, (c, a) in m.items()}
    for text in texts:
        assert plain(repair.matrix_of(repair.encode(text, rules), of)) == plain(repair.matrix_of(text, of))
        found = repair.matrix_of(text, of)
        end = repair.closing()
        best = min((c + end[j][0], str(a) + end[j][1]) for (i, j), (c, a) in found.items() if i == 0 and j in end)
        assert best == cheapest([(s.lower(), s == "X", int(s.isupper())) for s in text])


def test_grammar_covers_the_pieces(spark):
    texts = ["uauaua", "suaua", "uauauaua", "ua", "sua", "X"]
    rules = repair.grammar(spark.createDataFrame([(t,) for t in texts], "symbols string"))
    assert rules and len(repair.encode("uauauaua", rules)) <= 2
    assert repair.grammar(spark.createDataFrame([], "symbols string")) == []
    for k, (left, right) in enumerate(rules):                    # only earlier symbols
        assert all(s in repair.TERMINALS or ord(s) < repair.FIRST_RULE + k for s in (left, right))


# ---------------------------------------------------------------- spelling

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_vocabulary(rows, damage=97):
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(ASCII)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if damage and h % damage == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            count[word] += 1
    return {w: n for w, n in count.items() if n >= 3 and len(w) >= 5}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(words):
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        if best and words[best] >= 2 * words[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w
    return {(w, form.get(w), root(w), n, len(near[w]), words[form[w]] if w in form else None) for w, n in words.items()}


def test_spelling_equals_brute_force(spark):
    rnd = random.Random(8)
    words = ["".join(rnd.choice("aeiorstnéÉß") for _ in range(rnd.randint(4, 11))) for _ in range(40)]
    for w in list(words):                                        # edits of edits
        for _ in range(4):
            k = rnd.randrange(len(w))
            w = rnd.choice([w[:k] + w[k + 1:], w[:k] + rnd.choice("aeiz÷×") + w[k:], w[:k] + rnd.choice("aeÿ") + w[k + 1:]])
            words.append(w)
    words += ["".join(p) for p in zip("listensilent", "silentlisten")] + ["listen", "silent", "enlist"]   # one multiset, far apart
    rows = [(i, rnd.choice([" ", "-", "1", "\n"]).join(rnd.choices([rnd.choice((w, w.upper(), w.title())) for w in words], k=60)))
            for i in range(80)]
    rows += [(900, " ".join(f"{w} " * rnd.choice((0, 3, 8, 20, 60)) for w in words)), (901, None), (902, ""), (903, "12 34"),
             (None, "loose loose loose"), (904, "aaaaa " * 9 + "aaaaaa " * 4 + "aaaaaaa " * 3)]
    rows += rows[:2]
    df = cases.frame(spark, [(i, t, "s") for i, t in rows]).withColumns({"word": F.lit(1), "n": F.lit(2)}).repartition(4)
    vocabulary = brute_vocabulary(rows)
    assert {r.word: r.n for r in spelling.vocabulary(df).collect()} == vocabulary
    got = spelling.report(df).collect()
    assert {tuple(r) for r in got} == brute_variants(vocabulary) and len(got) == len(vocabulary)
    assert any(r.root not in (r.word, r.form) for r in got if r.form)


def test_spelling_of_awkward_tables(spark):
    df = cases.frame(spark, cases.documents())
    got = spelling.report(df).collect()
    assert {tuple(r) for r in got} == brute_variants(brute_vocabulary([r[:2] for r in cases.documents()]))
    assert spelling.report(cases.frame(spark, [])).collect() == []
    assert spelling.report(cases.frame(spark, [(1, "once only here", "s")])).collect() == []


def test_long_texts_are_counted_in_parts(monkeypatch):
    text = "alpha beta gamma-delta Éclair " * 50
    monkeypatch.setattr(spelling, "_LONG", 80)
    parts = list(spelling._runs(text.lower()))
    assert len(parts) > 10 and sum(parts, Counter()) == Counter(w for w in re.findall("[a-zÀ-ÿ]+", text.lower()) if len(w) >= 5)


def test_letters_are_dealt_once(spark):
    words = spark.createDataFrame([("lettre",), ("letter",), ("zèbre",)], "word string")
    for n in (2, 3):
        deal = spelling.parts(words, n)
        assert len(deal) == n and sorted("".join(deal)) == sorted(set("lettrezèb"))

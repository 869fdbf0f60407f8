"""Conversation structure repair by a grammar-compressed shortest-path programme.

A conversation's rows, in turn order, are symbols: the class of the role's initial (s, u, a or
another) and whether the row must go (blank or a repetition) or is truncated.  Edits keep (K), rerole (R),
delete (D) or insert (I) rows so that the initials of the roles read ``(s?(ua)+)?``.  The states of
that pattern are four, so every symbol is a 4 x 4 matrix of (cost, audit) under
"cheapest, then least audit"; a sequence of symbols is the product of their matrices.

1. Spark marks the rows (blank, repeated, truncated) and sorts them by range, so that a
   conversation of any length is read by several tasks.  Each writes pieces of at most ``PIECE``
   symbols with their counts.
2. Re-Pair over the distinct pieces of all conversations: every round counts the pairs of neighbouring
   symbols by a Spark aggregate and makes rules of the most frequent ones that do not overlap, until no pair
   occurs twice or there are ``MOST_RULES`` (a bound on what is broadcast; symbols
   left over are multiplied one by one, with the same result).
3. One matrix per rule, evaluated bottom-up from those of its two symbols.  Audits are ropes: a pair
   of ropes, flattened only where equal costs must be compared.  The matrices are broadcast and
   shared by all conversations.
4. Every distinct piece gets its matrix.  Pieces of one conversation are chained by
   costs and by the order of their audits alone (32 numbers a piece); audits of different end
   states always differ before either ends, so the order within a piece decides.
5. Audits, in pieces, and rows meet once more, sorted, and the repaired conversation streams through its hash.
   Here one conversation is one task, as SHA-256 must read it in order; the task holds the
   audit, which is a column of the result, and one row.

Defined cases: nulls in conv_id, turn, role and text are one space in checksum, role and text; a null conv_id is a
conversation; a turn that is no integer counts as null in order and gaps; rows with equal turn go by role, then by
the text's MD5; repeated rows repeat each other, so all but one are duplicates; an empty role, and any
initial but s, u and a, can only be reroled or deleted; no rows after damage give zeros, an empty
audit and the hash of the empty text; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby, islice, product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.combine import spread_join
from .common import ship, stored

PIECE = 4_096
MOST_RULES = 1_024
ROUNDS = 8               # so a rule stands for at most 2^8 symbols
RULES_A_ROUND = 256
DAMAGE = 20

SPACE = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")

# Symbols: the initial's class, in capitals if truncated; X must be deleted.
GONE, OTHER = "X", "o"
TERMINALS = "suaoSUAOX"
FIRST_RULE = 0xE000    # rules are characters of the private use area

STATES = range(4)      # 0 nothing yet, 1 after s, 2 after u, 3 after a
ACCEPTED = (0, 3)
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}


# ---------------------------------------------------------------- matrices of (cost, audit)

class Rope:
    """A text or two ropes; flattened at most once, when its letters are needed."""

    __slots__ = ("_parts", "_text")

    def __init__(self, *parts):
        self._text = parts[0] if isinstance(parts[0], str) else None
        self._parts = parts

    def __str__(self) -> str:
        if self._text is None:
            out, todo = [], [self]
            while todo:
                rope = todo.pop()
                if rope._text is not None:
                    out.append(rope._text)
                else:
                    todo += reversed(rope._parts)
            self._text = "".join(out)
            self._parts = ()
        return self._text


Matrix = dict[tuple[int, int], tuple[int, Rope]]


def _offer(m: Matrix, at: tuple[int, int], cost: int, audit: Rope) -> None:
    old = m.get(at)
    if old is None or cost < old[0] or cost == old[0] and str(audit) < str(old[1]):
        m[at] = (cost, audit)


def times(x: Matrix, y: Matrix) -> Matrix:
    out: Matrix = {}
    for (i, k), (c, a) in x.items():
        for j in STATES:
            if (step := y.get((k, j))) is not None:
                _offer(out, (i, j), c + step[0], Rope(a, step[1]))
    return out


def role_after(state: int) -> tuple[str, int]:
    """The role that a row without one of its own takes in a state, and the state after it."""
    return ("assistant", 3) if state == 2 else ("user", 2)


def keeps(state: int, initial: str) -> int | None:
    """The state after a row with this initial is kept, None where it cannot be."""
    after = {"s": 1, "u": 2, "a": 3}.get(initial)
    return after if (initial, state) in {("s", 0), ("u", 0), ("u", 1), ("u", 3), ("a", 2)} else None


def insertions() -> Matrix:
    """Any number of inserted rows (the least number that leads from one state to another)."""
    out: Matrix = {(i, i): (0, Rope("")) for i in STATES}
    for i in STATES:
        state, n = i, 0
        while (state := role_after(state)[1]) != i and (i, state) not in out:
            n += 1
            out[i, state] = (COST[INSERT] * n, Rope(INSERT * n))
    return out


def terminal(symbol: str) -> Matrix:
    """One row: insertions before it, then what may become of it."""
    row: Matrix = {}
    for i in STATES:
        _offer(row, (i, i), COST[DELETE], Rope(DELETE))
        if symbol != GONE:
            more = int(symbol.isupper())
            if (j := keeps(i, symbol.lower())) is not None:
                _offer(row, (i, j), COST[KEEP] + more, Rope(KEEP))
            _offer(row, (i, role_after(i)[1]), COST[REROLE] + more, Rope(REROLE))
    return times(insertions(), row)


def evaluate(rules: list[str]) -> dict[str, Matrix]:
    """Matrices of all symbols, rules (pairs of earlier symbols) bottom-up."""
    out = {t: terminal(t) for t in TERMINALS}
    for k, (left, right) in enumerate(rules):
        out[chr(FIRST_RULE + k)] = times(out[left], out[right])
    return out


def matrix_of(symbols: str, of: dict[str, Matrix]) -> Matrix:
    out: Matrix = {(i, i): (0, Rope("")) for i in STATES}
    for s in symbols:
        out = times(out, of[s])
    return out


# ---------------------------------------------------------------- the grammar

def encode(text: str, rules: list[str]) -> str:
    for k, pair in enumerate(rules):
        text = text.replace(pair, chr(FIRST_RULE + k))
    return text


def _pairs(rules: list[str]):
    """Distinct pieces -> (pair, n) of neighbouring symbols, per batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = encode("\n".join(batch.column(0).to_pylist()), rules)
            code = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
            both = (code[:-1] != 10) & (code[1:] != 10)
            pairs, n = np.unique((code[:-1] << np.uint64(32) | code[1:])[both], return_counts=True)
            if len(pairs):
                names = [chr(int(p) >> 32) + chr(int(p) & 0xFFFFFFFF) for p in pairs]
                yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(n.astype(np.int64))], names=["pair", "n"])
    return run


def _apart(pairs: list[str]) -> list[str]:
    """Those that share no occurrence with an earlier one: no symbol ends one and begins another."""
    begins, ends, out = set(), set(), []
    for left, right in pairs:
        if left not in ends and right not in begins:
            begins.add(left)
            ends.add(right)
            out.append(left + right)
    return out


def grammar(pieces: DataFrame) -> list[str]:
    """Rules of Re-Pair over the distinct texts ``symbols``, as pairs of symbols, in order."""
    rules: list[str] = []
    for _ in range(ROUNDS):
        counts = pieces.select("symbols").mapInArrow(_pairs(rules), "pair string, n long")
        counts = counts.groupBy("pair").agg(F.sum("n").alias("n")).filter("n > 1")
        most = [r.pair for r in counts.orderBy(F.desc("n"), "pair").limit(RULES_A_ROUND).collect()]
        new = _apart(most)[:MOST_RULES - len(rules)]
        if not new:
            break
        rules += new
    return rules


# ---------------------------------------------------------------- rows, faults, pieces

def _damaged(conversations: DataFrame) -> DataFrame:
    space = F.lit(" ")
    rows = conversations.select(
        "conv_id", F.col("turn").cast("string").try_cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), space).alias("role"), F.coalesce(F.col("text").cast("string"), space).alias("text"),
        (F.crc32(F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space),
                             F.coalesce(F.col("turn").cast("string"), space))) % DAMAGE).alias("kind"))
    rows = rows.filter("kind <> 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
    return rows.drop("copy")


def _key(conv_id: Column) -> Column:
    """Text for a conversation; no id gives that of null."""
    return F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit(""))


def _narrow(rows: DataFrame) -> DataFrame:
    """(key, turn, role, md5, initial, blank, truncated): all that the programme reads of a row."""
    trimmed = F.rtrim(F.col("text"), F.lit(SPACE))
    initial = F.substring("role", 1, 1)
    return rows.select(
        _key(F.col("conv_id")).alias("key"), "turn", "role", F.unhex(F.md5("text")).alias("md5"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise(OTHER).alias("initial"),
        (trimmed == "").alias("blank"), (~F.substring(trimmed, -1, 1).isin(*ENDS)).alias("truncated"))


ORDER = ["key", "turn", "role", "md5"]
PIECES = ("key string, seq long, symbols string, initials string, least long, most long, turns long, first_turn long, "
          "last_turn long, blank long, duplicate long, truncated long")
_PIECES = pa.schema([
    ("key", pa.string()), ("seq", pa.int64()), ("symbols", pa.string()), ("initials", pa.string()), ("least", pa.int64()),
    ("most", pa.int64()), ("turns", pa.int64()), ("first_turn", pa.int64()), ("last_turn", pa.int64()), ("blank", pa.int64()),
    ("duplicate", pa.int64()), ("truncated", pa.int64())])


def _to_pieces(size: int):
    """Sorted rows (key, turn, initial, blank, again, truncated) -> a row of PIECES each ``size`` rows or less."""
    def piece(key: str, seq: int, rows: list[tuple]) -> tuple:
        symbols, faults = [], {"blank": 0, "again": 0, "truncated": 0}
        for _, _, initial, *flags in rows:
            fault = next((f for f, flag in zip(faults, flags) if flag), None)
            if fault:
                faults[fault] += 1
            symbols.append(initial.upper() if fault == "truncated" else GONE if fault else initial)
        turns = [r[1] for r in rows if r[1] is not None]
        ends = (turns[0], turns[-1]) if turns else (None, None)
        return (key, seq, "".join(symbols), "".join(r[2] for r in rows), *ends, len(set(turns)), *ends, *faults.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        seq = TaskContext.get().partitionId() << 40    # partitions follow each other in order
        out: list[tuple] = []
        for key, group in groupby(_tuples(batches), key=lambda r: r[0]):
            while part := list(islice(group, size)):
                out.append(piece(key, seq, part))
                seq += 1
                if len(out) >= 5_000:
                    yield _batch(out, _PIECES)
                    out = []
        if out:
            yield _batch(out, _PIECES)
    return run


def _tuples(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def pieces(rows: DataFrame, size: int = PIECE) -> DataFrame:
    """Pieces of the conversations of ``rows`` (conv_id, turn, role, text), in the order of ``seq``."""
    narrow = stored(_narrow(rows).withColumn("tie", F.monotonically_increasing_id()), "rows")  # numbered once, in the file
    again = narrow.filter("not blank").groupBy("key", "role", "md5").agg(
        F.count("*").alias("n"), F.min(F.struct("turn", "tie")).alias("first")).filter("n > 1")
    again = again.select("key", "role", "md5", F.col("first.tie").alias("first"))
    # A text that recurs in a conversation without end is one row here; AQE splits the rows.
    marked = spread_join(narrow, again, ["key", "role", "md5"], "left")
    marked = marked.withColumn("again", ~F.col("blank") & (F.coalesce(F.col("first"), F.col("tie")) != F.col("tie")))
    marked = marked.select(*ORDER, "tie", "initial", "blank", "again", "truncated")
    ordered = marked.repartitionByRange(*ORDER, "tie").sortWithinPartitions(*ORDER, "tie")
    return stored(ordered.select("key", "turn", "initial", "blank", "again", "truncated").mapInArrow(_to_pieces(size), PIECES), "pieces")


# ---------------------------------------------------------------- chaining and repair

_SOLVED = "symbols string, costs array<long>, ranks array<int>, audits array<string>"


def _solve(rules_of):
    """Distinct pieces -> costs, order and audits of their 16 ways (null: no way)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules, of = rules_of.value
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                out = []
                for symbols in batch.column(0).slice(at, 500).to_pylist():
                    m = matrix_of(encode(symbols, rules), of)
                    ways = [m.get(p) for p in product(STATES, STATES)]
                    audits = [w and str(w[1]) for w in ways]
                    rank = {a: k for k, a in enumerate(sorted({a for a in audits if a is not None}))}
                    out.append((symbols, [w and w[0] for w in ways], [a is not None and rank[a] for a in audits], audits))
                yield pa.RecordBatch.from_arrays([
                    pa.array([o[0] for o in out]), pa.array([o[1] for o in out], pa.list_(pa.int64())),
                    pa.array([[int(r) for r in o[2]] for o in out], pa.list_(pa.int32())),
                    pa.array([o[3] for o in out], pa.list_(pa.string()))], names=["symbols", "costs", "ranks", "audits"])
    return run


CHOSEN = ("key string, seq long, way int, tail string, cost long, gaps long, blank long, duplicate long, truncated long, "
          "illegal long")
_CHOSEN = pa.schema([("key", pa.string()), ("seq", pa.int64()), ("way", pa.int32()), ("tail", pa.string())] + [
    (n, pa.int64()) for n in ("cost", "gaps", "blank", "duplicate", "truncated", "illegal")])
_LEGAL = {"su", "ua", "au"}


def closing() -> dict[int, tuple[int, str]]:
    """Of each state: what it costs to end there, and the insertions."""
    out = {}
    for (i, j), (cost, audit) in insertions().items():
        if j in ACCEPTED:
            out[i] = min(out.get(i, (cost, str(audit))), (cost, str(audit)))
    return out


def _choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces with costs and ranks, those of a conversation in order -> the way through each piece,
    and with the last one the totals."""
    end = closing()

    def conversation(key: str, parts: list[tuple]) -> Iterator[tuple]:
        # What it costs to go on from each state, at the end of each piece.
        onward = [{j: end[j][0] for j in STATES}]
        for _, _, costs, *_ in reversed(parts):
            after = onward[-1]
            onward.append({i: min((costs[4 * i + j] + after[j] for j in STATES if costs[4 * i + j] is not None and j in after),
                                  default=None) for i in STATES})
            onward[-1] = {i: c for i, c in onward[-1].items() if c is not None}
        onward.reverse()
        state, total, illegal, last, sums, turns = 0, onward[0][0], 0, None, [0, 0, 0], [None, None, 0, None]
        for k, (_, seq, costs, ranks, first, final, steps, least, most, n, begins, ends, *faults) in enumerate(parts):
            after = onward[k + 1]
            j = min((j for j in STATES if costs[4 * state + j] is not None and j in after),
                    key=lambda j: (costs[4 * state + j] + after[j], ranks[4 * state + j]))
            way, state = 4 * state + j, j
            illegal += steps + (last is not None and last + first not in _LEGAL)
            last = final
            sums = [x + y for x, y in zip(sums, faults)]
            if n:                                       # turns rise from piece to piece
                turns = [least if turns[0] is None else turns[0], most, turns[2] + n - (turns[3] == begins), ends]
            done = k == len(parts) - 1
            gaps = 0 if turns[0] is None else turns[1] - turns[0] + 1 - turns[2]
            yield (key, seq, way, end[state][1], total, gaps, *sums, illegal) if done else (key, seq, way, "", *[None] * 6)

    out: list[tuple] = []
    for key, parts in groupby(_tuples(batches), key=lambda r: r[0]):
        out += conversation(key, list(parts))
        if len(out) >= 10_000:
            yield _batch(out, _CHOSEN)
            out = []
    if out:
        yield _batch(out, _CHOSEN)


def _illegal(initials: Column) -> Column:
    """Neighbours in a piece that are not su, ua or au: all pairs less those."""
    legal = F.regexp_count(initials, F.lit("(?=su|ua|au)"))
    return (F.length(initials) - 1 - legal).cast("long")


def audits(cut: DataFrame) -> DataFrame:
    """(key, seq, audit, cost, gaps, blank, duplicate, truncated, illegal) of the pieces; totals
    stand in the last one of a conversation."""
    spark = cut.sparkSession
    ship(spark)
    distinct = stored(cut.select("symbols").distinct(), "symbols")
    rules = grammar(distinct)
    shared = spark.sparkContext.broadcast((rules, _plain(evaluate(rules))))
    solved = stored(distinct.mapInArrow(_solve(shared), _SOLVED), "solved")
    both = stored(spread_join(cut, solved, "symbols"), "solved-pieces")  # a sequence may be that of many conversations
    chain = both.select("key", "seq", "costs", "ranks", F.substring("initials", 1, 1), F.substring("initials", -1, 1),
                        _illegal(F.col("initials")), "least", "most", "turns", "first_turn", "last_turn",
                        "blank", "duplicate", "truncated")
    chosen = chain.repartition("key").sortWithinPartitions("key", "seq").mapInArrow(_choose, CHOSEN)
    picked = both.select("key", "seq", "audits").join(chosen, ["key", "seq"])
    return picked.select("key", "seq", F.concat(F.element_at("audits", F.col("way") + 1), "tail").alias("audit"),
                         "cost", "gaps", "blank", "duplicate", "truncated", "illegal")


def _plain(of: dict[str, Matrix]) -> dict[str, Matrix]:
    """With flat ropes, as they are sent."""
    return {s: {at: (c, Rope(str(a))) for at, (c, a) in m.items()} for s, m in of.items()}


def _repair(schema: pa.Schema):
    """Sorted rows (key, kind, seq, role, text, conv_id, totals...) -> one row a conversation.

    kind 0: the conversation and its id; 1: pieces of the audit, totals in the last; 2: rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def conversations():
            for _, group in groupby(_tuples(batches), key=lambda r: r[0]):
                conv, audit, totals = None, [], (0,) * 6
                letters, state, digest, first = "", 0, hashlib.sha256(), True
                at = -1

                def put(role: str, text: str) -> None:
                    nonlocal first
                    digest.update((role + ":" + text if first else "\n" + role + ":" + text).encode())
                    first = False

                def inserted() -> None:
                    nonlocal at, state
                    while at < len(letters) and letters[at] == INSERT:
                        role, state = role_after(state)
                        put(role, "")
                        at += 1

                for _, kind, _, role, text, conv_id, piece, *sums in group:
                    if kind == 0:
                        conv = conv_id
                        continue
                    if kind == 1:
                        audit.append(piece)
                        totals = sums if sums[0] is not None else totals
                        continue
                    if at < 0:
                        letters, at = "".join(audit), 0
                    inserted()
                    letter = letters[at]
                    at += 1
                    if letter == KEEP:
                        state = keeps(state, role[:1])
                        put(role, text)
                    elif letter == REROLE:
                        role, state = role_after(state)
                        put(role, text)
                if at >= 0:
                    inserted()
                yield (conv, *totals, letters, digest.hexdigest())

        out, weight = [], 0
        for row in conversations():
            out.append(row)
            weight += 400 + len(row[-2])
            if weight > 4_000_000:
                yield _batch(out, schema)
                out, weight = [], 0
        if out:
            yield _batch(out, schema)
    return run


TOTALS = ["cost", "gaps", "blank", "duplicate", "truncated", "illegal"]


def repaired(rows: DataFrame, ids: DataFrame, size: int = PIECE) -> DataFrame:
    """One row a conversation of ``ids`` (conv_id) with what repairing ``rows`` (conv_id, turn, role, text) takes."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    found = audits(pieces(rows, size))
    none = {"seq": "long", "turn": "long", "role": "string", "md5": "binary", "text": "string", "audit": "string",
            **dict.fromkeys(TOTALS, "long")}
    given = ids.schema["conv_id"]
    columns = ["key", "kind", "seq", "turn", "role", "md5", "text", "conv_id", "audit", *TOTALS]

    def filled(df: DataFrame, kind: int) -> DataFrame:
        df = df.withColumn("kind", F.lit(kind))
        more = {**none, "conv_id": given.dataType.simpleString()}
        return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(more[c]).alias(c) for c in columns])

    head = ids.groupBy(_key(F.col("conv_id")).alias("key")).agg(F.first("conv_id").alias("conv_id"))
    body = rows.select(_key(F.col("conv_id")).alias("key"), "turn", "role", "text", F.unhex(F.md5("text")).alias("md5"))
    all_rows = filled(head, 0).unionByName(filled(found, 1)).unionByName(filled(body, 2))
    dealt = all_rows.repartition("key").sortWithinPartitions("key", "kind", "seq", "turn", "role", "md5")
    result = StructType([StructField("conv_id", given.dataType)] + [StructField(c, LongType()) for c in TOTALS]
                        + [StructField("audit", StringType()), StructField("repaired_sha256", StringType())])
    return dealt.select("key", "kind", "seq", "role", "text", "conv_id", "audit", *TOTALS).mapInArrow(
        _repair(to_arrow_schema(result)), result)


def report(conversations: DataFrame) -> DataFrame:
    """All conversations, damaged by a checksum and repaired."""
    out = repaired(_damaged(conversations), conversations.select("conv_id"))
    return out.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")

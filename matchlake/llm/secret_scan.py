"""Secret scans with an incremental blob ledger.

Every version of a text is addressed by its content (sha256).  The ledger holds
a row for each (blob, rule, rule version) that was scanned, with its findings;
a scan reads only pairs that the ledger lacks, and findings are joined back to all
documents (paths) that hold the blob.  A text copied a thousand times, or seen in
an earlier run, is scanned once; a new version of one rule rescans for that rule alone.

Plan: one narrow pass gives (doc_id, blob); one document per unseen blob is picked by an
aggregate; a join on (blob, doc_id) brings the texts to scan (its key is
different for every copy, so a group of copies is no hot key); the findings, a
small table, are joined to (doc_id, blob) so that AQE can split the rows of a blob that
very many documents hold.  Built-in functions only.

``update`` keeps the ledger at a path and appends to it.  The query makes two runs over one ledger.

Positions come without a scan character by character: ``split`` gives the text
between matches, ``regexp_extract_all`` the matches, and a window's running sum of their
lengths the code points where each starts (linear in the matches of a text).

Defined cases: null text is the empty blob, without findings; repeated rows each
get the findings of their blob; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..operators.combine import spread_join
from .common import path_exists, scratch, stored, text_of


@dataclass(frozen=True)
class Rule:
    kind: str
    version: int
    pattern: str           # leftmost matches, one after another
    group: int = 0         # the group whose length counts
    least: int = 0         # drop a match whose group is shorter

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.version}"


# The rules, in the order in which spans that start together are listed.
# Runs shorter than asked for cannot hold a longer match, so for access and hex the
# length stands in the pattern; assign drops a match whose value is too short.
RULES = (
    Rule("assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         2, 8),
    Rule("access", 1, r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", 1, r"[0-9a-f]{32,}"),
)

SPAN = "struct<start: int, ord: int, end: int, kind: string>"
LEDGER = f"blob string, rule string, version int, spans array<{SPAN}>"
ARRIVALS = 2  # runs in which the query takes its table


def pieces_of(text: Column, rule: Rule) -> Column:
    """Array of (gap, len, size): for each match the code points since the one before, its own, and
    those of the group that counts; empty without a match."""
    pattern = F.lit(rule.pattern)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    part = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else whole
    gaps = F.slice(F.split(text, rule.pattern, -1), F.lit(1), F.size(whole))
    zipped = F.arrays_zip(gaps.alias("gap"), whole.alias("whole"), part.alias("part"))
    found = F.transform(zipped, lambda p: F.struct(
        F.length(p["gap"]).alias("gap"), F.length(p["whole"]).alias("len"), F.length(p["part"]).alias("size")))
    return F.when(text.rlike(rule.pattern), found)


def spans_of(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Ledger rows of ``texts`` (blob, text, todo: the names of the rules to scan it with).

    A match starts after all gaps up to it and all matches before it: a running sum over the matches of one
    blob and rule, so the work is linear in them.  Only lengths are shuffled, never texts."""
    each = [F.when(F.array_contains("todo", r.name), F.struct(
        F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version"), F.lit(i).alias("ord"), F.lit(r.least).alias("least"),
        pieces_of(F.col("text"), r).alias("pieces"))) for i, r in enumerate(rules)]
    found = texts.select("blob", F.explode(F.filter(F.array(*each), lambda x: x.isNotNull())).alias("f"))
    found = found.select("blob", "f.rule", "f.version", "f.ord", "f.least", F.posexplode_outer("f.pieces").alias("pos", "p"))
    # Rows repeated with their doc_id were scanned alike; one of them remains.
    pair = ["blob", "rule", "version"]
    found = found.repartition(*pair).dropDuplicates([*pair, "pos"])
    so_far = W.partitionBy(*pair).orderBy("pos").rowsBetween(W.unboundedPreceding, W.currentRow)
    end = F.sum(F.col("p.gap") + F.col("p.len")).over(so_far).cast("int")
    found = found.withColumn("end", end)
    span = F.struct((F.col("end") - F.col("p.len")).alias("start"), "ord", "end", F.col("rule").alias("kind")).cast(SPAN)
    good = F.col("p").isNotNull() & (F.col("p.size") >= F.col("least"))
    return found.groupBy(*pair).agg(F.sort_array(F.collect_list(F.when(good, span))).alias("spans"))


def versions(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.sha2(text_of().cast("binary"), 256).alias("blob"), text_of().alias("text"))


def unseen(docs: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The ledger rows that ``ledger`` lacks for ``docs``: only their pairs are scanned."""
    docs = versions(docs)
    # For each blob, the rules it has been scanned with; the rest is to be done.
    done = ledger.groupBy(F.col("blob").alias("done_blob")).agg(
        F.collect_set(F.concat_ws(":", "rule", F.col("version").cast("string"))).alias("done"))
    names = F.array(*[F.lit(r.name) for r in rules])
    todo = docs.groupBy("blob").agg(F.min("doc_id").alias("doc_id"))
    todo = todo.join(done, F.col("blob") == F.col("done_blob"), "left").withColumn(
        "todo", F.array_except(names, F.coalesce("done", F.array().cast("array<string>"))))
    todo = todo.filter(F.size("todo") > 0).select(F.col("blob").alias("b"), F.col("doc_id").alias("d"), "todo")
    picked = docs.join(todo, (F.col("blob") == F.col("b")) & F.col("doc_id").eqNullSafe(F.col("d")))
    return spans_of(picked, rules)


def scan(docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The ledger after ``docs``: its old rows and one for each pair that it lacked."""
    old = ledger if ledger is not None else docs.sparkSession.createDataFrame([], LEDGER)
    return stored(old.unionByName(unseen(docs, old, rules)), "ledger")


def update(docs: DataFrame, path: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan ``docs`` against the ledger kept at ``path`` and append what it lacks; nothing that it holds is
    written again.  A run that fails appends nothing, and its repetition scans the same pairs.  One writer at
    a time.  The first run makes the ledger."""
    spark = docs.sparkSession
    read = lambda: spark.read.schema(LEDGER).parquet(path)
    old = read() if path_exists(spark, path) else spark.createDataFrame([], LEDGER)
    unseen(docs, old, rules).write.mode("append").parquet(path)
    return read()


def findings(docs: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, blob, spans): every document with the spans of its blob, by start, then rule."""
    current = F.lit(False)
    for r in rules:
        current = current | ((F.col("rule") == r.kind) & (F.col("version") == r.version))
    hits = ledger.filter(current & (F.size("spans") > 0)).groupBy("blob").agg(
        F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"))  # one list per rule
    paths = versions(docs).select("doc_id", "blob")
    return spread_join(paths, hits, "blob", "left").select(
        "doc_id", "blob", F.coalesce("spans", F.array().cast(f"array<{SPAN}>")).alias("spans"))


def report(docs: DataFrame) -> DataFrame:
    """The table arrives in ``ARRIVALS`` runs over one ledger: each scans all its rows, but only the blobs that
    the runs before have not seen; the findings are those of all rows."""
    path = scratch(docs.sparkSession, "ledger")
    arrival = F.pmod(F.xxhash64("doc_id"), F.lit(ARRIVALS))
    for run in range(ARRIVALS):
        ledger = update(docs.filter(arrival == run), path)
    df = findings(docs, ledger)
    said = F.concat_ws(",", F.transform("spans", lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return df.select("doc_id", *[count(r.kind) for r in RULES], F.sha2(said, 256).alias("base_sha256"),
                     said.alias("spans"), "blob")

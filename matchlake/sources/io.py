"""Folder layout of the layers, readers, writers, and fault-isolated ingestion."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.clean import NULL_TOKENS
from .schemas import SCHEMAS, SOURCE_TABLES, SPECS

STATUS_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("error", T.StringType()),
])


@dataclass(frozen=True)
class LayerPaths:
    """``base/{raw,bronze,silver,gold/dim,gold/fact,gold/reports}/<table>``.

    One prefix per layer, so no job overwrites a path its own plan reads.
    """

    base: str
    fmt: str = "parquet"
    edition: str = ""
    versioned: bool = False   # tables are published version by version (see ``write_table``)

    def _p(self, *parts: str) -> str:
        return "/".join([self.base.rstrip("/"), *parts])

    def _e(self, layer: str, *parts: str) -> str:
        return self._p(layer, self.edition, *parts) if self.edition else self._p(layer, *parts)

    def for_edition(self, edition: str) -> "LayerPaths":
        """Same raw/bronze folders; silver and gold under an edition sub-folder."""
        return replace(self, edition=edition)

    def raw(self, table: str) -> str:
        return self._p("raw", f"{table}.csv")

    def bronze(self, table: str) -> str:
        return self._p("bronze", table)

    def rejects(self, table: str) -> str:
        """Cells and records of the raw file that bronze could not take."""
        return self._p("rejects", table)

    def silver(self, table: str) -> str:
        return self._e("silver", table)

    def dim(self, table: str) -> str:
        return self._e("gold", "dim", table)

    def fact(self, table: str) -> str:
        return self._e("gold", "fact", table)

    def conform_rejects(self, table: str) -> str:
        """Rows that conforming left out, and texts it could not read."""
        return self._e("silver_rejects", table)

    def totals(self, table: str) -> str:
        return self._e("gold", "totals", table)

    def report(self, name: str) -> str:
        return self._e("gold", "reports", name)

    def report_csv(self, name: str) -> str:
        return self._e("gold", "reports_csv", f"{name}.csv")

    def quality(self, name: str) -> str:
        return self._e("gold", "quality", name)


@dataclass(frozen=True)
class CsvDialect:
    """How a CSV file is written: separators, quoting, line breaks in cells, encoding.

    ``escape`` is what precedes a quote inside a quoted cell; ``'"'`` reads and writes doubled quotes.  A file with
    line breaks in cells (``multi_line``) cannot be split, so one task reads it whole: give such a source as
    several files.  ``null_value=None`` takes empty fields for NULL."""

    delimiter: str = ","
    quote: str = '"'
    escape: str = "\\"
    encoding: str = "UTF-8"
    multi_line: bool = False
    comment: str | None = None
    null_value: str | None = None

    def reading(self) -> dict[str, str]:
        options = {"header": "true", "sep": self.delimiter, "quote": self.quote, "escape": self.escape,
                   "encoding": self.encoding, "multiLine": str(self.multi_line).lower()}
        if self.comment is not None:
            options["comment"] = self.comment
        if self.null_value is not None:
            options["nullValue"] = self.null_value
        return options

    def writing(self) -> dict[str, str]:
        options = self.reading()
        del options["multiLine"]
        # Blanks around a cell are part of it, and an empty text is not NULL.
        return options | {"emptyValue": self.quote * 2, "ignoreLeadingWhiteSpace": "false",
                          "ignoreTrailingWhiteSpace": "false"}


# NULL marker of our own CSV exports, so that NULL and the empty string both
# survive a round trip (plain CSV cannot tell an empty field from NULL).
NULL_MARK = "\\N"


_INTEGRAL = r"^\s*[+-]?[0-9]+\.0*\s*$"      # an integer written as a decimal: 2.0


def _typed(text, kind: T.DataType):
    """``text`` as ``kind``, NULL where it does not parse."""
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, (T.IntegerType, T.LongType)):
        whole = F.when(text.rlike(_INTEGRAL), F.substring_index(F.trim(text), ".", 1))
        return F.coalesce(text.try_cast(kind), whole.try_cast(kind))
    return text.try_cast(kind)


def _match(text: DataFrame, schema: T.StructType) -> tuple[list, list[str]]:
    """(declared field, its column in the file or None) for each field, and the
    columns nobody declared.  An exact header wins over one that differs in case."""
    exact, folded = set(text.columns), {}
    for c in text.columns:
        folded.setdefault(c.strip().lower(), c)
    pairs = [(f, f.name if f.name in exact else folded.get(f.name.lower())) for f in schema.fields]
    used = {c for _, c in pairs if c}
    return pairs, [c for c in text.columns if c not in used]


_MALFORMED = "__malformed"


def _dialect(dialect: CsvDialect | None, null_value: str | None) -> CsvDialect:
    dialect = dialect or CsvDialect()
    return dialect if null_value is None else replace(dialect, null_value=null_value)


def _read_text(spark: SparkSession, path: str, dialect: CsvDialect, malformed: bool = False) -> DataFrame:
    """All cells as text.  ``malformed`` adds a column with the whole record where its number of
    fields is not that of the header (missing fields are NULL, further ones are only there)."""
    options = dialect.reading()
    text = spark.read.options(**options).csv(path)
    if not malformed:
        return text
    schema = T.StructType([*text.schema.fields, T.StructField(_MALFORMED, T.StringType())])
    return spark.read.options(**options).option("columnNameOfCorruptRecord", _MALFORMED).schema(schema).csv(path)


def _unparsed(text: DataFrame, pairs: list) -> dict:
    """Per typed column: whether a cell holds text that is neither a value nor a NULL sentinel."""
    out = {}
    for f, c in pairs:
        if c and not isinstance(f.dataType, T.StringType):
            cell = text[f"`{c}`"]
            out[f.name] = cell.isNotNull() & ~F.trim(cell).isin(*NULL_TOKENS) & _typed(cell, f.dataType).isNull()
    return out


def _select(text: DataFrame, pairs: list, extra: list[str]) -> list:
    cols = [(_typed(text[f"`{c}`"], f.dataType) if c else F.lit(None).cast(f.dataType)).alias(f.name) for f, c in pairs]
    return cols + [text[f"`{c}`"] for c in extra]


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             infer: bool = False, null_value: str | None = None, dialect: CsvDialect | None = None) -> DataFrame:
    """Headed CSV, typed by a declared schema (inference only on request).

    Columns are matched by header name without regard to case, not by position:
    the file is read as text and each declared column is cast to its type
    (``2.0`` is an integer).  Columns nobody declared follow as text.  A missing
    column is a typed NULL, and unparsable text (``'n/a'`` in a number column) is
    NULL rather than a failed job; ``ingest_all`` and ``csv_rejects`` count such
    cells.  ``null_value=None`` reads empty fields as NULL (plain CSV); pass
    ``NULL_MARK`` for files written by ``write_csv``.  ``dialect``: other separators, quotes or encodings.
    """
    dialect = _dialect(dialect, null_value)
    if schema is None or infer:
        return spark.read.options(**dialect.reading()).option("inferSchema", True).csv(path)
    text = _read_text(spark, path, dialect)
    return text.select(_select(text, *_match(text, schema)))


def csv_rejects(spark: SparkSession, path: str, schema: T.StructType,
                null_value: str | None = None) -> DataFrame:
    """(column_name, kind, row_count, unparsed_cells), one aggregate over the file:
    a row per typed column (``typed``), per column nobody declared (``extra``) and
    per declared column that the file lacks (``missing``)."""
    text = _read_text(spark, path, _dialect(None, null_value))
    pairs, extra = _match(text, schema)
    bad = _unparsed(text, pairs)
    names = [(n, "typed") for n in bad] + [(c, "extra") for c in extra] + [(f.name, "missing") for f, c in pairs if not c]
    counts = text.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(x).alias(f"u{i}") for i, x in enumerate(bad.values())])
    rows = F.array(*[F.struct(F.lit(n).alias("column_name"), F.lit(kind).alias("kind"), F.col("rows").alias("row_count"),
                              (F.col(f"u{i}") if kind == "typed" else F.lit(0)).cast("bigint").alias("unparsed_cells"))
                     for i, (n, kind) in enumerate(names)])
    return counts.select(F.inline(rows))


def csv_quarantine(spark: SparkSession, path: str, schema: T.StructType, null_value: str | None = None,
                   dialect: CsvDialect | None = None) -> DataFrame:
    """(source_file, reason, column_name, cell, record): what ``read_csv`` cannot take as it is written.

    ``unparsed``: a cell that is no value of its column's type (it is read as NULL), one row per cell;
    ``malformed``: a record with more or fewer fields than the header, whole in ``cell``.  ``record``
    is the row as JSON, all cells as text and NULLs left out, so nothing is lost with the typed table."""
    text = _read_text(spark, path, _dialect(dialect, null_value), malformed=True)
    pairs, _ = _match(text.drop(_MALFORMED), schema)
    columns = dict((f.name, c) for f, c in pairs)
    faults = [F.when(text[_MALFORMED].isNotNull(), F.struct(
        F.lit("malformed").alias("reason"), F.lit(None).cast("string").alias("column_name"), text[_MALFORMED].alias("cell")))]
    faults += [F.when(bad, F.struct(F.lit("unparsed").alias("reason"), F.lit(name).alias("column_name"),
                                    text[f"`{columns[name]}`"].alias("cell")))
               for name, bad in _unparsed(text, pairs).items()]
    cells = [text[f"`{c}`"] for c in text.columns if c != _MALFORMED]
    rows = text.select(F.col("_metadata.file_path").alias("source_file"), F.to_json(F.struct(*cells)).alias("record"),
                       F.array_compact(F.array(*faults)).alias("faults"))
    return rows.select("source_file", F.inline("faults"), "record")


def write_csv(df: DataFrame, path: str, quote_all: bool = True,
              null_value: str = NULL_MARK, dialect: CsvDialect | None = None) -> None:
    """Headed CSV export, all fields quoted by default, surrounding blanks kept,
    NULL written as ``null_value`` so it stays distinct from ''."""
    options = _dialect(dialect, null_value).writing()
    df.write.mode("overwrite").options(**options).option("quoteAll", quote_all).csv(path)


# Formats that keep a typed table as it is; text formats lose types or names.
_TYPED_FORMATS = {"parquet", "orc"}
_TEXT_FORMATS = {"csv", "text", "json", "xml"}


def check_format(spark: SparkSession, fmt: str) -> None:
    """Fail early, with a clear message, when a layer format cannot hold a typed
    table or has no connector on the classpath (``delta`` without its package)."""
    if fmt in _TYPED_FORMATS:
        return
    if fmt in _TEXT_FORMATS:
        raise ValueError(f"{fmt!r} does not keep column types; use 'parquet', 'orc' or a table format")
    try:
        spark.read.format(fmt).load(f"/nonexistent-{uuid.uuid4().hex}")
    except Exception as e:  # noqa: BLE001 -- only a missing data source is an error here
        if any(x in str(e) for x in ("DATA_SOURCE_NOT_FOUND", "Failed to find data source", "is built-in but external",
                                     "AVRO", "Avro")):
            raise ValueError(f"table format {fmt!r} is not available in this Spark session; "
                             f"add its connector or use 'parquet'") from e


# Written tables are compressed with this codec unless the session names one of its own.
_CODEC = "zstd"
_CODEC_CONF = {"parquet": "spark.sql.parquet.compression.codec", "orc": "spark.sql.orc.compression.codec"}


# ---------------------------------------------------------------- tables and their versions

KEPT_VERSIONS = 2      # the current one, and the one that running readers may still hold
_VERSION = re.compile(r"v\d{8}-[0-9a-f]{8}")
_MARK = "_published-"


def _names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none where it does not exist."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(hpath)) if fs.exists(hpath) else []


def published(spark: SparkSession, path: str) -> list[str]:
    """Published versions of a table, the current one last; none for a table without versions."""
    names = set(_names(spark, path))
    marked = [n.removeprefix(_MARK) for n in sorted(names) if n.startswith(_MARK)]
    return [f"{path}/{v}" for v in marked if v in names]


def current_path(spark: SparkSession, path: str) -> str:
    """Where the rows of a table are: its current version, or the folder itself."""
    versions = published(spark, path)
    return versions[-1] if versions else path


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table was written and, with versions, published."""
    if published(spark, path):
        return True
    names = _names(spark, path)
    return bool(names) and not any(_VERSION.fullmatch(n) for n in names) or (not names and path_exists(spark, path))


def _publish(spark: SparkSession, path: str, version: str) -> None:
    """Make a written version the current one by creating its empty marker: one atomic step, on file systems and
    object stores alike.  Then versions beyond ``KEPT_VERSIONS``, and those never published, go (a table has
    one writer at a time)."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    mark = hadoop.Path(f"{path}/{_MARK}{version}")
    fs = mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.createNewFile(mark):
        raise FileExistsError(f"{path}: version {version} was published before")
    versions = [v.rsplit("/", 1)[1] for v in published(spark, path)]
    for old in versions[:-KEPT_VERSIONS]:
        fs.delete(hadoop.Path(f"{path}/{_MARK}{old}"), False)   # the marker first: a version is whole or not there
        fs.delete(hadoop.Path(f"{path}/{old}"), True)
    for name in _names(spark, path):
        if _VERSION.fullmatch(name) and name[:9] <= versions[-1][:9] and name not in versions:
            fs.delete(hadoop.Path(f"{path}/{name}"), True)      # of a writer that failed


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """A table, or the current version of one that is published version by version.  With its ``schema``,
    partition columns have their own types, and a partitioned table without rows (and so without files) is read."""
    reader = spark.read.format(fmt) if schema is None else spark.read.format(fmt).schema(schema)
    return reader.load(current_path(spark, path))


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: Iterable[str] | None = None, rebalance: bool = True, versioned: bool = False) -> None:
    """Full overwrite through the commit protocol: a retried or lost task never
    leaves partial output visible.

    A plain overwrite removes the old rows first, so a job that fails midway leaves none, and a reader
    of the old files fails.  ``versioned`` writes the rows to a folder of their own under ``path`` and makes that
    current in one step at the end (``_publish``): until then, and for ever if the job fails, readers get
    the rows of before, and a reader that has begun ends with the version it began with.

    A partitioned write is rebalanced on its partition columns first (the
    REBALANCE hint): AQE then sizes each write task to the advisory partition
    size, splitting a large partition value and merging small ones, instead of
    every task writing a small file for every value (measured: 512 files of
    28 KB became 27 files of 408 KB for the same rows).
    """
    partition_by = list(partition_by or [])
    if partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    # Static: all old partitions go, also in a session set to dynamic overwrite.
    w = df.write.mode("overwrite").format(fmt).option("partitionOverwriteMode", "static")
    spark = df.sparkSession
    if fmt in _CODEC_CONF and spark.conf.get(_CODEC_CONF[fmt], None) is None:
        w = w.option("compression", _CODEC)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if not versioned:
        w.save(path)
        return
    last = max((n.removeprefix(_MARK) for n in _names(spark, path) if n.startswith(_MARK)), default="v00000000-")
    version = f"v{int(last[1:9]) + 1:08d}-{uuid.uuid4().hex[:8]}"
    w.save(f"{path}/{version}")
    _publish(spark, path, version)


def write_counted(df: DataFrame, path: str, fmt: str = "parquet",
                  partition_by: Iterable[str] | None = None, versioned: bool = False, rebalance: bool = True) -> int:
    """Write and return the row count, measured during the write (no re-scan).  ``rebalance=False`` writes a
    partitioned table from the tasks that compute it, without one more shuffle of all its rows."""
    partition_by = list(partition_by or [])
    if partition_by and rebalance:
        # Counted above the shuffle: a map task that runs again would be added twice.
        df = df.hint("rebalance", *partition_by)
    obs = Observation()
    write_table(df.observe(obs, F.count(F.lit(1)).alias("rows")), path, fmt, partition_by, rebalance=False, versioned=versioned)
    return int(obs.get["rows"])


def _metadata_session(spark: SparkSession) -> SparkSession:
    """A session of the same application whose readers answer count(*) from file footers."""
    session = spark.newSession()
    for key, value in (("spark.sql.sources.useV1SourceList", ""), ("spark.sql.parquet.aggregatePushdown", "true"),
                       ("spark.sql.orc.aggregatePushdown", "true")):
        session.conf.set(key, value)
    return session


def footer_counts(spark: SparkSession, tables: Mapping, fmt: str = "parquet") -> dict[str, int]:
    """Rows of written tables (name -> path), in one job.

    Parquet and ORC keep the number of rows in every file's footer: count(*) is pushed into the scan, which
    then reads no data.  What is counted is what the commit left, whichever tasks ran twice."""
    return {r["name"]: r["row_count"] or 0 for r in _footer_frame(spark, tables, fmt).collect()}  # one row a table


def _footer_frame(spark: SparkSession, tables: Mapping, fmt: str) -> DataFrame:
    """(name, row_count) in a session of its own; NULL for a table without a row."""
    session = _metadata_session(spark)
    parts = [session.read.format(fmt).load(current_path(spark, path)).agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("name"), "row_count") for name, path in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def error_text(e: BaseException) -> str:
    """Type and whole message, for status rows."""
    return f"{type(e).__name__}: {e}".rstrip(": ")


def path_exists(spark: SparkSession, path: str) -> bool:
    """File-system metadata check (driver side, no job), for any Hadoop URI."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a table folder, if there is one."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def _is_missing(err: AnalysisException) -> bool:
    cond = (err.getCondition() if hasattr(err, "getCondition") else err.getErrorClass()) or ""
    return "PATH_NOT_FOUND" in cond


def ingest_table(spark: SparkSession, paths: LayerPaths, t: str, null_value: str | None = None,
                 dialect: CsvDialect | None = None, quarantine: bool = False) -> tuple[int, str | None]:
    """Raw CSV of one table -> bronze.  Returns the rows written and a note on cells
    that did not parse and malformed records (counted while writing), None without any.  A file without
    one of the table's key columns is an error.  With ``quarantine``, and if there were any, those cells and
    records are written to ``paths.rejects`` (the file is read once more for them)."""
    if t not in SCHEMAS:
        frame = read_csv(spark, paths.raw(t), null_value=null_value, dialect=dialect)
        return write_counted(frame, paths.bronze(t), paths.fmt, versioned=paths.versioned), None
    given = _dialect(dialect, null_value)
    text = _read_text(spark, paths.raw(t), given, malformed=True)
    pairs, extra = _match(text.drop(_MALFORMED), SCHEMAS[t])
    spec = SPECS.get(t)
    keys = {*spec.keys, *spec.required} if spec else set()
    lacking = sorted(f.name for f, c in pairs if not c and f.name in keys)
    if lacking:
        raise ValueError(f"key column(s) missing: {', '.join(lacking)}")
    bad = _unparsed(text, pairs)
    flags = {f"__unparsed_{n}": x for n, x in bad.items()}
    # Flags are counted before the projection that drops them.
    obs = Observation()
    counted = text.withColumns(flags).observe(obs, F.count(F.lit(1)).alias("rows"), F.count(_MALFORMED).alias("malformed"), *[
        F.count_if(F.col(f)).alias(f"u{i}") for i, f in enumerate(flags)])
    write_table(counted.select(_select(counted, pairs, extra)), paths.bronze(t), paths.fmt, versioned=paths.versioned)
    seen = obs.get
    cells = ", ".join(f"{n} {seen[f'u{i}']}" for i, n in enumerate(bad) if seen[f"u{i}"])
    notes = ([f"unparsed cells: {cells}"] if cells else []) + (
        [f"malformed records: {seen['malformed']}"] if seen["malformed"] else [])
    if quarantine:
        remove_path(spark, paths.rejects(t))
        if notes:
            write_table(csv_quarantine(spark, paths.raw(t), SCHEMAS[t], dialect=given), paths.rejects(t), paths.fmt)
    return int(seen["rows"]), "; ".join(notes) or None


def ingest_all(spark: SparkSession, paths: LayerPaths,
               tables: Iterable[str] = SOURCE_TABLES,
               require: Iterable[str] = (), null_value: str | None = None,
               parallel: int = 4, dialects: Mapping[str, CsvDialect] | None = None,
               quarantine: bool = False) -> DataFrame:
    """Raw CSV -> bronze, table by table; a failing table does not stop the rest.

    Returns one status row per table (``ok`` / ``missing`` / ``failed``) with
    the row count observed while writing; ``error`` holds the whole error, or for
    an ``ok`` table how many cells of which columns did not parse.  Tables in
    ``require`` raise instead.  ``dialects``: of tables whose files are written in another one;
    ``quarantine``: keep what did not parse (see ``ingest_table``).
    """
    required = set(require)

    def one(t: str) -> tuple:
        try:
            if t not in required and not path_exists(spark, paths.raw(t)):
                return (t, "missing", None, "no such file")
            rows, note = ingest_table(spark, paths, t, null_value, (dialects or {}).get(t), quarantine)
            return (t, "ok", rows, note)
        except Exception as e:  # noqa: BLE001 -- isolation is the point
            if t in required:
                raise
            if isinstance(e, AnalysisException) and _is_missing(e):
                return (t, "missing", None, "no such file")
            return (t, "failed", None, error_text(e))

    # Tables are independent: submit their jobs concurrently from driver threads.
    from ..session import run_concurrently

    rows = run_concurrently(spark, [lambda t=t: one(t) for t in tables], parallel)
    return spark.createDataFrame(rows, STATUS_SCHEMA)

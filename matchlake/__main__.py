"""Command line: run one layer job or all of them over a base folder.

    python -m matchlake all --base s3a://bucket/football --edition compact
    python -m matchlake ingest --base /data/football
    python -m matchlake reports --base /data/football --edition full --param report03_full.season=2014

Raw CSVs are read from ``<base>/raw/<table>.csv``.  Each job prints its status
table; the exit code is 1 if any table or report failed.
"""

from __future__ import annotations

import argparse
import sys

from .plans import jobs
from .plans.edition import by_name
from .sources.io import NULL_MARK, CsvDialect, LayerPaths, check_format
from .sources.schemas import SOURCE_TABLES

STAGES = ("ingest", "conform", "quarantine", "model", "reports", "quality", "all")


def _params(items: list[str]) -> dict[str, dict]:
    out: dict[str, dict] = {}
    for item in items:
        target, value = item.split("=", 1)
        report, key = target.split(".", 1)
        out.setdefault(report, {})[key] = int(value) if value.lstrip("-").isdigit() else value
    return out


def _dialects(items: list[str]) -> dict[str, CsvDialect]:
    """``table.setting=value`` -> a dialect per table; ``*`` stands for all tables."""
    given: dict[str, dict] = {}
    for item in items:
        target, value = item.split("=", 1)
        table, setting = target.rsplit(".", 1)
        if setting not in CsvDialect.__dataclass_fields__:
            raise ValueError(f"no CSV setting {setting!r}: {', '.join(CsvDialect.__dataclass_fields__)}")
        value = value.encode().decode("unicode_escape") if "\\" in value and len(value) > 1 else value
        given.setdefault(table, {})[setting] = value.lower() == "true" if setting == "multi_line" else value
    common = given.pop("*", {})
    return {t: CsvDialect(**{**common, **given.get(t, {})}) for t in (SOURCE_TABLES if common else given)}


def main(argv: list[str] | None = None, spark=None) -> int:
    ap = argparse.ArgumentParser(prog="matchlake")
    ap.add_argument("stage", choices=STAGES)
    ap.add_argument("--base", required=True, help="folder holding raw/, bronze/, silver/, gold/")
    ap.add_argument("--edition", default="compact", choices=("compact", "full"))
    ap.add_argument("--format", default="parquet", help="table format of the layers")
    ap.add_argument("--param", action="append", default=[],
                    help="report parameter, e.g. report03_compact.season=2014")
    ap.add_argument("--null-marker", action="store_true",
                    help=f"raw CSVs write NULL as {NULL_MARK!r} (files from write_csv)")
    ap.add_argument("--csv", action="store_true", help="also export every report as headed CSV")
    ap.add_argument("--unordered", action="store_true",
                    help="write reports without their final global sort (readers sort)")
    ap.add_argument("--dialect", action="append", default=[],
                    help="CSV setting of a table, e.g. clubs.delimiter=; or *.encoding=ISO-8859-1")
    ap.add_argument("--quarantine", action="store_true",
                    help="keep the cells, records and rows that ingest (and, with 'all', conform) leave out")
    ap.add_argument("--versioned", action="store_true",
                    help="publish every table at once when it is whole; readers keep the old version until then")
    ap.add_argument("--local", action="store_true", help="run on local[*] instead of a cluster")
    args = ap.parse_args(argv)

    if spark is None:
        from .session import cluster_session, local_session
        spark = local_session() if args.local else cluster_session()
    ed = by_name(args.edition, as_of=None)
    check_format(spark, args.format)
    paths = LayerPaths(args.base, args.format, versioned=args.versioned)
    ep = paths.for_edition(ed.name)
    null_value = NULL_MARK if args.null_marker else None
    params = _params(args.param)
    dialects = _dialects(args.dialect)

    if args.stage == "ingest":
        status = jobs.run_ingest(spark, paths, null_value=null_value, dialects=dialects, quarantine=args.quarantine)
    elif args.stage == "conform":
        status = jobs.run_conform(spark, ep, ed)
    elif args.stage == "quarantine":
        status = jobs.run_quarantine(spark, ep, ed)
    elif args.stage == "model":
        status = jobs.run_model(spark, ep, ed)
    elif args.stage == "reports":
        status = jobs.run_reports(spark, ep, ed, params=params, ordered=not args.unordered, csv=args.csv)
    elif args.stage == "quality":
        status = jobs.run_quality(spark, ep, ed)
    else:
        status = jobs.run_all(spark, args.base, ed, params=params, null_value=null_value,
                              ordered=not args.unordered, fmt=args.format, csv=args.csv, dialects=dialects,
                              quarantine=args.quarantine, versioned=args.versioned)
    rows = status.collect()  # status rows only: one per table or report
    for r in rows:
        print("\t".join("" if v is None else str(v) for v in r))
    return 1 if any(r["status"] not in ("ok",) for r in rows) else 0


if __name__ == "__main__":
    sys.exit(main())

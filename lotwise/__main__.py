"""Command line: the jobs as one Spark application (``python -m lotwise``, or
``spark-submit --py-files lotwise.zip run_lotwise.py``), in place of the reference's scheduled
scripts.

Dates default to the reference's offsets from today; ``--run-date`` / ``--as-of`` replay any day.

    python -m lotwise daily    --log L --variance-root V --totallot-root T [--run-date D]
    python -m lotwise archive  --log L --tte-root R --variance-root V --totallot-root T [--run-date D]
    python -m lotwise backfill --log L --first D1 --last D2 --variance-root V --totallot-root T [--resume]
    python -m lotwise archive-backfill --log L --tte-root R --first D1 --last D2 --variance-root V --totallot-root T [--resume]
    python -m lotwise weekly   --variance-root V --totallot-root T --report-root P [--as-of TS]
    python -m lotwise extract  --root V --dataset variance --run-date D --out O
    python -m lotwise extract-day --variance-root V --totallot-root T --out O [--run-date D]
    python -m lotwise tables   --variance-root V --totallot-root T --report-root P [--drop]

Jobs that store datasets take ``--variance-table`` and ``--totallot-table``, registered tables that see
each run date (or report) as it is stored.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import SparkSession

from .params import RunWindow
from .plans.archive import run_archive_job
from .plans.backfill import run_archive_backfill, run_backfill_at
from .plans.daily import run_daily_job_at
from .plans.weekly import run_daily_extract, run_daily_extracts, run_weekly_job
from .schemas import DATASETS, REPORT_TABLE_TOTALLOT, REPORT_TABLE_VARIANCE, TOTALLOT, VARIANCE
from .session import configure
from .sinks.tables import drop_table, register_report, register_store

STORES = {"auto_variance": (VARIANCE, "variance_root"), "auto_totallot": (TOTALLOT, "totallot_root")}
REPORTS = {"report_variance": REPORT_TABLE_VARIANCE, "report_totallot": REPORT_TABLE_TOTALLOT}
OPTIONAL = ("run-date", "as-of", "chunk-days", "variance-table", "totallot-table")
TABLE_NAMES = ("variance-table", "totallot-table")


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lotwise", description=__doc__.split("\n\n")[0])
    sub = p.add_subparsers(dest="job", required=True)

    def job(name, *args):
        s = sub.add_parser(name)
        for a in args:
            s.add_argument(f"--{a}", required=a not in OPTIONAL)
        return s

    roots = ("variance-root", "totallot-root")
    job("daily", "log", *roots, "run-date", *TABLE_NAMES)
    job("archive", "log", "tte-root", *roots, "run-date", *TABLE_NAMES)
    for b in (job("backfill", "log", "first", "last", *roots, "chunk-days", *TABLE_NAMES),
              job("archive-backfill", "log", "tte-root", "first", "last", *roots, "chunk-days", *TABLE_NAMES)):
        b.add_argument("--resume", action="store_true")
    job("weekly", *roots, "report-root", "as-of", *TABLE_NAMES)
    job("extract", "root", "dataset", "run-date", "out")
    job("extract-day", *roots, "run-date", "out")
    t = job("tables", *roots, "report-root")
    t.add_argument("--drop", action="store_true")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = _parser().parse_args(argv)
    spark = configure(spark or SparkSession.builder.appName(f"lotwise-{a.job}").getOrCreate())
    today = dt.date.today()
    tables = {k: getattr(a, k, None) for k in ("variance_table", "totallot_table")}
    if a.job == "daily":
        w = RunWindow.daily(a.run_date) if a.run_date else RunWindow.daily_as_of(today)
        run_daily_job_at(spark, a.log, w, a.variance_root, a.totallot_root, **tables)
    elif a.job == "archive":
        w = RunWindow.archive(a.run_date) if a.run_date else RunWindow.archive_as_of(today)
        run_archive_job(spark, a.log, a.tte_root, w, a.variance_root, a.totallot_root, **tables)
    elif a.job == "backfill":
        run_backfill_at(spark, a.log, a.first, a.last, a.variance_root, a.totallot_root,
                        int(a.chunk_days or 31), resume=a.resume, **tables)
    elif a.job == "archive-backfill":
        run_archive_backfill(spark, a.log, a.tte_root, a.first, a.last, a.variance_root, a.totallot_root,
                             int(a.chunk_days or 8), resume=a.resume, **tables)
    elif a.job == "weekly":
        as_of = dt.datetime.fromisoformat(a.as_of) if a.as_of else dt.datetime.now()
        run_weekly_job(spark, a.variance_root, a.totallot_root, a.report_root, as_of,
                       {"variance": a.variance_table, "totallot": a.totallot_table})
    elif a.job == "extract":
        run_date = a.run_date or RunWindow.daily_as_of(today).run_date
        run_daily_extract(spark, a.root, DATASETS[a.dataset], run_date, a.out)
    elif a.job == "extract-day":
        run_date = a.run_date or RunWindow.daily_as_of(today).run_date
        run_daily_extracts(spark, a.variance_root, a.totallot_root, run_date, a.out)
    elif a.job == "tables":
        for name in (*STORES, *REPORTS) if a.drop else ():
            drop_table(spark, name)
        for name, (schema, root) in ({} if a.drop else STORES).items():
            register_store(spark, name, schema, getattr(a, root))
        for name, schema in ({} if a.drop else REPORTS).items():
            register_report(spark, name, schema, f"{a.report_root.rstrip('/')}/{name}")


if __name__ == "__main__":
    main(sys.argv[1:])

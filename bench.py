"""Benchmark: the lot-variance jobs on the derived event log at ``$BENCH_SF_DIR``.

Set-up (timed apart, not in the total): the event log and test records are derived from the
given tables and stored as Parquet partitioned by date, the layout the jobs read in production.
Every timed query then reads that table (partition pruning, pushed filters, pruned columns) and
is executed in full (``noop`` sink or a real write). A job is repeated up to ``$BENCH_REPEAT`` times or
until it took ``ENOUGH_S`` seconds in all; its figure is the median, and ``spread`` has
the least and the greatest. Prints one JSON line.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lotwise.params import RunWindow  # noqa: E402
from lotwise.plans.archive import archive_datasets  # noqa: E402
from lotwise.plans.backfill import run_archive_backfill, run_backfill_at  # noqa: E402
from lotwise.plans.daily import daily_datasets, run_daily_job_at  # noqa: E402
from lotwise.plans.weekly import run_weekly_job  # noqa: E402
from lotwise.session import local_session, scratch_path  # noqa: E402
from lotwise.sources.eventlog import read_event_log, write_event_log  # noqa: E402
from lotwise.sinks.text import write_dated  # noqa: E402
from lotwise.sources.fixtures import WIDE_LOWER, WIDE_UPPER, event_log, tte_records  # noqa: E402
from lotwise.sources.testrecords import read_dated_records, write_test_records  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPEAT = int(os.environ.get("BENCH_REPEAT", "3"))
ENOUGH_S = 30
RUN_DATE = "2024-02-03"
AS_OF = dt.datetime(2024, 10, 15, 12, 0, 0)
WIDE = RunWindow.span(WIDE_LOWER, WIDE_UPPER)


def _sf(path: str) -> str:
    name = os.path.basename(path.rstrip("/"))
    return name[2:] if name.startswith("sf") else name


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = local_session(CPUS, shuffle_partitions=max(8, CPUS), app="lotwise-bench")
    setup = {}
    t = time.time()
    log_path = scratch_path(spark, "mam_tx")
    write_event_log(event_log(spark, SF_DIR), log_path)
    tte_path = scratch_path(spark, "tte")
    write_test_records(tte_records(spark, SF_DIR), tte_path, "testers")
    setup["stage_inputs"] = round(time.time() - t, 2)

    log = read_event_log(spark, log_path)
    records = read_dated_records(spark, tte_path, WIDE.days())
    timings: dict[str, float] = {}
    spread: dict[str, list[float]] = {}

    def timed(name, fn):
        took: list[float] = []
        while len(took) < REPEAT and sum(took) < ENOUGH_S:
            t0 = time.time()
            fn()
            took.append(time.time() - t0)
        timings[name] = round(statistics.median(took), 2)
        spread[name] = [round(min(took), 2), round(max(took), 2)]

    # One daily run (2 partition days), both datasets from one cached scan, stored (K2).
    out = {k: scratch_path(spark, k) for k in ("variance", "totallot", "reports", "bf")}
    window = RunWindow.daily(RUN_DATE)
    timed("daily_job", lambda: run_daily_job_at(
        spark, log_path, window, out["variance"], out["totallot"]))

    def uncached():
        ds = daily_datasets(read_event_log(spark, log_path, window.days()), window, cache=False)
        write_dated(ds.variance, out["variance"], window.run_date)
        write_dated(ds.totallot, out["totallot"], window.run_date)

    timed("daily_job_uncached", uncached)

    # Whole log as one wide run, each dataset on its own.
    timed("variance_wide", lambda: noop(daily_datasets(log, WIDE, cache=False).variance))
    timed("totallot_wide", lambda: noop(daily_datasets(log, WIDE, cache=False).totallot))

    # Every daily run of the log, both datasets stored per run date, in one chunk and in the default
    # chunks (shared parts checkpointed).
    timed("backfill_all_runs", lambda: run_backfill_at(
        spark, log_path, "2023-09-30", WIDE_UPPER, f"{out['bf']}/variance", f"{out['bf']}/totallot", chunk_days=None))
    timed("backfill_chunked", lambda: run_backfill_at(
        spark, log_path, "2023-09-30", WIDE_UPPER, f"{out['bf']}/variance", f"{out['bf']}/totallot"))

    # The archive job of 64 run dates over stored log and test records.
    timed("archive_backfill_64", lambda: run_archive_backfill(
        spark, log_path, tte_path, "2024-01-01", "2024-03-04", f"{out['bf']}/archive_variance",
        f"{out['bf']}/archive_totallot", chunk_days=32))

    # Weekly 52-week reports over the stored backfill history (S4 -> K3).
    timed("weekly_reports", lambda: run_weekly_job(
        spark, f"{out['bf']}/variance", f"{out['bf']}/totallot", out["reports"], AS_OF))

    # Archive job over the whole log with all test records.
    def archive():
        cached = []
        v, tl = archive_datasets(log, records.drop("record_date"), WIDE, cached=cached)
        noop(v)
        noop(tl)
        for df in cached:  # the next repeat starts cold
            df.unpersist()

    timed("archive_wide", archive)

    total = round(sum(timings.values()), 2)
    print(json.dumps({
        "metric": "lot_variance_jobs_total",
        "value": total,
        "unit": "sec",
        "queries": timings,
        "spread": spread,
        "setup": setup,
        "sf": _sf(SF_DIR),
        "cpus": CPUS,
        "stat": f"median of up to {REPEAT} runs per query",
    }))


if __name__ == "__main__":
    main()

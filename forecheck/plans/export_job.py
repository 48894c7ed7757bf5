"""Export job: compute (or read) the report and write a dated report folder.

    python -m forecheck.plans.export_job --roles roles.json --params params.json --out /shared/reports
    python -m forecheck.plans.export_job --table reports.explainability --out /shared/reports
    python -m forecheck.plans.export_job --sf-dir /root/testdata/sf0.1 --out /shared/reports

With ``--table`` the named table is read whole (``SELECT *``) and written out;
otherwise the explainability rollup is computed from the role tables: real ones
named in ``--roles`` (JSON object role -> table), with ``--params`` (JSON object
with the fields of ``ReportParams``, week ranges as ``[first, last]``), or the test
tables of ``--sf-dir``, which bring parameters of their own. Both JSON options take
the text itself or the name of a file. "Today" is ``--as-of``, else ``as_of`` of the
parameters, else the current date in UTC. A week window, week or year that holds no rows
is an error, so wrong parameters cannot end in an empty report.
The output folder is ``<out>/Forecast_Validation - DD Mon YYYY`` (India date); each run
writes its part files into an attempt folder of its own in there and publishes them by
a manifest, written last, so a failed second run of a day leaves the first report
as it was (``sinks.read_report`` reads the published one). Executors write their own
part files and the row count is observed during the write, so the report never passes
through the driver.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecheck.config import ReportParams
from forecheck.plans.report import ForecastValidation
from forecheck.session import build_session
from forecheck.sources import fixtures, sinks
from forecheck.sources.staging import staged_tables
from forecheck.sources.tables import Tables


def _json(value: str) -> dict:
    text = value if value.lstrip().startswith("{") else Path(value).read_text()
    return json.loads(text)


def window_filters(p: ReportParams) -> dict[str, tuple[str, Column]]:
    """Window name -> (role, condition on stored columns) of every week window, week
    and year that the report reads."""
    week = lambda r, c: F.col(c).between(r.lo, r.hi)
    sold = F.col("sub_channel") == p.sales_sub_channel
    filters = {n: ("sales_weekly", week(getattr(p, n), "fy_week_id") & sold)
               for n in ("recent", "recent_ly", "forward_ly")}
    filters["forward"] = ("forecast_item", week(p.forward, "fiscal_year_week")
                          & (F.col("sub_channel") == p.forecast_sub_channel))
    filters["plan_weeks"] = ("plan_forecast", week(p.plan_weeks, "current_week")
                             & (F.col("sub_channel") == p.plan_channel)
                             & (F.col("current_week") <= p.plan_cutoff))
    filters |= {n: ("weekly_history", F.col("fiscal_year") == getattr(p, n)) for n in ("this_year", "last_year")}
    filters["on_order_week"] = ("fiscal_calendar", F.col("fy_week_id") == p.on_order_week)
    return filters


def existence_probes(tables: Tables, p: ReportParams) -> dict[str, DataFrame]:
    """One frame per window that holds a row if the window has any.

    Each is a filter on stored columns below a limit of one: the filter reaches the
    scan, where it prunes partitions and row groups, and the first row found ends
    the probe; no fact table is read whole.
    """
    return {name: tables[role].where(condition).select(F.lit(1).alias("found")).limit(1)
            for name, (role, condition) in window_filters(p).items()}


def empty_windows(tables: Tables, p: ReportParams) -> list[str]:
    """Names of the week windows, weeks and years that hold no rows."""
    probes = existence_probes(tables, p)
    with ThreadPoolExecutor(max_workers=len(probes)) as pool:
        empty = pool.map(DataFrame.isEmpty, probes.values())
        return [name for name, nothing in zip(probes, empty) if nothing]


def main(argv: list[str] | None = None) -> str:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--table", help="catalog table to export as is")
    src.add_argument("--sf-dir", help="folder of the driver parquet tables")
    src.add_argument("--roles", help="JSON object (or file): role name -> table name")
    ap.add_argument("--params", help="JSON object (or file) of report parameters; needed with --roles")
    ap.add_argument("--out", required=True, help="shared output folder")
    ap.add_argument("--format", default="csv", choices=("csv", "parquet"))
    ap.add_argument("--as-of", help="report date YYYY-MM-DD")
    ap.add_argument("--master", help="Spark master (default: from spark-submit)")
    ap.add_argument("--stage", action="store_true",
                    help="with --sf-dir: materialize the role tables once (week-partitioned) "
                         "under the shared checkpoint folder and read them from there")
    args = ap.parse_args(argv)
    if args.roles and not args.params:
        ap.error("--roles needs --params: the week windows, channels, brands and default "
                 "discount of the real tables")
    params = fixtures.PARAMS
    if args.params:
        values = _json(args.params)
        today = dt.datetime.now(dt.timezone.utc).date()
        as_of = dt.date.fromisoformat(args.as_of or values.get("as_of") or today.isoformat())
        params = ReportParams.from_json(values, as_of)
    elif args.as_of:
        params = replace(params, as_of=dt.date.fromisoformat(args.as_of))

    spark = build_session(args.master, app_name="forecheck-export")
    validation = None
    if args.table:
        report = spark.table(args.table)
    else:
        if args.sf_dir and args.stage:
            tables = staged_tables(spark, args.sf_dir)
        elif args.sf_dir:
            tables = Tables.from_driver_tables(spark, args.sf_dir)
        else:
            tables = Tables.from_catalog(spark, _json(args.roles))
        empty = empty_windows(tables, params)
        if empty:
            raise SystemExit(f"no rows in: {', '.join(empty)}; check the report parameters")
        validation = ForecastValidation(tables, params)
        report = validation.rollup()
    now = dt.datetime.now(dt.timezone.utc)
    try:
        done = sinks.publish_report(report, sinks.report_path(args.out, now), args.format, now)
    finally:
        if validation is not None:
            validation.close()
    print(f"[INFO] report rows: {done.rows:,}; cols: {len(done.columns)}")
    print(f"[INFO] report written to: {done.path}")
    return done.path


if __name__ == "__main__":
    main()

import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F

from forecheck.session import shared_subdir
from forecheck.sources import sinks


def test_report_path_uses_india_date():
    now = dt.datetime(2025, 12, 31, 20, 0, tzinfo=dt.timezone.utc)   # already Jan 1 in India
    assert sinks.report_path("/x", now) == "/x/Forecast_Validation - 01 Jan 2026"


def test_export_and_profile(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    prof = sinks.run_profile(df).first()
    assert (prof.row_count, prof.column_count) == (2, 2)
    path = os.path.join(shared_subdir(spark, "test-exports", uuid.uuid4().hex), "out")
    sinks.export_report(df, path, "csv")
    back = spark.read.option("header", True).csv(path)
    assert back.columns == ["k", "v"] and back.count() == 2


def test_export_with_profile_counts_during_write(spark):
    df = spark.range(7).selectExpr("id", "id * 2 AS twice")
    path = os.path.join(shared_subdir(spark, "test-exports", uuid.uuid4().hex), "out")
    assert sinks.export_with_profile(df, path, "parquet") == (7, 2)
    assert spark.read.parquet(path).count() == 7


def test_export_job_table_and_report(spark, capsys):
    from conftest import SF_SMALL
    from forecheck.plans import export_job

    spark.createDataFrame([("BR0", "D0", 1, 2)], "l0_name string, l1_name string, "
                          "explainable_count bigint, non_explainable_count bigint"
                          ).createOrReplaceTempView("report_table")
    out = shared_subdir(spark, "test-export-job", uuid.uuid4().hex)
    path = export_job.main(["--table", "report_table", "--out", out, "--format", "parquet"])
    assert spark.read.parquet(path).count() == 1
    assert "report rows: 1; cols: 4" in capsys.readouterr().out
    out2 = shared_subdir(spark, "test-export-job", uuid.uuid4().hex)
    path2 = export_job.main(["--sf-dir", SF_SMALL, "--out", out2, "--format", "csv"])
    back = spark.read.option("header", True).csv(path2)
    assert back.columns == ["l0_name", "l1_name", "explainable_count", "non_explainable_count"]
    assert back.count() == 12


def _moved_role_tables(spark, years=26, channel="Web"):
    """The test role tables, moved to other years, brands and channels."""
    from conftest import SF_SMALL
    from forecheck.sources.tables import ROLES, Tables

    roles = Tables.from_driver_tables(spark, SF_SMALL)
    names = {}
    for role in ROLES:
        df = roles[role]
        for c, kind in df.dtypes:
            if kind == "date":
                # whole weeks, so Saturdays stay Saturdays
                df = df.withColumn(c, F.date_add(c, 364 * years))
            elif c in ("fiscal_year",):
                df = df.withColumn(c, F.col(c) + years)
            elif c in ("fy_week_id", "current_week", "fiscal_year_week"):
                df = df.withColumn(c, F.col(c) + 100 * years)
            elif kind == "string":
                df = df.withColumn(c, F.regexp_replace(F.regexp_replace(c, "Online", channel), "BR", "QX"))
        names[role] = f"moved_{role}"
        df.createOrReplaceTempView(names[role])
    return names


def test_export_job_on_role_tables_needs_and_uses_params(spark, small_report, capsys):
    import json

    from forecheck.plans import export_job

    roles = _moved_role_tables(spark)
    out = shared_subdir(spark, "test-export-job", uuid.uuid4().hex)
    base = ["--roles", json.dumps(roles), "--out", out, "--format", "parquet"]
    with pytest.raises(SystemExit):
        export_job.main(base)
    assert "--params" in capsys.readouterr().err
    week = lambda lo, hi: [lo + 2600, hi + 2600]
    params = {
        "plan_channel": "Web", "history_channel": "Web", "order_channel": "Web",
        "inventory_platform": "Web", "forecast_sub_channel": "Web", "sales_sub_channel": "Web",
        "this_year": 2025, "last_year": 2024, "recent": week(199949, 199952),
        "recent_ly": week(199849, 199852), "forward": week(200001, 200004),
        "forward_ly": week(199901, 199904), "plan_weeks": week(199952, 200053),
        "plan_cutoff": 202643, "default_discount": 0.05, "on_order_week": 202727,
        "as_of": (dt.date(2001, 6, 30) + dt.timedelta(days=364 * 26)).isoformat(),
        "po_brands": ["QX0", "QX1", "QX2", "QX3", "QX4"], "default_brand": "QX0"}
    path = export_job.main([*base, "--params", json.dumps(params)])
    got = {tuple(r) for r in spark.read.parquet(path).collect()}
    want = {(r[0].replace("BR", "QX"), *r[1:]) for r in small_report.rollup().collect()}
    assert got == want and got
    with pytest.raises(SystemExit, match="forward_ly"):
        export_job.main([*base, "--params", json.dumps(params | {"forward_ly": [190001, 190004]})])
    with pytest.raises(ValueError, match="missing.*this_year.*unknown.*oops"):
        export_job.main([*base, "--params", json.dumps(
            {k: v for k, v in params.items() if k != "this_year"} | {"oops": 1})])


def _folder(spark):
    return shared_subdir(spark, "test-publish", uuid.uuid4().hex, "Forecast_Validation - 01 Jan 2026")


def test_published_report_survives_a_failed_second_run(spark):
    """The second run of a day dies in a task; the first report is still read."""
    folder = _folder(spark)
    assert sinks.published(spark, folder) == []
    with pytest.raises(FileNotFoundError):
        sinks.read_report(spark, folder)
    first = spark.createDataFrame([("a", 1, dt.date(2026, 1, 1)), (None, 2, None)], "k string, v bigint, d date")
    done = sinks.publish_report(first, folder, "csv")
    assert (done.rows, done.columns) == (2, ("k", "v", "d"))
    bad = spark.range(0, 1000, 1, 4).select(
        F.lit("b").alias("k"), F.when(F.col("id") == 999, F.raise_error(F.lit("lost"))).otherwise(
            F.col("id")).cast("bigint").alias("v"), F.lit(None).cast("date").alias("d"))
    with pytest.raises(Exception, match="lost"):
        sinks.publish_report(bad, folder, "csv")
    back = sinks.read_report(spark, folder)
    assert back.schema == first.schema
    assert sorted(back.collect(), key=str) == sorted(first.collect(), key=str)
    # the run dies after its data, while the manifest is written: still the first
    (spark.createDataFrame([("c", 3, None)], first.schema).write.parquet(f"{folder}/attempt-late"))
    half = f"{folder}/{sinks.MANIFESTS}/99999999T000000-late/_temporary/0"
    spark.createDataFrame([("{}",)], "value string").write.text(half)
    assert sinks.read_report(spark, folder).count() == 2
    # a third run succeeds and replaces it; the first attempt stays on disk
    third = sinks.publish_report(spark.createDataFrame([("z", 9, None)], first.schema), folder, "parquet")
    assert [tuple(r) for r in sinks.read_report(spark, folder).collect()] == [("z", 9, None)]
    assert [e.path for e in sinks.published(spark, folder)] == [third.path, done.path]


def test_window_probes_prune_partitions_and_stop(spark, tmp_path):
    """Every window is a filter that reaches the scan, below a limit of one."""
    from dataclasses import replace

    from conftest import SF_SMALL
    from forecheck.plans import export_job
    from forecheck.sources import fixtures
    from forecheck.sources.staging import staged_tables

    tables = staged_tables(spark, SF_SMALL, shared_subdir(spark, "test-stage", uuid.uuid4().hex))
    probes = export_job.existence_probes(tables, fixtures.PARAMS)
    assert len(probes) == 8 and export_job.empty_windows(tables, fixtures.PARAMS) == []
    columns = {"recent": "fy_week_id", "recent_ly": "fy_week_id", "forward_ly": "fy_week_id",
               "forward": "fiscal_year_week", "this_year": "fiscal_year", "last_year": "fiscal_year"}
    for name, df in probes.items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Limit 1" in plan or "Limit limit=1" in plan or "limit=1" in plan, plan
        if name in columns:
            assert columns[name] in plan[plan.index("PartitionFilters"):plan.index("PushedFilters")]
        elif name == "plan_weeks":
            assert "current_week" in plan[plan.index("PushedFilters"):plan.index("ReadSchema")]
    wrong = replace(fixtures.PARAMS, last_year=1901, on_order_week=190001)
    assert export_job.empty_windows(tables, wrong) == ["last_year", "on_order_week"]


def test_second_export_of_a_day_is_published_beside_the_first(spark):
    from forecheck.plans import export_job

    out = shared_subdir(spark, "test-export-job", uuid.uuid4().hex)
    for n in (1, 2):
        spark.range(n).createOrReplaceTempView("report_of_a_day")
        path = export_job.main(["--table", "report_of_a_day", "--out", out, "--format", "parquet"])
        folder = path[:path.rindex("/attempt-")]
        assert sinks.read_report(spark, folder).count() == n
        assert len(sinks.published(spark, folder)) == n

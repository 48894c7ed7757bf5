"""Staged role tables give the same report as the lazy views, with week filters
reaching the scan as partition filters."""

import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from forecheck.plans.report import ForecastValidation
from forecheck.session import shared_subdir
from forecheck.sources import fixtures
from forecheck.sources.staging import fingerprint, stage, staged_tables


def test_staged_tables_match_views(spark, small_report):
    root = shared_subdir(spark, "test-stage", uuid.uuid4().hex)
    staged = ForecastValidation(staged_tables(spark, SF_SMALL, root), fixtures.PARAMS)
    for role in ("sales_weekly", "weekly_history", "forecast_item", "inventory"):
        assert staged.t[role].schema.simpleString() == small_report.t[role].schema.simpleString()
    for a, b in ((staged.rollup(), small_report.rollup()),
                 (staged.comp_wide, small_report.comp_wide),
                 (staged.chain, small_report.chain)):
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    # the week window reaches the scan as a partition filter and prunes folders
    window = staged.t.sales_weekly.where(F.col("fy_week_id").between(199949, 199952))
    plan = window._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters: [") + len("PartitionFilters: ["):]
    assert "fy_week_id" in filters[:filters.index("]")]
    assert len(window.inputFiles()) > 0
    read = {r.f for r in window.select(F.input_file_name().alias("f")).distinct().collect()}
    every = set(staged.t.sales_weekly.inputFiles())
    assert 0 < len(read) <= 4 * 8 < len(every)
    assert all(any(f"fy_week_id={w}" in f for w in range(199949, 199953)) for f in read)
    # a second call reuses the published stage
    again = stage(spark, SF_SMALL, root)
    assert again == stage(spark, SF_SMALL, root)
    staged.close()


def test_changed_nested_file_gets_a_new_stage(spark, tmp_path):
    for name in ("part", "orders", "lineitem"):
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").limit(50).write.parquet(
            f"{tmp_path}/{name}.parquet/day=1")
    before = fingerprint(spark, str(tmp_path))
    assert before == fingerprint(spark, str(tmp_path))
    spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").limit(10).write.parquet(
        f"{tmp_path}/lineitem.parquet/day=2")
    assert fingerprint(spark, str(tmp_path)) != before


def test_staging_without_inputs_fails(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)path|no files"):
        staged_tables(spark, str(tmp_path))


def _exchanges_below_joins(plan: str) -> int:
    lines = plan.splitlines()
    depth = lambda t: len(t) - len(t.lstrip(" :+-*"))
    top = min(depth(t) for t in lines if "SortMergeJoin" in t)
    return sum("Exchange" in t and depth(t) > top for t in lines)


def test_po_joins_on_staged_tables_have_no_exchange(spark, small_report):
    """Three bucketed scans, two joins, DISTINCTs between them, no shuffle below."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    root = shared_subdir(spark, "test-stage", uuid.uuid4().hex)
    try:
        def chain():
            staged = ForecastValidation(staged_tables(spark, SF_SMALL, root, buckets=4), fixtures.PARAMS)
            assert staged.chain.exceptAll(small_report.chain).count() == 0
            assert staged.chain.count() == small_report.chain.count()
            return staged.chain._jdf.queryExecution().executedPlan().toString()

        plan = chain()
        assert plan.count("SortMergeJoin") == 2 and plan.count("Bucketed: true") == 3
        assert _exchanges_below_joins(plan) == 0
        # from views the same steps shuffle every input
        assert _exchanges_below_joins(small_report.chain._jdf.queryExecution().executedPlan().toString()) >= 3
        # another application declares the tables from their files
        for t in spark.catalog.listTables():
            if t.name.startswith("forecheck_"):
                spark.sql(f"DROP TABLE {t.name}")
        assert _exchanges_below_joins(chain()) == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_week_span_prunes_order_partitions_at_run_time(spark, small_report):
    """On purchase orders partitioned by ETA, the first and last day of the on-order
    week, read from the calendar, choose the partitions; inventory is cut to one day."""
    from forecheck.sources.tables import ROLES, Tables

    folder = shared_subdir(spark, "test-roles", uuid.uuid4().hex)
    parted = {"purchase_order": "intial_eta", "inventory": "inventorydate"}
    views, plain = small_report.t, {}
    for role in ROLES:
        if role in parted:
            views[role].write.partitionBy(parted[role]).parquet(f"{folder}/{role}.parquet")
            plain[role] = spark.read.schema(views[role].schema).parquet(f"{folder}/{role}.parquet")
        else:
            plain[role] = views[role]
    tables = Tables(spark, {role: lambda df=df: df for role, df in plain.items()})
    with ForecastValidation(tables, fixtures.PARAMS) as r:
        for got, want, column in ((r.on_order, small_report.on_order, "intial_eta"),
                                  (r.on_hand, small_report.on_hand, "inventorydate")):
            assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
            plan = got._jdf.queryExecution().sparkPlan().toString()
            scans = [t for t in plan.split("FileScan parquet")[1:] if f"{column}#" in t[:600]]
            filters = [t[t.index("PartitionFilters"):t.index("PushedFilters")] for t in scans]
            assert filters and all(column in f for f in filters), plan
            if column == "intial_eta":
                assert all("subquery" in f.lower() for f in filters)


def test_bloom_filter_cuts_the_fact_above_its_scan(spark, small_report):
    """Dimensions that may not be broadcast: their keys still cut the sales rows before
    the shuffle."""
    from forecheck.config import Sizing

    root = shared_subdir(spark, "test-stage", uuid.uuid4().hex)
    tables = staged_tables(spark, SF_SMALL, root)
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold",
             "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold")
    old = {n: spark.conf.get(n) for n in names}
    for n in names[:2]:
        spark.conf.set(n, "-1")
    spark.conf.set(names[2], "1")
    try:
        with ForecastValidation(tables, fixtures.PARAMS, Sizing(0, 0)) as r:
            plan = r.actual_units._jdf.queryExecution().optimizedPlan().toString()
            assert "might_contain" in plan
            a, b = r.actual_units, small_report.actual_units
            assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    finally:
        for n, v in old.items():
            spark.conf.set(n, v)

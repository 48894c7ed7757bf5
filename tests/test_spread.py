"""Large scans of order lines are dealt out by their size; the rows stay the same."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from forecheck.operators import relational, skew, supply
from forecheck.plans.report import ForecastValidation
from forecheck.sources import fixtures
from forecheck.sources.tables import Tables


@pytest.fixture(scope="module")
def order_tables(spark, tmp_path_factory):
    """24,000 lines of 6,000 orders in one file: some lines twice, some without an order."""
    folder, n = str(tmp_path_factory.mktemp("orders")), F.col("id")
    day = F.to_timestamp(F.date_add(F.lit(dt.date(2001, 1, 1)), (n % 200).cast("int")))
    line = n % 23_500
    (spark.range(24_000).withColumn("id", line).select(
        F.when(n % 97 != 0, n % 6_000).alias("l_orderkey"), (n % 800).alias("l_partkey"),
        (n % 50).alias("l_suppkey"), (n % 4).cast("int").alias("l_linenumber"),
        (n % 50).cast("double").alias("l_quantity"), F.lit(1.0).alias("l_extendedprice"),
        F.lit(0.05).alias("l_discount"), F.lit(0.0).alias("l_tax"),
        F.element_at(F.array(*map(F.lit, "NRA")), (n % 3 + 1).cast("int")).alias("l_returnflag"),
        F.element_at(F.array(*map(F.lit, "FO")), (n % 2 + 1).cast("int")).alias("l_linestatus"),
        day.alias("l_shipdate")).coalesce(1).write.parquet(f"{folder}/lineitem.parquet"))
    (spark.range(5_900).select(n.alias("o_orderkey"), day.alias("o_orderdate"))
     .coalesce(1).write.parquet(f"{folder}/orders.parquet"))
    return folder


def _largest_task(df):
    tasks = df.groupBy(F.spark_partition_id()).count().collect()
    return max(r["count"] for r in tasks), sum(r["count"] for r in tasks)


def test_order_lines_are_dealt_out_by_size(spark, order_tables, monkeypatch):
    size = relational.estimated_bytes(spark.read.parquet(f"{order_tables}/lineitem.parquet"))
    monkeypatch.setattr(relational, "SPREAD_MIN_BYTES", 0, raising=False)
    monkeypatch.setattr(relational, "SPREAD_TASK_BYTES", size / 24, raising=False)
    name = "spark.sql.adaptive.autoBroadcastJoinThreshold"     # as the sides of a large join are
    old = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        most, total = _largest_task(Tables.from_driver_tables(spark, order_tables).purchase_order)
    finally:
        spark.conf.set(name, old)
    assert total > 20_000 and most < total / 8, (most, total)


def test_both_sides_of_the_chain_s_order_join_follow_the_size(spark, order_tables, monkeypatch):
    size = relational.estimated_bytes(spark.read.parquet(f"{order_tables}/lineitem.parquet"))
    monkeypatch.setattr(relational, "SPREAD_MIN_BYTES", 0, raising=False)
    monkeypatch.setattr(relational, "SPREAD_TASK_BYTES", size / 24, raising=False)
    r = ForecastValidation(Tables.from_driver_tables(spark, order_tables), fixtures.PARAMS)
    plan = r.chain._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"hashpartitioning\([lo]_orderkey#\d+L, (\d+)\)", plan) == ["24", "24"]


def test_shipment_and_line_joins_of_the_chain_follow_the_size(spark, order_tables, monkeypatch):
    size = relational.estimated_bytes(spark.read.parquet(f"{order_tables}/lineitem.parquet"))
    monkeypatch.setattr(relational, "SPREAD_MIN_BYTES", 0)
    monkeypatch.setattr(relational, "SPREAD_TASK_BYTES", size / 24)
    tables = Tables.from_driver_tables(spark, order_tables)

    def join_tasks(chain, columns):
        plan = chain._jdf.queryExecution().executedPlan().toString()
        keys = ", ".join(rf"{c}#\d+L?" for c in columns)
        return {int(n) for n in re.findall(rf"hashpartitioning\({keys}, (\d+)\)", plan)}

    line, shipment = ("l_orderkey|po_number", "sku"), ("l_orderkey|po_number", "sku|product_code", r"\w+", r"\w+")
    line, shipment = [[f"(?:{c})" for c in key] for key in (line, shipment)]
    r = ForecastValidation(tables, fixtures.PARAMS)
    assert join_tasks(r.chain, line) == join_tasks(r.chain, shipment) == {24}
    # a hot key of the packing list is left to the salts and adaptive execution
    hot = skew.HeavyKeys(spark.createDataFrame([(1, "S001", 2)], "po_number long, sku string, salts int"),
                         supply.LINE_KEY)
    r = ForecastValidation(tables, fixtures.PARAMS)
    r._heavy = {"heavy_lines": hot, "heavy_shipments": None}
    assert 24 not in join_tasks(r.chain, shipment)


def test_only_views_deal_the_order_joins_out(spark, order_tables, monkeypatch):
    assert Tables.from_driver_tables(spark, order_tables).order_tasks is None
    monkeypatch.setattr(relational, "SPREAD_MIN_BYTES", 0)
    assert Tables.from_driver_tables(spark, order_tables).order_tasks >= 1
    assert Tables.from_catalog(spark, {}).order_tasks is None


def test_dealt_out_chain_equals_plain_chain(spark, order_tables, monkeypatch):
    def results():
        r = ForecastValidation(Tables.from_driver_tables(spark, order_tables), fixtures.PARAMS)
        return r.t.purchase_order, r.chain, r.arrivals, r.on_order

    monkeypatch.setattr(relational, "SPREAD_MIN_BYTES", 1 << 60)
    plain = results()
    monkeypatch.setattr(relational, "SPREAD_MIN_BYTES", 0)
    monkeypatch.setattr(relational, "SPREAD_TASK_BYTES", 1000)
    for a, b in zip(plain, results(), strict=True):
        assert a.count() > 0 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_small_scan_is_not_dealt_out(spark, order_tables):
    scan = spark.read.parquet(f"{order_tables}/orders.parquet")
    assert relational.spread(scan, "o_orderkey") is scan

"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query builds the role tables from the driver tables in ``sf_dir`` and
runs one step (or the whole) of the report over them; nothing is sampled or
capped. Parameters are ``fixtures.PARAMS``.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecheck.operators import comparable, forecast, hierarchy
from forecheck.plans.report import ForecastValidation
from forecheck.session import shared_subdir
from forecheck.sources import fixtures, sinks
from forecheck.sources.tables import Tables, load
from forecheck.sources.weekly_sums import WeeklySums, weeks_of


def report(spark: SparkSession, sf_dir: str) -> ForecastValidation:
    return ForecastValidation(Tables.from_driver_tables(spark, sf_dir), fixtures.PARAMS)


def _q(build: Callable[[ForecastValidation], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(report(spark, sf_dir))
    run.__doc__ = build.__doc__
    return run


def _hierarchy_paths(r: ForecastValidation) -> DataFrame:
    with_channel = r.bridge.withColumn("channel", F.lit(r.p.plan_channel))
    return hierarchy.hierarchy_paths(with_channel).drop("channel")


def _default_with_null_code(r: ForecastValidation) -> DataFrame:
    """Default branch against the validated codes plus one NULL code: SQL
    ``NOT IN`` then keeps nothing. Returns the row count (0)."""
    null_code = r.discounts.select(F.lit(None).cast("string").alias("hierarchy_code")).distinct()
    codes = r.discount_codes.unionByName(null_code)
    rows = forecast.select_forecast(r.candidates, r.discounts, codes, r.comparable_keys,
                                    r.p.default_discount, "default")
    return rows.agg(F.count(F.lit(1)).alias("default_rows"))


def _report_export(r: ForecastValidation) -> DataFrame:
    """Publish the rollup in a fresh dated folder under the shared checkpoint folder,
    as a file report, and read the published report back."""
    spark = r.t.spark
    folder = sinks.report_path(shared_subdir(spark, "exports", uuid.uuid4().hex),
                               dt.datetime.now(dt.timezone.utc))
    sinks.publish_report(r.rollup(), folder, "csv")
    return sinks.read_report(spark, folder)


def _stored_report_profile(r: ForecastValidation) -> DataFrame:
    """Store the rollup as a named table, read that table whole by its name and
    profile it."""
    spark = r.t.spark
    path = sinks.export_report(r.rollup(), shared_subdir(spark, "tables", uuid.uuid4().hex), "parquet")
    name = f"stored_report_{uuid.uuid4().hex}"
    spark.read.parquet(path).createOrReplaceTempView(name)
    return sinks.run_profile(load(spark, "", name).select("*"))


def _actual_units_from_sums(r: ForecastValidation) -> DataFrame:
    """The actuals windows from a table of weekly sums in a fresh shared folder: the
    sums of last year's weeks are kept first, then a run adds the weeks of this year."""
    spark = r.t.spark
    sums = WeeklySums(spark, shared_subdir(spark, "weekly-sums", uuid.uuid4().hex))
    sums.update(r.t.sales_weekly, weeks_of(r.t.sales_weekly, [r.p.recent_ly, r.p.forward_ly]))
    return r.actual_units_from(sums)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "plan_snapshot": _q(lambda r: r.plan_base),
    "product_bridge": _q(lambda r: r.bridge),
    "active_hierarchy": _q(lambda r: r.active_rows),
    "hierarchy_paths": _q(_hierarchy_paths),
    "plan_year_alignment": _q(lambda r: r.aligned),
    "forecast_week_parts": _q(lambda r: r.forecast_norm),
    "weekly_history_shifted": _q(lambda r: r.hist_ty),
    "selling_summary": _q(lambda r: comparable.selling_summary(r.hist_ly, "qty_ly")),
    "on_hand_last_value": _q(lambda r: comparable.on_hand_last_value(r.hist_ty)),
    "on_hand_latest": _q(lambda r: comparable.on_hand_latest(r.hist_ty)),
    "comparable_30": _q(lambda r: r.comp_narrow),
    "comparable_50": _q(lambda r: r.comp_wide),
    "comparable_50_latest": _q(lambda r: r.comparable(r.p.wide_band, "latest")),
    "validation_flags": _q(lambda r: r.validation),
    "validated_discounts": _q(lambda r: r.discount_rows),
    "product_code_parts": _q(lambda r: r.comparable_skus),
    "po_receipt_chain": _q(lambda r: r.chain),
    "open_by_arrival": _q(lambda r: r.arrivals),
    "on_order_units": _q(lambda r: r.on_order),
    "on_hand_week_boundary": _q(lambda r: r.on_hand),
    "forecast_candidates": _q(lambda r: r.candidates),
    "forecast_validated": _q(lambda r: r.selected("validated")),
    "forecast_default": _q(lambda r: r.selected("default")),
    "forecast_selected": _q(lambda r: r.forecast),
    "forecast_default_null_set": _q(_default_with_null_code),
    "actuals_flagged": _q(lambda r: r.window(r.p.recent)),
    "units_recent": _q(lambda r: r.units(r.p.recent)),
    "units_recent_ly": _q(lambda r: r.units(r.p.recent_ly)),
    "units_forward_ly": _q(lambda r: r.units(r.p.forward_ly)),
    "units_forecast": _q(lambda r: r.fct_units),
    "actual_units": _q(lambda r: r.actual_units),
    "actual_units_from_sums": _q(_actual_units_from_sums),
    "sku_explainability": _q(lambda r: r.final()),
    "on_order_join_own_brand": _q(lambda r: r.final("own_brand")),
    "explainability_rollup": _q(lambda r: r.rollup()),
    "sku_detail_report": _q(lambda r: r.detail()),
    "report_profile": _q(lambda r: sinks.run_profile(r.rollup())),
    "report_export": _q(_report_export),
    "stored_report_profile": _q(_stored_report_profile),
}

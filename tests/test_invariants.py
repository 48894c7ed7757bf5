"""Invariants of the report on the smallest driver tables."""

from pyspark.sql import functions as F

from forecheck.operators import plan
from forecheck.operators.relational import Sides
from forecheck.config import Sizing


def test_explainable_xor_non_explainable(small_report):
    final = small_report.final()
    assert final.where(F.col("explainable") == F.col("non_explainable")).count() == 0
    assert final.where(F.col("explainable").isNull()).count() == 0


def test_narrow_band_is_subset_of_wide(small_report):
    assert small_report.comp_narrow.subtract(small_report.comp_wide).count() == 0


def test_latest_stock_is_subset_of_as_written(small_report):
    latest = small_report.comparable(small_report.p.wide_band, "latest")
    assert latest.subtract(small_report.comp_wide).count() == 0


def test_forecast_branches_share_no_code(small_report):
    v = small_report.selected("validated").select("hierarchy_code").distinct()
    d = small_report.selected("default").select("hierarchy_code").distinct()
    assert v.intersect(d).count() == 0
    both = small_report.forecast.count()
    assert both == small_report.selected("validated").count() + small_report.selected("default").count()


def test_discounts_equal_distinct_of_validation_table(small_report):
    from_table = plan.validated_discounts(small_report.validation)
    assert from_table.exceptAll(small_report.discounts).count() == 0
    assert small_report.discounts.exceptAll(from_table).count() == 0


def test_fused_windows_equal_separate_windows(small_report):
    r = small_report
    fused = r.actual_units
    for col, weeks in (("ty_units", r.p.recent), ("lt_units", r.p.recent_ly),
                       ("lf_units", r.p.forward_ly)):
        one = fused.where(F.col(col).isNotNull()).select("l0_name", "sku", F.col(col).alias("units"))
        sep = r.units(weeks)
        assert one.exceptAll(sep).count() == 0 and sep.exceptAll(one).count() == 0


def test_rollup_counts_match_final_rows(small_report):
    r = small_report
    rolled = r.rollup().agg(F.sum(F.col("explainable_count") + F.col("non_explainable_count"))).first()[0]
    joined = r.final().join(r.active.select("l0_name", "sku"), ["l0_name", "sku"]).count()
    assert rolled == joined


def _joined(spark, side, sizing):
    sides = Sides(sizing)
    big = spark.range(1000).withColumnRenamed("id", "k")
    joined = big.join(sides.check(side).frame, "k")
    return joined, "BroadcastHashJoin" in joined._jdf.queryExecution().sparkPlan().toString(), sides


def test_side_above_a_bound_is_released_and_shuffled(spark):
    side = spark.range(50).selectExpr("id AS k", "cast(id AS string) AS s")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for sizing, fits in ((Sizing(100, 1 << 20), True), (Sizing(10, 1 << 20), False),
                             (Sizing(100, 100), False)):
            joined, hinted, sides = _joined(spark, side, sizing)
            assert joined.count() == 50 and hinted == fits and len(sides.kept) == fits
            sides.close()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_flagship_builds_in_fewer_jobs_and_releases_what_it_kept(spark):
    from conftest import SF_SMALL
    from forecheck.plans.registry import report

    sc = spark.sparkContext
    spark.catalog.clearCache()
    before = len(sc._jsc.getPersistentRDDs())
    started = sc._jsc.sc().dagScheduler().numTotalJobs()
    r = report(spark, SF_SMALL)
    rolled = r.rollup()
    jobs = sc._jsc.sc().dagScheduler().numTotalJobs() - started
    assert rolled.count() == 12
    r.close()
    assert len(sc._jsc.getPersistentRDDs()) <= before
    # each adaptive stage of a measured side is a job; the sides run at the same time
    assert jobs <= 32


def test_results_do_not_depend_on_broadcast(spark, small_report):
    from conftest import SF_SMALL
    from forecheck.plans.report import ForecastValidation
    from forecheck.sources import fixtures
    from forecheck.sources.tables import Tables

    none = ForecastValidation(Tables.from_driver_tables(spark, SF_SMALL), fixtures.PARAMS, Sizing(0, 0))
    for name in ("validation", "forecast", "actual_units", "on_order", "aligned"):
        a, b = getattr(none, name), getattr(small_report, name)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name
    assert none.rollup().exceptAll(small_report.rollup()).count() == 0
    none.close()

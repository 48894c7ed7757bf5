"""Weekly partial sums: equal to the full scan for successive runs, one new week read."""

import uuid
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from forecheck.config import WeekRange
from forecheck.plans.report import ForecastValidation
from forecheck.session import shared_subdir
from forecheck.sources import fixtures
from forecheck.sources.staging import staged_tables
from forecheck.sources.weekly_sums import WeeklySums, weeks_of


def _sums(spark):
    return WeeklySums(spark, shared_subdir(spark, "test-sums", uuid.uuid4().hex))


def _moved(params, k):
    step = lambda r: WeekRange(r.lo + k, r.hi + k)
    return replace(params, recent=step(params.recent), recent_ly=step(params.recent_ly),
                   forward_ly=step(params.forward_ly))


def test_three_successive_weeks(spark):
    tables = staged_tables(spark, SF_SMALL, shared_subdir(spark, "test-stage", uuid.uuid4().hex))
    params = replace(fixtures.PARAMS, recent=WeekRange(199940, 199943), recent_ly=WeekRange(199840, 199843),
                     forward_ly=WeekRange(199844, 199847))
    sums, read = _sums(spark), []
    update = sums.update
    sums.update = lambda sales, weeks, again=(): read.append(update(sales, weeks, again)) or read[-1]
    for k in range(3):
        with ForecastValidation(tables, _moved(params, k)) as r:
            a, b = r.actual_units_from(sums), r.actual_units
            assert b.count() > 0
            assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert len(read[0]) == 12
    # a later run reads the one week that each window has moved on to (the forward
    # weeks follow the recent ones of last year, so one of the three is held already)
    assert read[1:] == [[199848, 199944], [199849, 199945]]
    # the raw sales of an update are cut by partition
    plan = (tables.sales_weekly.where(F.col("fy_week_id").isin(read[1]))
            ._jdf.queryExecution().executedPlan().toString())
    assert "fy_week_id" in plan[plan.index("PartitionFilters"):plan.index("PushedFilters")]
    assert set(sums.held()) == set(range(199840, 199850)) | set(range(199940, 199946))


def test_failed_update_and_corrected_week(spark):
    schema = "l0_name string, sku string, fy_week_id bigint, sub_channel string, units double"
    rows = [("B", "s", 1, "x", 2.0), ("B", "s", 1, "x", 3.0), ("B", "s", 2, "x", None), ("B", None, 2, "x", 7.0)]
    sales, sums = spark.createDataFrame(rows, schema), _sums(spark)
    assert sums.held() == {} and sums.update(sales, []) == []
    with pytest.raises(KeyError, match="2"):
        sums.read([2])
    bad = sales.withColumn("units", F.when(F.col("sku") == "s", F.raise_error(F.lit("lost"))).otherwise(
        F.col("units")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        sums.update(bad, [1, 2])
    assert sums.held() == {}
    # week 3 has no sales and is held all the same
    assert sums.update(sales, [1, 2, 3]) == [1, 2, 3] and sums.update(sales, [1, 2, 3]) == []
    got = {(r.sku, r.fy_week_id): r.units for r in sums.read([1, 2, 3]).collect()}
    assert got == {("s", 1): 5.0, ("s", 2): None, (None, 2): 7.0}
    corrected = sales.withColumn("units", F.lit(1.0))
    assert sums.update(corrected, [1, 2], again=[1]) == [1]
    got = {(r.sku, r.fy_week_id): r.units for r in sums.read([1, 2]).collect()}
    assert got == {("s", 1): 2.0, ("s", 2): None, (None, 2): 7.0}
    assert weeks_of(sales, [WeekRange(2, 9)]) == [2] and weeks_of(sales.limit(0), [WeekRange(1, 9)]) == []

import datetime as dt

import pytest
from pyspark.sql import functions as F

from forecheck.functions import fiscal
from forecheck.functions.numeric import flag, safe_divide, within_band
from forecheck.functions.paths import brand_sku_key, cumulative_paths, path_parts


def one(spark, col, value=None, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


def test_week_key_is_iso(spark):
    df = spark.createDataFrame([(dt.date(1999, 1, 1),), (dt.date(2000, 1, 3),),
                                (dt.date(2001, 12, 31),)], "d date")
    got = [r[0] for r in df.select(fiscal.week_key("d")).collect()]
    assert got == [199853, 200001, 200201]


def test_key_parts(spark):
    df = spark.createDataFrame([(200004,)], "k bigint")
    r = df.select(fiscal.key_year("k").alias("y"), fiscal.key_week("k").alias("w"),
                  fiscal.key_year_text("k").alias("ys"), fiscal.key_week_text("k").alias("ws")).first()
    assert (r.y, r.w, r.ys, r.ws) == (2000, 4, "2000", "04")


@pytest.mark.parametrize("day,expected", [
    (dt.date(2001, 6, 29), dt.date(2001, 6, 23)),   # Friday -> previous Saturday
    (dt.date(2001, 6, 30), dt.date(2001, 6, 30)),   # Saturday -> same day
    (dt.date(2001, 7, 1), dt.date(2001, 6, 30)),    # Sunday -> previous day
    (dt.date(2001, 7, 2), dt.date(2001, 6, 30)),    # Monday -> two days back
])
def test_saturday_week_start(spark, day, expected):
    assert one(spark, fiscal.saturday_on_or_before("v"), day, "v date") == expected
    assert fiscal.saturday_on_or_before_py(day) == expected


def test_path_parts_online_and_retail(spark):
    df = spark.createDataFrame([("Online-BR1-D0-C1-G1-H1-K1-S001",),
                                ("Retail-Store-BR2-D0-C1-G1-H1-K1-S002",), (None,)], "p string")
    b, c, s = path_parts("p")
    rows = df.select(b.alias("b"), c.alias("c"), s.alias("s")).collect()
    assert [tuple(r) for r in rows] == [("BR1", "Online", "S001"), ("BR2", "Store", "S002"),
                                        (None, None, None)]


def test_path_one_segment_brand_raises_last_is_segment(spark):
    df = spark.createDataFrame([("ONLY",)], "p string")
    b, _, s = path_parts("p")
    assert df.select(s).first()[0] == "ONLY"
    with pytest.raises(Exception, match="INVALID_ARRAY_INDEX"):
        df.select(b).collect()


def test_cumulative_paths_null_when_level_missing(spark):
    df = spark.createDataFrame([("On", "A", None, "S")], "ch string, l0 string, l1 string, sku string")
    cols = cumulative_paths("ch", ["l0", "l1"], "sku")
    r = df.select(*cols).first()
    assert tuple(r) == ("On-A", None, None)


def test_safe_divide_zero_is_null(spark):
    df = spark.createDataFrame([(4.0, 0.0), (4.0, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(safe_divide("a", "b")).collect()] == [None, 2.0]


def test_concat_key_collision_and_null(spark):
    df = spark.createDataFrame([("AB", "1"), ("A", "B1"), (None, "x")], "a string, b string")
    got = [r[0] for r in df.select(brand_sku_key("a", "b")).collect()]
    assert got == ["AB1", "AB1", None]


def test_band_and_flag(spark):
    df = spark.createDataFrame([(70.0, 100.0), (69.0, 100.0), (None, 100.0)], "x double, y double")
    got = [r[0] for r in df.select(flag(within_band("x", "y", 0.7, 1.3))).collect()]
    assert got == [1, 0, 0]

"""Role tables derived from the driver's parquet tables (FIXTURES.md).

The report reads planning, forecast, sales, purchase-order and inventory
tables. The test data holds TPC-H-like tables instead, so each role is a
Spark view over ``part``, ``orders`` and ``lineitem``:

* product attributes are functions of ``partkey % 60``;
* the sales channel is ``Store`` when ``orderkey % 4 = 0`` else ``Online``;
* the fiscal week is the ISO week of the ship date.

In production these views are replaced by the real tables
(``Tables.from_catalog``); the operators do not know the difference.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forecheck.config import ReportParams, WeekRange
from forecheck.functions import fiscal
from forecheck.functions.paths import LEVELS, RETAIL_PREFIX, cumulative_paths
from forecheck.operators.relational import spread
from forecheck.sources.tables import load

# fixed values of the fixture (FIXTURES.md section 2)
PRODUCTS = 60                                   # pid = partkey % 60
LEVEL_RULES = (("BR", 5), ("D", 3), ("C", 4), ("G", 6), ("H", 10), ("K", 12))
CODE_MOD = 30                                   # hierarchy_code = 'HC' || partkey % 30
PARENT_CODE_MOD = 15                            # level-6 code = 'HL' || partkey % 15
PRODUCT_INACTIVE_MOD, PRODUCT_INACTIVE_AT = 20, 19
HIERARCHY_INACTIVE_MOD, HIERARCHY_INACTIVE_AT = 30, 29
PLAN_SKIP_MOD = 4                               # plan rows need (partkey % 30) % 4 <> 0
UNKNOWN_BRAND_MOD = 11                          # PO brand 'XX' when partkey % 11 = 0
STORE_MOD = 4
STORE, ONLINE = "Store", "Online"
ETA_DAYS, RECEIPT_DAYS = 60, 30
CALENDAR_START, CALENDAR_END = dt.date(1995, 1, 1), dt.date(2002, 12, 31)
ALGORITHMS = ("new_item_average", "new_item", "elasticity")   # by pid % 3

# report parameters of the test tables (FIXTURES.md section 4)
PARAMS = ReportParams(
    plan_channel=ONLINE, history_channel=ONLINE, order_channel=ONLINE, inventory_platform=ONLINE,
    forecast_sub_channel=ONLINE, sales_sub_channel=ONLINE,
    this_year=1999, last_year=1998,
    recent=WeekRange(199949, 199952), recent_ly=WeekRange(199849, 199852),
    forward=WeekRange(200001, 200004), forward_ly=WeekRange(199901, 199904),
    plan_weeks=WeekRange(199952, 200053), plan_cutoff=200043,
    default_discount=0.05, as_of=dt.date(2001, 6, 30), on_order_week=200127,
    po_brands=("BR0", "BR1", "BR2", "BR3", "BR4"), default_brand="BR0")


def _pid(partkey: Column) -> Column:
    return partkey % F.lit(PRODUCTS)


def level_names(partkey: Column) -> list[Column]:
    return [F.concat(F.lit(prefix), (partkey % F.lit(mod)).cast("string")).alias(name)
            for (prefix, mod), name in zip(LEVEL_RULES, LEVELS)]


def sku(partkey: Column) -> Column:
    return F.concat(F.lit("S"), F.lpad(_pid(partkey).cast("string"), 3, "0"))


def hierarchy_code(partkey: Column) -> Column:
    return F.concat(F.lit("HC"), (partkey % F.lit(CODE_MOD)).cast("string"))


def channel(orderkey: Column) -> Column:
    return F.when(orderkey % F.lit(STORE_MOD) == 0, F.lit(STORE)).otherwise(F.lit(ONLINE))


def product_path(partkey: Column, chan: Column) -> Column:
    """Full ``channel-l0-...-l5-sku`` path; store paths get the retail prefix."""
    levels = [c for c in level_names(partkey)]
    full = cumulative_paths(chan, levels, sku(partkey))[-1]
    return F.concat(F.when(chan == STORE, F.lit(RETAIL_PREFIX + "-")).otherwise(F.lit("")), full)


def builders(spark: SparkSession, sf_dir: str) -> dict[str, Callable[[], DataFrame]]:
    # each table's files are listed and its schema read once for all roles
    part = cache(lambda: load(spark, sf_dir, "part"))
    orders = cache(lambda: load(spark, sf_dir, "orders"))
    lineitem = cache(lambda: load(spark, sf_dir, "lineitem"))

    pk, ok = F.col("l_partkey"), F.col("l_orderkey")
    ship_day = F.to_date("l_shipdate")

    def product() -> DataFrame:
        p = F.col("p_partkey")
        return (part()
                .select(*level_names(p), sku(p).alias("sku"),
                        _pid(p).cast("bigint").alias("product_id"),
                        (_pid(p) % PRODUCT_INACTIVE_MOD != PRODUCT_INACTIVE_AT).alias("active"))
                .distinct())

    def hierarchy() -> DataFrame:
        pid = F.col("product_id")
        seven = F.concat(F.lit("HC"), (pid % CODE_MOD).cast("string"))
        six = F.concat(F.lit("HL"), (pid % PARENT_CODE_MOD).cast("string"))
        return (product()
                .select(*LEVELS, "sku", "product_id",
                        F.explode(F.array(F.lit(6), F.lit(7))).alias("level"))
                .select(*LEVELS, "sku",
                        F.when(F.col("level") == 7, seven).otherwise(six).alias("hierarchy_code"),
                        F.col("level").cast("int").alias("level"),
                        (pid % HIERARCHY_INACTIVE_MOD != HIERARCHY_INACTIVE_AT).alias("active")))

    def _plan(li: DataFrame, with_aur: bool) -> DataFrame:
        measures = [F.sum("l_quantity").alias("written_sales_units")]
        if with_aur:
            measures.append(F.max("l_extendedprice").alias("written_aur"))
        return (li.where((pk % CODE_MOD) % PLAN_SKIP_MOD != 0)
                .groupBy(channel(ok).alias("sub_channel"), hierarchy_code(pk).alias("hierarchy_code"),
                         fiscal.week_key(ship_day).alias("current_week"),
                         F.col("l_discount").alias("scenario"))
                .agg(*measures))

    def plan_forecast() -> DataFrame:
        return _plan(lineitem(), True)

    def plan_working() -> DataFrame:
        return _plan(lineitem().where(F.col("l_linestatus") == "F"), False)

    def _plan_shift(years: int) -> Callable[[], DataFrame]:
        def build() -> DataFrame:
            return plan_forecast().withColumn(
                "current_week", fiscal.shift_years("current_week", years))
        return build

    def forecast_level() -> DataFrame:
        return (lineitem()
                .groupBy(product_path(pk, channel(ok)).alias("product_code"),
                         fiscal.week_key(ship_day).alias("fiscal_year_week"),
                         F.col("l_discount").alias("percent_off"))
                .agg(F.sum("l_quantity").alias("w_sls_u")))

    def weekly_history() -> DataFrame:
        return (lineitem()
                .groupBy(product_path(pk, channel(ok)).alias("product_code"),
                         fiscal.iso_year(ship_day).alias("fiscal_year"),
                         fiscal.iso_week(ship_day).alias("fiscal_week"),
                         fiscal.week_key(ship_day).alias("fiscal_year_week"))
                .agg(F.sum("l_quantity").alias("qty"),
                     ((F.sum("l_quantity") * 7) % 300).alias("oh"),
                     F.max("l_extendedprice").alias("msrp")))

    def simulation() -> DataFrame:
        algo = F.element_at(F.array(*[F.lit(a) for a in ALGORITHMS]),
                            (_pid(pk) % len(ALGORITHMS) + 1).cast("int"))
        return (lineitem()
                .select(product_path(pk, channel(ok)).alias("product_code"),
                        algo.alias("algorithm_name"))
                .distinct())

    def purchase_order() -> DataFrame:
        o = orders().select("o_orderkey", "o_orderdate")
        brand = F.when(pk % UNKNOWN_BRAND_MOD == 0, F.lit("XX")).otherwise(level_names(pk)[0])
        po_date = F.to_date("o_orderdate")
        # the lines get their order's columns and are made distinct in the tasks of this join
        return (spread(lineitem(), "l_orderkey").join(o, ok == F.col("o_orderkey"))
                .select(brand.alias("l0_name"), sku(pk).alias("sku"),
                        ok.alias("po_number"), po_date.alias("po_date"),
                        F.date_add(po_date, ETA_DAYS).alias("intial_eta"),
                        F.col("l_quantity").alias("ordered_quantity"),
                        channel(ok).alias("channel")))

    def packing_list() -> DataFrame:
        return (lineitem().where(F.col("l_returnflag") != "N")
                .select(ok.alias("po_number"), sku(pk).alias("sku"),
                        F.col("l_suppkey").alias("container_number"),
                        F.col("l_linenumber").alias("inventory_packing_list_summary_id"),
                        ship_day.alias("date_shipped"),
                        F.col("l_quantity").alias("quantity_shipped")))

    def warehouse_receipt() -> DataFrame:
        return (lineitem().where((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"))
                .select(ok.alias("po_number"), sku(pk).alias("product_code"),
                        F.col("l_suppkey").alias("container_number"),
                        F.col("l_linenumber").alias("inventory_packing_list_summary_id"),
                        F.date_add(ship_day, RECEIPT_DAYS).alias("date_received")))

    def fiscal_calendar() -> DataFrame:
        days = (CALENDAR_END - CALENDAR_START).days + 1
        day = F.date_add(F.lit(CALENDAR_START), F.col("id").cast("int"))
        return (spark.range(days)
                .select(day.alias("date"))
                .select("date", fiscal.week_key("date").alias("fy_week_id")))

    def fiscal_date() -> DataFrame:
        return fiscal_calendar().where(F.dayofweek("date") == 7).select("date")

    def inventory() -> DataFrame:
        week_start = fiscal.saturday_on_or_before(ship_day).cast("timestamp_ntz")
        return (lineitem()
                .groupBy(level_names(pk)[0], sku(pk).alias("sku"),
                         channel(ok).alias("platform"), week_start.alias("inventorydate"))
                .agg(F.sum("l_quantity").alias("oh"))
                .select("l0_name", "sku", "platform", "oh", "inventorydate"))

    def forecast_item() -> DataFrame:
        chan = channel(ok)
        return (lineitem()
                .select(level_names(pk)[0].alias("brand"), sku(pk).alias("sku"),
                        hierarchy_code(pk).alias("hierarchy_code"),
                        chan.alias("channel"), chan.alias("sub_channel"),
                        fiscal.week_key(ship_day).alias("fiscal_year_week"),
                        F.col("l_discount").alias("percent_off"),
                        F.col("l_quantity").alias("w_sls_u")))

    def sales_weekly() -> DataFrame:
        return (lineitem()
                .select(level_names(pk)[0], sku(pk).alias("sku"),
                        fiscal.week_key(ship_day).alias("fy_week_id"),
                        channel(ok).alias("sub_channel"),
                        F.col("l_quantity").alias("units")))

    return {
        "plan_forecast": plan_forecast,
        "plan_working": plan_working,
        "plan_ly": _plan_shift(1),
        "plan_lly": _plan_shift(2),
        "product": product,
        "hierarchy": hierarchy,
        "forecast_level": forecast_level,
        "weekly_history": weekly_history,
        "simulation": simulation,
        "purchase_order": purchase_order,
        "packing_list": packing_list,
        "warehouse_receipt": warehouse_receipt,
        "fiscal_calendar": fiscal_calendar,
        "fiscal_date": fiscal_date,
        "inventory": inventory,
        "forecast_item": forecast_item,
        "sales_weekly": sales_weekly,
    }

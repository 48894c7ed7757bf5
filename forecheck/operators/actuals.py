"""Actual-sales operators: four-week windows and comparable units."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecheck.config import WeekRange
from forecheck.functions.paths import brand_sku_key
from forecheck.operators.relational import flag_in


def actuals_window(sales: DataFrame, comparable_keys: DataFrame, weeks: WeekRange,
                   sub_channel: str) -> DataFrame:
    """Weekly sales rows of one sub-channel and week range, with ``comp_flag``
    = brand||sku in the comparable set. Output: all sales columns + comp_flag.
    """
    rows = sales.where(F.col("fy_week_id").between(weeks.lo, weeks.hi)
                       & (F.col("sub_channel") == sub_channel))
    return flag_in(rows, brand_sku_key("l0_name", "sku"), comparable_keys, "comp_flag")


def window_units(flagged: DataFrame, active: DataFrame) -> DataFrame:
    """Comparable units per brand and SKU over the active hierarchy.

    An inner join on (l0_name, sku): a SKU with two active hierarchy rows
    counts its units twice. Output: l0_name, sku, units.
    """
    return (flagged.where(F.col("comp_flag") == 1)
            .join(active.select("l0_name", "sku"), ["l0_name", "sku"])
            .groupBy("l0_name", "sku")
            .agg(F.sum("units").alias("units")))


def window_units_multi(sales: DataFrame, comparable_keys: DataFrame, active: DataFrame,
                       windows: dict[str, WeekRange], sub_channel: str) -> DataFrame:
    """``window_units`` for several week windows in ONE scan and ONE aggregate.

    Each row adds its units to every window containing its week; a window with
    no row for a key gets NULL (the same as the key missing from that window's
    own aggregate once it is COALESCEd). Output: l0_name, sku, one units column
    per window name.
    """
    in_any = None
    for rng in windows.values():
        cond = F.col("fy_week_id").between(rng.lo, rng.hi)
        in_any = cond if in_any is None else (in_any | cond)
    rows = sales.where(in_any & (F.col("sub_channel") == sub_channel))
    flagged = flag_in(rows, brand_sku_key("l0_name", "sku"), comparable_keys, "comp_flag")
    sums = [F.sum(F.when(F.col("fy_week_id").between(r.lo, r.hi), F.col("units"))).alias(name)
            for name, r in windows.items()]
    return (flagged.where(F.col("comp_flag") == 1)
            .join(active.select("l0_name", "sku"), ["l0_name", "sku"])
            .groupBy("l0_name", "sku")
            .agg(*sums))

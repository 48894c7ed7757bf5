"""Planning-table operators: snapshots, year alignment, validation flags."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecheck.config import WeekRange
from forecheck.functions import fiscal
from forecheck.functions.numeric import flag
from forecheck.functions.paths import LEVELS
from forecheck.operators.hierarchy import hierarchy_paths
from forecheck.operators.relational import flags_in, membership


def plan_snapshot(df: DataFrame, channel: str, weeks: WeekRange,
                  measures: dict[str, str], scenario_as: str = "scenario1",
                  distinct: bool = True) -> DataFrame:
    """One channel and week range of a plan table, renamed, distinct (unless the
    caller de-duplicates on fewer columns itself).

    Output: channel, hierarchy_code, fiscal_year_week, <scenario_as>, measures.
    """
    rows = (df.where((F.col("sub_channel") == channel)
                     & F.col("current_week").between(weeks.lo, weeks.hi))
            .select(F.col("sub_channel").alias("channel"), "hierarchy_code",
                    F.col("current_week").alias("fiscal_year_week"),
                    F.col("scenario").alias(scenario_as),
                    *[F.col(src).alias(dst) for src, dst in measures.items()]))
    return rows.distinct() if distinct else rows


_PATHS = [*LEVELS, "product_code"]
_WEEK_KEYS = ["channel", "hierarchy_code", "fiscal_year_week"]
_MEASURES = ["wp", "qty_ly", "qty_lly", "aur_lly", "aur_ly"]


def align_plan_years(base: DataFrame, bridge: DataFrame, working: DataFrame,
                     ly: DataFrame, lly: DataFrame) -> DataFrame:
    """Plan rows beside the working plan and the two prior years, with paths.

    ``base`` fans out to every SKU of its hierarchy code (left join on code);
    the working plan matches on the scenario, the prior years do not.
    Output: l0_name..l5_name and product_code as paths, then base columns,
    wp, qty_ly, qty_lly, aur_lly, aur_ly.
    """
    by_code = bridge.drop("product_id").withColumnRenamed("hierarchy_code", "__code")
    flat = (_plan_years(base, working, ly, lly)
            .join(by_code, F.col("hierarchy_code") == F.col("__code"), "left")
            .select(F.col("channel").alias("__path_channel"), *_PATHS, *base.columns, *_MEASURES))
    return hierarchy_paths(flat, channel="__path_channel").drop("__path_channel")


def _plan_years(base: DataFrame, working: DataFrame, ly: DataFrame, lly: DataFrame) -> DataFrame:
    """The four plan snapshots side by side.

    The working plan is joined first (about one row per plan row); the prior years
    share the key (channel, code, week), so one hash layout of the plan rows
    serves both. They multiply the rows, so a rebalance follows: adaptive
    execution sizes the partitions of the fan-out by their measured bytes.
    """
    return (base.join(working, [*_WEEK_KEYS, "scenario1"], "left")
            .join(ly, _WEEK_KEYS, "left").join(lly, _WEEK_KEYS, "left")
            .select(*base.columns, *_MEASURES).hint("rebalance"))


def normalize_forecast(df: DataFrame) -> DataFrame:
    """Week key split into year and week, discount rounded to 2 places.

    Output: product_code, fiscal_year, fiscal_week, fiscal_year_week, scenario1, qty.
    """
    return df.select("product_code",
                     fiscal.key_year("fiscal_year_week").alias("fiscal_year"),
                     fiscal.key_week("fiscal_year_week").alias("fiscal_week"),
                     "fiscal_year_week",
                     F.round("percent_off", 2).alias("scenario1"),
                     F.col("w_sls_u").alias("qty"))


def validation_flags(base: DataFrame, bridge: DataFrame, working: DataFrame, ly: DataFrame,
                     lly: DataFrame, forecast: DataFrame, comp_narrow: DataFrame,
                     comp_wide: DataFrame, selling_products: DataFrame,
                     new_products: DataFrame, channel: str, cutoff: int,
                     sized: Callable[[DataFrame], DataFrame] = lambda side: side) -> DataFrame:
    """Plan rows with the model forecast and seven 0/1 flags, up to ``cutoff``.

    ``base`` holds the rows of one ``channel``. ``comp_narrow``, ``comp_wide``,
    ``selling_products`` and ``new_products`` are one-column product-code sets; they
    become one table of bit masks, which ``sized`` may hint. Output is distinct.

    Every input is made distinct on what the output keeps of it, before the
    joins: the prior years without their scenarios, the bridge as (code, paths),
    the forecast on key and quantity. A result row then fixes its row of every
    input, so the joined rows are distinct by construction and the fanned-out
    table needs no aggregate.
    """
    upto = F.col("fiscal_year_week") <= cutoff
    paths = (hierarchy_paths(bridge.withColumn("__channel", F.lit(channel)), channel="__channel")
             .select(F.col("hierarchy_code").alias("__code"), *_PATHS).distinct())
    plans = _plan_years(base.where(upto), working.where(upto).distinct(),
                        ly.where(upto).drop("scenario_ly").distinct(),
                        lly.where(upto).drop("scenario_lly").distinct())
    a = (plans.join(paths, F.col("hierarchy_code") == F.col("__code"), "left")
         .select(*_PATHS, *base.columns, *_MEASURES))
    f = forecast.where(upto).select(
        "product_code", "fiscal_year_week", "scenario1", F.col("qty").alias("predicted")).distinct()
    final = (a.join(f, ["product_code", "fiscal_year_week", "scenario1"], "left")
             .withColumn("fiscal_year", fiscal.key_year_text("fiscal_year_week"))
             .withColumn("fiscal_week", fiscal.key_week_text("fiscal_year_week")))
    sets = {"comp_flag_30": comp_narrow, "comp_flag_50": comp_wide,
            "product_with_sales": selling_products, "new_prod_flag": new_products}
    return (flags_in(final, F.col("product_code"), sized(membership(sets)), sets)
            .withColumns({"wp_5_flag": flag(F.col("wp") < 5),
                          "predicted_flag": flag(F.col("predicted").isNotNull()),
                          "sold_week_ly": flag(F.col("qty_ly").isNotNull())}))


def validated_discounts(df: DataFrame) -> DataFrame:
    """Distinct (hierarchy_code, fiscal_year_week, percent_off) of a validation table."""
    return df.select("hierarchy_code", "fiscal_year_week",
                     F.col("scenario1").alias("percent_off")).distinct()

"""Comparable products: sold in both years, similar volume, enough stock."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forecheck.functions import fiscal
from forecheck.functions.numeric import flag, within_band


def weekly_history(history: DataFrame, year: int, qty_as: str = "qty",
                   shift: int = 100) -> DataFrame:
    """One fiscal year of weekly history with the week key moved one year on
    and a 0/1 selling-week flag; distinct.

    Output: product_code, fiscal_year, fiscal_week, fiscal_year_week, <qty_as>,
    oh, msrp, prod_with_sales.
    """
    return (history.where(F.col("fiscal_year") == year)
            .select("product_code", "fiscal_year", "fiscal_week",
                    fiscal.shift_years("fiscal_year_week", 1, shift).alias("fiscal_year_week"),
                    F.col("qty").alias(qty_as), "oh", "msrp",
                    flag(F.col("qty") > 0).alias("prod_with_sales"))
            .distinct())


def on_hand_last_value(weeks: DataFrame) -> DataFrame:
    """``LAST_VALUE(oh)`` over weeks newest-first with the DEFAULT frame
    (unbounded preceding to current row, peers included).

    With one row per product-week this is each week's own stock, not the
    newest stock. Output: product_code, fiscal_year_week, most_recent_oh.
    """
    w = Window.partitionBy("product_code").orderBy(F.desc("fiscal_year_week"))
    return weeks.select("product_code", "fiscal_year_week",
                        F.last("oh").over(w).alias("most_recent_oh"))


def on_hand_latest(weeks: DataFrame) -> DataFrame:
    """Stock of each product's newest week. Output: product_code, most_recent_oh."""
    return (weeks.groupBy("product_code")
            .agg(F.max_by("oh", "fiscal_year_week").alias("most_recent_oh")))


def selling_summary(weeks: DataFrame, qty: str = "qty") -> DataFrame:
    """Per product over selling weeks (qty > 0): units, selling weeks, distinct weeks.

    Output: product_code, total_units, weeks_with_sales, total_weeks.
    """
    return (weeks.where(F.col(qty) > 0)
            .groupBy("product_code")
            .agg(F.sum(qty).alias("total_units"),
                 F.sum("prod_with_sales").alias("weeks_with_sales"),
                 F.count_distinct("fiscal_week").alias("total_weeks")))


def _this_year_summary(ty: DataFrame, qty: str, on_hand: str) -> DataFrame:
    """Selling totals of this year plus the stock figure the rule tests.

    ``as_written``: the rule keeps a product when ANY of its week rows has a
    ``LAST_VALUE`` stock above the threshold (the window result is joined back
    one row per week before the test), so the largest such value is carried.
    ``latest``: the stock of the newest week.
    Both come out of one pass grouped by product.
    """
    selling = F.col(qty) > 0
    totals = [F.sum(F.when(selling, F.col(qty))).alias("total_units_ty"),
              F.sum(F.when(selling, F.col("prod_with_sales"))).alias("weeks_with_sales_ty"),
              F.count(F.when(selling, F.lit(1))).alias("selling_rows")]
    if on_hand == "as_written":
        w = Window.partitionBy("product_code").orderBy(F.desc("fiscal_year_week"))
        stock = ty.withColumn("__oh", F.last("oh").over(w))
        agg = stock.groupBy("product_code").agg(*totals, F.max("__oh").alias("most_recent_oh"))
    elif on_hand == "latest":
        agg = ty.groupBy("product_code").agg(
            *totals, F.max_by("oh", "fiscal_year_week").alias("most_recent_oh"))
    else:
        raise ValueError(f"on_hand must be 'as_written' or 'latest', got {on_hand!r}")
    return agg.where(F.col("selling_rows") > 0).drop("selling_rows")


def comparable_candidates(ty: DataFrame, ly: DataFrame, on_hand: str = "as_written",
                          ty_qty: str = "qty_ty", ly_qty: str = "qty_ly") -> DataFrame:
    """Per product sold in both years: the figures the comparability rules test.

    Frequencies use last year's distinct selling weeks as the denominator for
    both years. Output: product_code, total_units_ty, total_units_ly,
    most_recent_oh, sales_freq_ty, sales_freq_ly (one row per product).
    """
    t = _this_year_summary(ty, ty_qty, on_hand)
    l = (selling_summary(ly, ly_qty)
         .select("product_code", F.col("total_units").alias("total_units_ly"),
                 F.col("weeks_with_sales").alias("weeks_with_sales_ly"),
                 F.col("total_weeks").alias("total_weeks_ly")))
    return (t.join(l, "product_code")
            .select("product_code", "total_units_ty", "total_units_ly", "most_recent_oh",
                    (F.col("weeks_with_sales_ty") / F.col("total_weeks_ly")).alias("sales_freq_ty"),
                    (F.col("weeks_with_sales_ly") / F.col("total_weeks_ly")).alias("sales_freq_ly")))


def comparable_filter(cand: DataFrame, band: tuple[float, float], min_frequency: float = 0.3,
                      min_on_hand: float = 100.0) -> DataFrame:
    """Product codes passing all rules (one column, distinct).

    * selling frequency >= ``min_frequency`` in both years;
    * this year's units within ``band`` x last year's units;
    * stock above ``min_on_hand``.
    """
    lo, hi = band
    return (cand.where((F.col("sales_freq_ly") >= F.lit(float(min_frequency)))
                       & (F.col("sales_freq_ty") >= F.lit(float(min_frequency)))
                       & within_band("total_units_ty", "total_units_ly", lo, hi)
                       & (F.col("most_recent_oh") > F.lit(float(min_on_hand))))
            .select("product_code")
            .distinct())

"""Explainability: compare forecast growth with recent actual growth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecheck.functions.numeric import safe_divide

FINAL_COLUMNS = ("l0_name", "sku", "fct_units", "ty_units", "lt_units", "lf_units",
                 "ty_ly_units_ratio", "fct_ly_units_ratio", "explainable",
                 "non_explainable", "oh_units", "oo_units")


def explainability(fct: DataFrame, actuals: DataFrame, oh: DataFrame, oo: DataFrame,
                   tolerance: float = 0.5, on_order_join: str = "as_written") -> DataFrame:
    """One row per forecast brand+SKU (more when stock rows repeat).

    * ``fct``: forecast units (l0_name, sku, units).
    * ``actuals``: (l0_name, sku, ty_units, lt_units, lf_units) at most one row
      per key: recent actual units, last year's units over the recent weeks and
      over the forecast weeks; a missing key or NULL counts as 0.
    * ``oh``: on-hand rows (l0_name, sku, units), ``oo``: on-order rows.
    * explainable: both last-year sums positive and
      |ty/lt - fct/lf| <= tolerance; non_explainable is its exact complement.
    * ``on_order_join="as_written"`` matches on-order rows by
      ``fct.l0_name = oh.l0_name AND fct.sku = oo.sku``: nothing attaches when
      the on-hand join missed, and otherwise every brand's on-order row for the
      SKU attaches. ``"own_brand"`` matches ``oo`` on its own brand and SKU.
    """
    def side(df: DataFrame, alias: str, cols: dict[str, str]) -> DataFrame:
        return df.select(F.col("l0_name").alias(f"{alias}_l0"), F.col("sku").alias(f"{alias}_sku"),
                         *[F.col(src).alias(dst) for src, dst in cols.items()])

    def on(alias: str):
        return (F.col("l0_name") == F.col(f"{alias}_l0")) & (F.col("sku") == F.col(f"{alias}_sku"))

    j = (fct.select("l0_name", "sku", F.col("units").alias("fct_raw"))
         .join(side(actuals, "a", {"ty_units": "ty_raw", "lt_units": "lt_raw",
                                   "lf_units": "lf_raw"}), on("a"), "left")
         .join(side(oh, "oh", {"units": "oh_units"}), on("oh"), "left"))
    o = side(oo, "oo", {"units": "oo_units"})
    if on_order_join == "as_written":
        cond = (F.col("l0_name") == F.col("oh_l0")) & (F.col("sku") == F.col("oo_sku"))
    elif on_order_join == "own_brand":
        cond = on("oo")
    else:
        raise ValueError(f"on_order_join must be 'as_written' or 'own_brand', got {on_order_join!r}")
    j = j.join(o, cond, "left")

    fct_u = F.coalesce(F.col("fct_raw"), F.lit(0.0))
    ty_u = F.coalesce(F.col("ty_raw"), F.lit(0.0))
    lt_u = F.coalesce(F.col("lt_raw"), F.lit(0.0))
    lf_u = F.coalesce(F.col("lf_raw"), F.lit(0.0))
    ty_ratio = safe_divide(ty_u, lt_u)
    fct_ratio = safe_divide(fct_u, lf_u)
    ok = ((lt_u > 0) & (lf_u > 0)
          & (F.abs(F.coalesce(ty_ratio, F.lit(0.0)) - F.coalesce(fct_ratio, F.lit(0.0)))
             <= F.lit(float(tolerance))))
    explainable = F.coalesce(ok, F.lit(False))
    return j.select("l0_name", "sku",
                    fct_u.alias("fct_units"), ty_u.alias("ty_units"),
                    lt_u.alias("lt_units"), lf_u.alias("lf_units"),
                    ty_ratio.alias("ty_ly_units_ratio"), fct_ratio.alias("fct_ly_units_ratio"),
                    explainable.alias("explainable"), (~explainable).alias("non_explainable"),
                    F.col("oh_units"), F.col("oo_units"))


def explainability_rollup(final: DataFrame, active: DataFrame) -> DataFrame:
    """Explainable and non-explainable row counts per brand and department.

    Joined to the active hierarchy on (l0_name, sku), so a SKU with two active
    rows counts twice; rows with a NULL SKU are not counted.
    Output: l0_name, l1_name, explainable_count, non_explainable_count.
    """
    return (final.join(active.select("l0_name", "sku", "l1_name"), ["l0_name", "sku"])
            .groupBy("l0_name", "l1_name")
            .agg(F.count(F.when(F.col("explainable"), F.col("sku"))).alias("explainable_count"),
                 F.count(F.when(F.col("non_explainable"), F.col("sku"))).alias("non_explainable_count")))


# fixed values: the 15 report headings of the per-SKU detail report, in output order
DETAIL_HEADINGS = (
    ("l0_name", "Brand"),
    ("l1_name", "Department"),
    ("l2_name", "Sub Department"),
    ("l3_name", "Class"),
    ("sku", "SKU"),
    ("ty_units", "ForecastRecent4Week"),
    ("lf_units", "LY4Week"),
    ("fct_units", "Forecast4Week"),
    ("lt_units", "LYRecent4Week"),
    ("ty_ly_units_ratio", "ForecastRecent4week_to_LYRecent4week"),
    ("fct_ly_units_ratio", "Forecast4week_to_LY4week"),
    ("key", "concat"),
    ("oh_units", "End of Period Inv"),
    ("oo_units", "On Order"),
    ("explainable", "Explainability from 1a"),
)


def sku_detail_report(final: DataFrame, active: DataFrame) -> DataFrame:
    """Per-SKU report with department levels and business headings."""
    rows = (final.join(active.select("l0_name", "sku", "l1_name", "l2_name", "l3_name"),
                       ["l0_name", "sku"])
            .withColumn("key", F.concat("l0_name", "sku")))
    return rows.select(*[F.col(src).alias(head) for src, head in DETAIL_HEADINGS])

"""Forecast operators: candidates, validated-or-default selection, units."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecheck.config import WeekRange
from forecheck.functions.paths import brand_sku_key
from forecheck.operators.relational import flag_in, not_in_flag

FORECAST_COLUMNS = ("l0_name", "sku", "hierarchy_code", "channel", "sub_channel",
                    "fiscal_year_week", "comp_flag", "percent_off", "w_sls_u")


def forecast_candidates(items: DataFrame, active: DataFrame, weeks: WeekRange,
                        sub_channel: str) -> DataFrame:
    """Forecast rows of one sub-channel and week range whose hierarchy code is
    active. A row repeats once per active hierarchy row of its code.

    ``active`` is the (size-checked) active hierarchy.
    Output: brand, sku, hierarchy_code, channel, sub_channel, fiscal_year_week,
    percent_off, w_sls_u.
    """
    codes = active.select("hierarchy_code")
    return (items.where(F.col("fiscal_year_week").between(weeks.lo, weeks.hi)
                        & (F.col("sub_channel") == sub_channel))
            .join(codes, "hierarchy_code")
            .select("brand", "sku", "hierarchy_code", "channel", "sub_channel",
                    "fiscal_year_week", "percent_off", "w_sls_u"))


def select_forecast(cand: DataFrame, discounts: DataFrame, code_set: DataFrame,
                    comparable_keys: DataFrame, default_discount: float,
                    branch: str = "both") -> DataFrame:
    """Choose each forecast row's discount scenario.

    * validated: the row's (code, discount, week) is a validated discount;
    * default: the code was never validated (SQL ``NOT IN`` rules, a NULL code
      in the set empties this branch) and the row's discount is the default.
    The branches cannot share a code. Codes validated at other weeks or
    discounts fall in neither branch. Rows get ``comp_flag`` = brand||sku in
    the comparable set.

    Both branches come from ONE pass over the candidates: a left join against
    the validated triples and one against the validated codes.

    ``discounts``: distinct (hierarchy_code, fiscal_year_week, percent_off),
    size-checked; ``code_set``: its distinct hierarchy codes, size-checked;
    ``comparable_keys``: distinct brand||sku keys.
    Output: ``FORECAST_COLUMNS``.
    """
    v = discounts.select(F.col("hierarchy_code").alias("__v_code"),
                         F.col("fiscal_year_week").alias("__v_week"),
                         F.col("percent_off").alias("__v_pct"))
    codes = code_set.select(F.col(code_set.columns[0]).alias("__c_code"),
                            F.lit(True).alias("__c_hit"))
    joined = (cand
              .join(v, (F.col("hierarchy_code") == F.col("__v_code"))
                    & (F.col("percent_off") == F.col("__v_pct"))
                    & (F.col("fiscal_year_week") == F.col("__v_week")), "left")
              .join(codes, F.col("hierarchy_code") == F.col("__c_code"), "left"))
    validated = F.col("__v_code").isNotNull()
    never = not_in_flag(F.col("hierarchy_code"), F.col("__c_hit").isNotNull(), code_set)
    default = F.coalesce(never, F.lit(False)) & (F.col("percent_off") == F.lit(float(default_discount)))
    keep = {"both": validated | default, "validated": validated, "default": default}[branch]
    chosen = (joined.where(keep)
              .withColumn("__pct", F.when(validated, F.col("__v_pct"))
                          .otherwise(F.lit(float(default_discount)))))
    flagged = flag_in(chosen, brand_sku_key("brand", "sku"), comparable_keys, "comp_flag")
    return flagged.select(F.col("brand").alias("l0_name"), "sku", "hierarchy_code", "channel",
                          "sub_channel", "fiscal_year_week", "comp_flag",
                          F.col("__pct").alias("percent_off"), "w_sls_u")


def forecast_units(fc: DataFrame) -> DataFrame:
    """Comparable forecast units per brand and SKU. Output: l0_name, sku, units."""
    return (fc.where(F.col("comp_flag") == 1)
            .groupBy("l0_name", "sku")
            .agg(F.sum("w_sls_u").alias("units")))

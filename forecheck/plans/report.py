"""The forecast validation report, composed from the operators.

``ForecastValidation`` builds every intermediate of the report once (lazily)
so the registry, the tests and the benchmark all read the same plans.

Data flow (each arrow is a DataFrame function of ``forecheck.operators``)::

    plan tables --plan_snapshot--> base/wp/ly/lly --align_plan_years--> aligned
    forecast_level --normalize_forecast--> forecast_norm
    weekly_history --weekly_history(ty/ly)--> comparable_products (0.3 / 0.5)
    aligned + forecast_norm + comparable sets --validation_flags--> validation
    base (cutoff) --validated_discounts--> discounts
    comparable (0.5) --product_code_parts--> comparable SKUs (one channel)
    forecast_item --forecast_candidates--> candidates --select_forecast--> forecast
    sales_weekly --window_units_multi--> recent / same weeks LY / forward weeks LY
    PO + packing + receipt --po_status--> chain --open_by_arrival--> on_order_units
    inventory --on_hand_snapshot--> on hand
    all of them --explainability--> final --explainability_rollup--> report
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecheck.config import DEFAULT_SIZING, ReportParams, Sizing
from forecheck.functions.paths import brand_sku_key
from forecheck.operators import (actuals, comparable, explain, forecast, hierarchy, plan,
                                 supply)
from forecheck.operators.relational import Side, Sides, estimated_bytes
from forecheck.operators.skew import HeavyKeys, heavy_keys
from forecheck.sources.tables import Tables
from forecheck.sources.weekly_sums import WeeklySums, weeks_of


class ForecastValidation:
    """Use as a context manager, or call ``close()`` when the results are written:
    it releases the frames that were persisted."""

    def __init__(self, tables: Tables, params: ReportParams, sizing: Sizing = DEFAULT_SIZING):
        self.t = tables
        self.p = params
        self.sides = Sides(sizing)
        self._cand: dict[str, DataFrame] = {}
        self._fact_sides: dict[str, Side] = {}

    def close(self) -> None:
        self.sides.close()

    def __enter__(self) -> ForecastValidation:
        return self

    def __exit__(self, *exc) -> None:
        self.close()

    # ---- measured join sides -------------------------------------------------
    # only sides that meet a raw fact table are measured, each when it is first asked
    # for; everything else is left to adaptive execution, which knows the size of
    # finished shuffles
    def _fact_side(self, name: str) -> Side:
        if name not in self._fact_sides:
            self._fact_sides[name] = self.sides.check(getattr(self, name))
        return self._fact_sides[name]

    def _measure(self, *names: str) -> None:
        """Measure the sides that one result needs at the same time."""
        missing = {n: getattr(self, n) for n in names if n not in self._fact_sides}
        self._fact_sides |= self.sides.check_all(missing)

    # ---- product dimension -------------------------------------------------
    @cached_property
    def active_rows(self) -> DataFrame:
        """Active hierarchy rows at the mapping level."""
        return hierarchy.active_hierarchy(self.t.hierarchy, self.t.product, self.p.hierarchy_level)

    @property
    def active(self) -> DataFrame:
        """The same as a size-checked join side."""
        return self._fact_side("active_rows").frame

    @cached_property
    def bridge(self) -> DataFrame:
        return hierarchy.product_bridge(self.t.product, self.t.hierarchy, self.p.hierarchy_level)

    # ---- plan side -----------------------------------------------------------
    @cached_property
    def plan_base(self) -> DataFrame:
        return plan.plan_snapshot(self.t.plan_forecast, self.p.plan_channel, self.p.plan_weeks,
                                  {"written_sales_units": "plan_units", "written_aur": "plan_aur"})

    @cached_property
    def plan_wp(self) -> DataFrame:
        return plan.plan_snapshot(self.t.plan_working, self.p.plan_channel, self.p.plan_weeks,
                                  {"written_sales_units": "wp"})

    @cached_property
    def plan_ly(self) -> DataFrame:
        return plan.plan_snapshot(self.t.plan_ly, self.p.plan_channel, self.p.plan_weeks,
                                  {"written_sales_units": "qty_ly", "written_aur": "aur_ly"},
                                  scenario_as="scenario_ly")

    @cached_property
    def plan_lly(self) -> DataFrame:
        return plan.plan_snapshot(self.t.plan_lly, self.p.plan_channel, self.p.plan_weeks,
                                  {"written_sales_units": "qty_lly", "written_aur": "aur_lly"},
                                  scenario_as="scenario_lly")

    @cached_property
    def aligned(self) -> DataFrame:
        return plan.align_plan_years(self.plan_base, self._bridge_side, self.plan_wp,
                                     self.plan_ly, self.plan_lly)

    @cached_property
    def _bridge_side(self) -> DataFrame:
        # the plan rows fan out on the bridge and should not be shuffled for it
        return self.sides.check(self.bridge).frame

    @cached_property
    def forecast_norm(self) -> DataFrame:
        return plan.normalize_forecast(self.t.forecast_level)

    @cached_property
    def validation(self) -> DataFrame:
        selling = self.hist_ty.where(F.col("qty_ty") > 0).select("product_code")
        new = self.t.simulation.where(
            F.col("algorithm_name").isin(list(self.p.new_product_algorithms))).select("product_code")
        # only forecast rows of the plan weeks can match a plan row
        weeks = self.p.plan_weeks
        fc = self.forecast_norm.where(
            F.col("fiscal_year_week").between(weeks.lo, min(weeks.hi, self.p.plan_cutoff)))
        return plan.validation_flags(
            self.plan_base, self._bridge_side, self.plan_wp, self.plan_ly, self.plan_lly, fc,
            self.comp_narrow, self.comp_wide, selling, new, self.p.plan_channel, self.p.plan_cutoff,
            sized=lambda members: self.sides.check(members).frame)

    @cached_property
    def discount_rows(self) -> DataFrame:
        """Validated (code, week, discount) triples.

        The validation table left-joins extra columns onto the cutoff-filtered
        plan snapshot; left joins keep every snapshot row, so its distinct
        (code, week, scenario) equals the snapshot's, read here directly.
        """
        rows = plan.plan_snapshot(self.t.plan_forecast, self.p.plan_channel, self.p.plan_weeks, {},
                                  distinct=False)
        return plan.validated_discounts(rows.where(F.col("fiscal_year_week") <= self.p.plan_cutoff))

    @property
    def discounts(self) -> DataFrame:
        """The same as a size-checked join side."""
        return self._fact_side("discount_rows").frame

    @cached_property
    def discount_codes(self) -> DataFrame:
        return self._fact_side("discount_rows").keys("hierarchy_code", "hierarchy_code").frame

    # ---- comparable products -------------------------------------------------
    @cached_property
    def hist_ty(self) -> DataFrame:
        """This year's weekly rows (one row per product-week; reused by several
        steps, so kept once)."""
        return self.sides.keep(comparable.weekly_history(
            self.t.weekly_history, self.p.this_year, "qty_ty", self.p.year_shift))

    @cached_property
    def hist_ly(self) -> DataFrame:
        return comparable.weekly_history(self.t.weekly_history, self.p.last_year, "qty_ly",
                                         self.p.year_shift)

    def comp_candidates(self, on_hand: str = "as_written") -> DataFrame:
        """Per-product comparability figures, one row per product, kept once per
        stock reading and shared by both tolerance bands."""
        if on_hand not in self._cand:
            self._cand[on_hand] = self.sides.keep(comparable.comparable_candidates(
                self.hist_ty, self.hist_ly, on_hand))
        return self._cand[on_hand]

    def comparable(self, band: tuple[float, float], on_hand: str = "as_written") -> DataFrame:
        return comparable.comparable_filter(self.comp_candidates(on_hand), band,
                                            self.p.min_sales_frequency, self.p.min_on_hand)

    @cached_property
    def comp_narrow(self) -> DataFrame:
        return self.comparable(self.p.narrow_band)

    @cached_property
    def comp_wide(self) -> DataFrame:
        return self.comparable(self.p.wide_band)

    @cached_property
    def comparable_skus(self) -> DataFrame:
        return hierarchy.product_code_parts(self.comp_wide, self.p.history_channel)

    @cached_property
    def comparable_keys(self) -> DataFrame:
        return self._fact_side("comparable_skus").keys(brand_sku_key("l0_name", "sku")).frame

    # ---- forecast side -------------------------------------------------------
    @cached_property
    def candidates(self) -> DataFrame:
        return forecast.forecast_candidates(self.t.forecast_item, self.active, self.p.forward,
                                            self.p.forecast_sub_channel)

    def selected(self, branch: str = "both") -> DataFrame:
        self._measure("active_rows", "discount_rows", "comparable_skus")
        return forecast.select_forecast(self.candidates, self.discounts, self.discount_codes,
                                        self.comparable_keys, self.p.default_discount, branch)

    @cached_property
    def forecast(self) -> DataFrame:
        return self.selected("both")

    @cached_property
    def fct_units(self) -> DataFrame:
        return forecast.forecast_units(self.forecast)

    # ---- actuals ---------------------------------------------------------------
    def window(self, weeks) -> DataFrame:
        return actuals.actuals_window(self.t.sales_weekly, self.comparable_keys, weeks,
                                      self.p.sales_sub_channel)

    def units(self, weeks) -> DataFrame:
        self._measure("active_rows", "comparable_skus")
        return actuals.window_units(self.window(weeks), self.active)

    @cached_property
    def actual_units(self) -> DataFrame:
        """Recent, recent-LY and forward-LY units in one scan of the sales table."""
        self._measure("active_rows", "comparable_skus")
        return actuals.window_units_multi(
            self.t.sales_weekly, self.comparable_keys, self.active,
            {"ty_units": self.p.recent, "lt_units": self.p.recent_ly,
             "lf_units": self.p.forward_ly}, self.p.sales_sub_channel)

    def actual_units_from(self, sums: WeeklySums) -> DataFrame:
        """``actual_units`` from kept weekly sums: adds the weeks of the windows that the
        table of sums lacks, then reads the sums instead of the sales."""
        windows = (self.p.recent, self.p.recent_ly, self.p.forward_ly)
        weeks = weeks_of(self.t.sales_weekly, windows)
        sums.update(self.t.sales_weekly, weeks)
        self._measure("active_rows", "comparable_skus")
        return actuals.window_units_multi(
            sums.read(weeks), self.comparable_keys, self.active,
            {"ty_units": self.p.recent, "lt_units": self.p.recent_ly,
             "lf_units": self.p.forward_ly}, self.p.sales_sub_channel)

    # ---- supply ----------------------------------------------------------------
    @cached_property
    def _heavy(self) -> dict[str, HeavyKeys | None]:
        """Hot keys of the packing list and the receipts, searched for where the
        tables are large enough to have a partition that matters."""
        found = {}
        for name, df, key in (("heavy_lines", self.t.packing_list, supply.LINE_KEY),
                              ("heavy_shipments", supply.receipts(self.t.warehouse_receipt),
                               supply.SHIPMENT_KEY)):
            large = estimated_bytes(df) >= self.sides.sizing.skew_min_bytes
            found[name] = heavy_keys(df, key) if large else None
        return found

    def _po_status(self, arriving=None) -> DataFrame:
        # the size of what an arrival span leaves is not known before the run
        tasks = self.t.order_tasks if arriving is None else None
        return supply.po_status(self.t.purchase_order, self.t.packing_list,
                                self.t.warehouse_receipt, self.p.as_of, self.p.po_brands,
                                self.p.default_brand, arriving, tasks=tasks, **self._heavy)

    @cached_property
    def chain(self) -> DataFrame:
        return self._po_status()

    @cached_property
    def arrivals(self) -> DataFrame:
        return supply.open_by_arrival(self.chain, self.t.fiscal_calendar, self.p.as_of)

    @cached_property
    def on_order(self) -> DataFrame:
        week, calendar = self.p.on_order_week, self.t.fiscal_calendar
        chain = self._po_status(supply.week_span(calendar, week))
        arrivals = supply.open_by_arrival(chain, calendar, self.p.as_of)
        return supply.on_order_units(arrivals, self.p.order_channel, week)

    @cached_property
    def on_hand(self) -> DataFrame:
        return supply.on_hand_snapshot(self.t.inventory, self.t.fiscal_date,
                                       self.p.inventory_platform, self.p.as_of)

    # ---- result ----------------------------------------------------------------
    def final(self, on_order_join: str = "as_written") -> DataFrame:
        return explain.explainability(self.fct_units, self.actual_units, self.on_hand,
                                      self.on_order, self.p.explain_tolerance, on_order_join)

    def rollup(self, on_order_join: str = "as_written") -> DataFrame:
        return explain.explainability_rollup(self.final(on_order_join), self.active)

    def detail(self) -> DataFrame:
        return explain.sku_detail_report(self.final(), self.active)

"""Run parameters.

Every week window, channel name, tolerance and "today" of the report is a
parameter here instead of a literal in a query.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import MISSING, dataclass, fields


@dataclass(frozen=True)
class WeekRange:
    """Inclusive range of fiscal week keys (``YYYYWW``)."""

    lo: int
    hi: int


@dataclass(frozen=True)
class ReportParams:
    """Everything a run has to be told: no field that depends on the data has a
    default. ``sources.fixtures.PARAMS`` holds the values of the test tables."""

    # channel value per source: the tables name the same channel differently
    plan_channel: str
    history_channel: str
    order_channel: str
    inventory_platform: str
    forecast_sub_channel: str
    sales_sub_channel: str

    # weekly history years compared for comparability (this year, last year)
    this_year: int
    last_year: int

    # four-week windows
    recent: WeekRange
    recent_ly: WeekRange
    forward: WeekRange
    forward_ly: WeekRange

    # validated plan weeks and the cutoff applied on top of them
    plan_weeks: WeekRange
    plan_cutoff: int

    # discount used for hierarchy codes that were never validated
    default_discount: float

    # "today" of the report; never current_date() inside a plan, so runs are repeatable
    as_of: dt.date
    on_order_week: int

    # brands accepted on purchase orders; anything else becomes default_brand
    po_brands: tuple[str, ...]
    default_brand: str

    # comparability rules
    narrow_tolerance: float = 0.3
    wide_tolerance: float = 0.5
    min_sales_frequency: float = 0.3
    min_on_hand: float = 100.0

    # explainability rule
    explain_tolerance: float = 0.5

    # hierarchy level that maps a hierarchy code to SKUs
    hierarchy_level: int = 7

    # simulation algorithms that mark a product as new
    new_product_algorithms: tuple[str, ...] = ("new_item_average", "new_item")

    # week-key shift that moves last year's rows onto this year's keys
    year_shift: int = 100

    @classmethod
    def from_json(cls, values: dict, as_of: dt.date | None = None) -> ReportParams:
        """Parameters from a JSON object with the field names above: week ranges
        as ``[first, last]``, dates as ``YYYY-MM-DD``. ``as_of`` may be given
        apart; unknown and missing fields are errors."""
        values = dict(values)
        if as_of is not None:
            values["as_of"] = as_of.isoformat()
        known = {f.name: f for f in fields(cls)}
        unknown = sorted(set(values) - set(known))
        missing = sorted(n for n, f in known.items() if f.default is MISSING and n not in values)
        if unknown or missing:
            raise ValueError(f"report parameters: missing {missing}, unknown {unknown}")
        kinds = {"WeekRange": lambda v: WeekRange(*map(int, v)), "dt.date": dt.date.fromisoformat,
                 "tuple[str, ...]": tuple, "int": int, "float": float, "str": str}
        return cls(**{n: kinds[known[n].type](v) for n, v in values.items()})

    @property
    def narrow_band(self) -> tuple[float, float]:
        return (1.0 - self.narrow_tolerance, 1.0 + self.narrow_tolerance)

    @property
    def wide_band(self) -> tuple[float, float]:
        return (1.0 - self.wide_tolerance, 1.0 + self.wide_tolerance)


@dataclass(frozen=True)
class Sizing:
    """Size bounds used before hinting a broadcast.

    A side is broadcast only after a probe checked its row count against
    ``broadcast_max_rows`` and its size against ``broadcast_max_bytes``; larger sides fall
    back to a shuffle join (with AQE skew splitting).
    """

    broadcast_max_rows: int = 1_000_000
    broadcast_max_bytes: int = 64 * 1024 * 1024
    # a table below this size (as its scan estimates it) has no partition that a hot
    # key could make too large, so its keys are not searched for one
    skew_min_bytes: int = 256 * 1024 * 1024


DEFAULT_SIZING = Sizing()

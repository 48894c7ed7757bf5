"""Report steps against their SQL twins on disturbed role tables: NULLs, repeated
rows and missing rows that the fixture never holds."""

import random

import duckdb
import pyarrow as pa
import pytest

from conftest import SF_SMALL
from forecheck.config import Sizing
from forecheck.plans import oracle_sql
from forecheck.plans.report import ForecastValidation
from forecheck.sources import fixtures
from forecheck.sources.tables import ROLES, Tables

# rows of one product and week must stay one: LAST_VALUE has no order among them
UNREPEATED = {"weekly_history"}
# a path without its segments is an error by rule, and keys that decide a window stay
KEPT = {"product_code", "fiscal_year", "fiscal_week", "fiscal_year_week", "current_week", "fy_week_id",
        "date", "level", "active"}


def _disturbed(table: pa.Table, role: str, rng: random.Random) -> pa.Table:
    rows = [k for k in range(table.num_rows) if rng.random() > 0.05]
    if role not in UNREPEATED:
        rows += [k for k in rows if rng.random() < 0.05]
    table = table.take(pa.array(rows, pa.int64()))
    for i, name in enumerate(table.column_names):
        if name not in KEPT:
            gone = pa.array([rng.random() < 0.03 for _ in range(table.num_rows)])
            column = pa.compute.if_else(gone, pa.scalar(None, table.schema.field(i).type), table.column(i))
            table = table.set_column(i, name, column)
    return table


@pytest.mark.parametrize("seed", [1, 2])
def test_steps_equal_their_sql(spark, seed):
    rng = random.Random(seed)
    plain = Tables.from_driver_tables(spark, SF_SMALL)
    con = duckdb.connect()
    builders = {}
    for role in ROLES:
        own = _disturbed(plain[role].toArrow(), role, rng)
        con.register(role, own)
        frame = spark.createDataFrame(own)
        builders[role] = lambda frame=frame: frame
    logic = oracle_sql._LOGIC
    for name, block in oracle_sql._BLOCKS.items():
        logic = logic.replace(f"@{name}@", block)
    sizing = Sizing() if seed == 1 else Sizing(0, 0)
    with ForecastValidation(Tables(spark, builders), fixtures.PARAMS, sizing) as r:
        steps = {
            "plan_snapshot": r.plan_base, "product_bridge": r.bridge, "active_hierarchy": r.active,
            "plan_year_alignment": r.aligned, "comparable_30": r.comp_narrow, "comparable_50": r.comp_wide,
            "validation_flags": r.validation, "validated_discounts": r.discounts,
            "po_receipt_chain": r.chain, "open_by_arrival": r.arrivals, "on_order_units": r.on_order,
            "on_hand_week_boundary": r.on_hand, "forecast_selected": r.forecast,
            "actual_units": r.actual_units, "sku_explainability": r.final(),
            "on_order_join_own_brand": r.final("own_brand"), "explainability_rollup": r.rollup()}
        for name, df in steps.items():
            want = con.execute(f"WITH {logic.strip()}\n{oracle_sql._BODIES[name]}")
            columns = [c[0] for c in want.description]
            clean = lambda rows: sorted(
                tuple(f"{v:.9g}" if isinstance(v, float) else str(v) for v in x) for x in rows)
            assert clean(map(tuple, df.select(*columns).collect())) == clean(want.fetchall()), name

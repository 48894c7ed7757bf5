"""Named-table scans and the role-table bundle the operators read."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# the role tables of the report (FIXTURES.md section 3)
ROLES = (
    "plan_forecast", "plan_working", "plan_ly", "plan_lly",
    "product", "hierarchy", "forecast_level", "weekly_history", "simulation",
    "purchase_order", "packing_list", "warehouse_receipt",
    "fiscal_calendar", "fiscal_date", "inventory",
    "forecast_item", "sales_weekly",
)


def load(spark: SparkSession, location: str, name: str) -> DataFrame:
    """Scan one table: a catalog table name, or ``<location>/<name>.parquet``.

    Parquet scans keep column pruning and filter pushdown; nothing is read
    until an action runs.
    """
    if not location:
        return spark.table(name)
    return spark.read.parquet(os.path.join(location, f"{name}.parquet"))


class Tables:
    """Lazily built role tables, each built once per bundle.

    Building each role once means every operator that reads a role reads the
    same logical plan, so Spark can reuse exchanges between them.
    """

    def __init__(self, spark: SparkSession, builders: dict[str, Callable[[], DataFrame]],
                 order_tasks: Callable[[], int | None] = lambda: None):
        self.spark = spark
        self._builders = builders
        self._order_tasks = order_tasks
        self._built: dict[str, DataFrame] = {}

    def __getattr__(self, role: str) -> DataFrame:
        if role.startswith("_") or role not in self._builders:
            raise AttributeError(role)
        if role not in self._built:
            self._built[role] = self._builders[role]()
        return self._built[role]

    @property
    def order_tasks(self) -> int | None:
        """Tasks that the joins of the order tables are dealt out over; None where the
        tables are small, stored in the joins' layout, or left to adaptive execution."""
        return self._order_tasks()

    def __getitem__(self, role: str) -> DataFrame:
        return getattr(self, role)

    @classmethod
    def from_catalog(cls, spark: SparkSession, names: dict[str, str],
                     location: str = "") -> "Tables":
        """Role tables that exist as real tables (catalog names or parquet files)."""
        builders = {role: (lambda n=name: load(spark, location, n))
                    for role, name in names.items()}
        return cls(spark, builders)

    @classmethod
    def from_driver_tables(cls, spark: SparkSession, sf_dir: str) -> "Tables":
        """Role tables derived from the driver's TPC-H-like parquet tables."""
        from forecheck.operators.relational import spread_tasks
        from forecheck.sources import fixtures

        return cls(spark, fixtures.builders(spark, sf_dir),
                   lambda: spread_tasks(load(spark, sf_dir, "lineitem")))

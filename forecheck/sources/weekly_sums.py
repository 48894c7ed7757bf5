"""Weekly partial sums of the sales, kept as a table that grows week by week.

A run of the report sums three four-week windows, eleven or twelve weeks that the
run a week before has read almost all of. Here each week's units are summed once,
per (brand, SKU, sub-channel), and kept; a run adds the weeks that are new and sums
its windows from the kept rows, so it reads one new week of the raw sales.

Layout under a folder of the caller's choice::

    attempt-<id>/fy_week_id=YYYYWW/*.parquet    rows of the weeks of one update
    manifests/<id>/                             written last: which weeks the attempt holds

A week counts from the latest manifest that lists it (a week without sales is
listed, too); part files without a manifest are what a failed update left and are
never read. An update is one scan with a filter on its weeks, which prunes a table
that is partitioned by week, and one aggregate with partial sums.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecheck.config import WeekRange

KEYS = ["l0_name", "sku", "sub_channel"]
WEEK = "fy_week_id"
SCHEMA = f"l0_name string, sku string, sub_channel string, units double, {WEEK} bigint"


def weeks_of(sales: DataFrame, windows: Iterable[WeekRange]) -> list[int]:
    """The weeks inside the windows that ``sales`` holds rows of: a DISTINCT over the
    week column alone, below a filter on the windows."""
    inside = F.lit(False)
    for w in windows:
        inside = inside | F.col(WEEK).between(w.lo, w.hi)
    return sorted(r[0] for r in sales.where(inside).select(WEEK).distinct().collect())


class WeeklySums:
    """Partial sums by week in one folder that the driver and all executors share."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def held(self) -> dict[int, str]:
        """Week -> attempt folder that counts for it."""
        try:
            lines = self.spark.read.text(f"{self.folder}/manifests/*").collect()
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in (e.getCondition() or ""):
                raise
            return {}
        entries = sorted((json.loads(r.value) for r in lines if r.value), key=lambda e: (e["stamp"], e["attempt"]))
        return {week: e["attempt"] for e in entries for week in e["weeks"]}

    def update(self, sales: DataFrame, weeks: Iterable[int], again: Iterable[int] = ()) -> list[int]:
        """Add the ``weeks`` that are not held yet, and those of ``again`` (weeks whose
        sales were corrected) in any case; return the weeks that were read."""
        held = self.held()
        new = sorted({w for w in weeks if w not in held} | set(again))
        if not new:
            return []
        stamp = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
        name = f"{stamp}-{uuid.uuid4().hex[:12]}"
        attempt = f"{self.folder}/attempt-{name}"
        sums = (sales.where(F.col(WEEK).isin(new)).groupBy(*KEYS, WEEK)
                .agg(F.sum("units").cast("double").alias("units")))
        sums.hint("rebalance", WEEK).write.partitionBy(WEEK).parquet(attempt)
        line = json.dumps({"stamp": stamp, "attempt": attempt, "weeks": new})
        (self.spark.createDataFrame([(line,)], "value string").coalesce(1)
         .write.text(f"{self.folder}/manifests/{name}"))
        return new

    def read(self, weeks: Iterable[int]) -> DataFrame:
        """(l0_name, sku, sub_channel, units, fy_week_id) of held weeks. A week that is
        not held is an error; each attempt is one scan of its week folders."""
        weeks, held = sorted(set(weeks)), self.held()
        missing = [w for w in weeks if w not in held]
        if missing:
            raise KeyError(f"weeks not summed yet: {missing}")
        out = self.spark.createDataFrame([], SCHEMA)
        for attempt in sorted({held[w] for w in weeks}):
            own = [w for w in weeks if held[w] == attempt]
            part = self.spark.read.schema(SCHEMA).parquet(attempt).where(F.col(WEEK).isin(own))
            out = out.unionByName(part)
        return out

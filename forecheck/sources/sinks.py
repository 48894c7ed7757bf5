"""Report sinks: dated output name, distributed write, publishing, row/column profile."""

from __future__ import annotations

import datetime as dt
import json
import os
import uuid
from dataclasses import asdict, dataclass
from zoneinfo import ZoneInfo

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# fixed values: report name stem and the time zone of the dated file name
REPORT_STEM = "Forecast_Validation"
REPORT_TZ = "Asia/Kolkata"
MANIFESTS = "manifests"


def report_path(base_dir: str, now: dt.datetime, stem: str = REPORT_STEM) -> str:
    """``<base_dir>/<stem> - DD Mon YYYY`` with the date taken in India time.

    ``now`` must be timezone-aware (pass ``datetime.now(timezone.utc)``).
    """
    local = now.astimezone(ZoneInfo(REPORT_TZ))
    return os.path.join(base_dir, f"{stem} - {local.strftime('%d %b %Y')}")


def export_report(df: DataFrame, path: str, fmt: str = "csv") -> str:
    """Write a frame where the executors can all reach it, with a header and
    no index column; each task writes its own part file (nothing passes
    through the driver). ``fmt``: ``csv`` or ``parquet``. An existing folder is an error.
    """
    writer = df.write.mode("errorifexists")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"fmt must be 'csv' or 'parquet', got {fmt!r}")
    return path


def run_profile(df: DataFrame) -> DataFrame:
    """One row: the report's row count and column count."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count", F.lit(len(df.columns)).alias("column_count"))


@dataclass(frozen=True)
class Published:
    """What a manifest says of a published report."""

    path: str                # folder with the part files
    fmt: str
    rows: int
    columns: tuple[str, ...]
    published_at: str        # UTC, sorts by time
    schema: str              # JSON of the columns' types


def publish_report(df: DataFrame, folder: str, fmt: str = "csv",
                   now: dt.datetime | None = None) -> Published:
    """Write a report into a fresh attempt folder inside ``folder`` and publish it by a
    manifest, which is written last.

    Nothing that was published before is touched: a run that fails, at any point,
    leaves part files that no manifest names, and readers go on with the manifest
    before. Of several manifests the latest counts. A manifest is a small JSON dataset
    of its own folder, complete or (for readers) not there at all.
    """
    now = now or dt.datetime.now(dt.timezone.utc)
    stamp = now.astimezone(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    attempt = f"{stamp}-{uuid.uuid4().hex[:12]}"
    path = f"{folder}/attempt-{attempt}"
    rows, _ = export_with_profile(df, path, fmt)
    entry = Published(path, fmt, rows, tuple(df.columns), stamp, df.schema.json())
    manifest = df.sparkSession.createDataFrame([(json.dumps(asdict(entry)),)], "value string")
    manifest.coalesce(1).write.mode("errorifexists").text(f"{folder}/{MANIFESTS}/{attempt}")
    return entry


def published(spark: SparkSession, folder: str) -> list[Published]:
    """Manifests of a report folder, the latest first; none if nothing is published."""
    try:
        # only finished files count: a manifest that is being written is in a
        # temporary folder, which readers do not list
        lines = spark.read.text(f"{folder}/{MANIFESTS}/*").collect()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in (e.getCondition() or ""):
            raise
        return []
    found = [json.loads(r.value) for r in lines if r.value]
    entries = [Published(**{**e, "columns": tuple(e["columns"])}) for e in found]
    return sorted(entries, key=lambda e: (e.published_at, e.path), reverse=True)


def read_report(spark: SparkSession, folder: str) -> DataFrame:
    """The report last published in ``folder``, with the types it was written with."""
    entries = published(spark, folder)
    if not entries:
        raise FileNotFoundError(f"no published report in {folder}")
    latest = entries[0]
    schema = StructType.fromJson(json.loads(latest.schema))
    reader = spark.read.schema(schema)
    if latest.fmt == "csv":
        return reader.option("header", True).csv(latest.path)
    return reader.parquet(latest.path)


def export_with_profile(df: DataFrame, path: str, fmt: str = "csv") -> tuple[int, int]:
    """Write the report and return (rows, columns) counted during the same
    write through an observation, so the report is not read twice."""
    obs = Observation("report_profile")
    export_report(df.observe(obs, F.count(F.lit(1)).alias("rows")), path, fmt)
    return int(obs.get["rows"]), len(df.columns)

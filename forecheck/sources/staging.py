"""Materialize the driver-table role views once, as Parquet role tables.

The role views in ``fixtures`` recompute week keys and aggregates from
``lineitem`` on every read, and their week filters cannot reach the scan
(the week is derived from ``l_shipdate``). Staging writes each role once to the
shared checkpoint folder, laid out as the production tables would be:

* fact-like roles partitioned by fiscal week (``sales_weekly``,
  ``forecast_item``) or fiscal year (``weekly_history``), so the report's week
  and year filters become partition filters;
* the order tables (purchase orders, packing list, receipts) bucketed and sorted by
  (order, SKU) into the same number of buckets, so the joins of the order chain and
  the DISTINCTs between them need no shuffle of these tables at all;
* everything else as plain Parquet, where filters on stored columns push down.

Each stage lives under ``<checkpoint dir>/forecheck-roles/<fingerprint>``; the
fingerprint covers the input files (path, size, modification time, at any depth)
and the code of fixtures and staging, so changed inputs or definitions get a new stage. Files are
listed by Spark, so any store it reads will do; a missing input is an error. Writers use a
fresh attempt folder and publish it by writing a one-line marker last; readers
only ever see complete attempts.
"""

from __future__ import annotations

import hashlib
import inspect
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from forecheck.session import shared_subdir
from forecheck.sources import fixtures
from forecheck.sources.tables import Tables

# role -> partition column of its staged table
PARTITION_BY = {
    "sales_weekly": "fy_week_id",
    "forecast_item": "fiscal_year_week",
    "weekly_history": "fiscal_year",
}
# role -> bucket columns of its staged table
BUCKET_BY = {
    "purchase_order": ("po_number", "sku"),
    "packing_list": ("po_number", "sku"),
    "warehouse_receipt": ("po_number", "product_code"),
}
SOURCE_TABLES = ("part", "orders", "lineitem")
# joins and aggregates on more columns than the bucket columns keep the bucket layout
BUCKET_CONF = ("spark.sql.requireAllClusterKeysForCoPartition", "false")


def fingerprint(spark: SparkSession, sf_dir: str) -> str:
    """Hash of the input files and the fixture definitions.

    The files are listed and summed up by Spark (names, sizes and times only; no
    content is read), recursively and on any file system.
    """
    h = hashlib.sha1()
    for name in SOURCE_TABLES:
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                 .load(f"{sf_dir.rstrip('/')}/{name}.parquet"))
        state = files.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")).alias("h")).first()
        if not state.n:
            raise FileNotFoundError(f"nothing to stage: {name}.parquet has no files")
        h.update(f"{name}|{state.n}|{state.h}\n".encode())
    h.update(inspect.getsource(fixtures).encode())
    h.update(inspect.getsource(inspect.getmodule(fingerprint)).encode())
    return h.hexdigest()[:16]


def _published(spark: SparkSession, marker: str) -> dict | None:
    try:
        row = spark.read.text(marker).first()
    except AnalysisException:
        return None
    return json.loads(row[0]) if row else None


def _write_role(df: DataFrame, path: str, part_col: str | None) -> None:
    if part_col is None:
        df.write.mode("overwrite").parquet(path)
        return
    # rows of one week meet, so a folder gets few files; adaptive execution
    # splits a week that is too large for one task
    df.hint("rebalance", part_col).write.mode("overwrite").partitionBy(part_col).parquet(path)


def _table_name(path: str) -> str:
    return f"forecheck_{hashlib.sha1(path.encode()).hexdigest()[:16]}"


def write_bucketed(df: DataFrame, path: str, columns: tuple[str, ...], buckets: int) -> None:
    """One file per bucket, sorted by its columns. The files carry their bucket
    numbers, so ``read_bucketed`` can take them up in any session."""
    (df.repartition(buckets, *columns).write.mode("overwrite")
     .bucketBy(buckets, *columns).sortBy(*columns).option("path", path)
     .saveAsTable(_table_name(path)))


def read_bucketed(spark: SparkSession, path: str, schema: StructType, columns: tuple[str, ...],
                  buckets: int) -> DataFrame:
    """A bucketed folder as a table of the session's catalog, declared if it is not
    known there yet (another application wrote it)."""
    name = _table_name(path)
    if not spark.catalog.tableExists(name):
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        keys = ", ".join(f"`{c}`" for c in columns)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({fields}) USING parquet CLUSTERED BY ({keys}) "
                  f"SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def stage(spark: SparkSession, sf_dir: str, root: str | None = None,
          buckets: int | None = None) -> dict:
    """Write every role table once; return the published stage: its folder (``attempt``)
    and its number of ``buckets`` (default: the session's shuffle partitions; size it
    so that a bucket of the largest order table is about 128 MB).

    ``root`` replaces the default parent folder; stages of other inputs or
    definitions may live in it. A stage that is there is taken as it is.
    """
    key = fingerprint(spark, sf_dir)
    root = f"{root}/{key}" if root else shared_subdir(spark, "forecheck-roles", key)
    marker = f"{root}/_READY"
    found = _published(spark, marker)
    if found:
        return found
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    attempt = f"{root}/attempt-{uuid.uuid4().hex}"
    for role, build in fixtures.builders(spark, sf_dir).items():
        path = f"{attempt}/{role}.parquet"
        if role in BUCKET_BY:
            write_bucketed(build(), path, BUCKET_BY[role], buckets)
        else:
            _write_role(build(), path, PARTITION_BY.get(role))
    found = {"attempt": attempt, "buckets": buckets}
    spark.createDataFrame([(json.dumps(found),)], "value string").coalesce(1).write.mode(
        "overwrite").text(marker)
    return found


def staged_tables(spark: SparkSession, sf_dir: str, root: str | None = None,
                  buckets: int | None = None) -> Tables:
    """Role tables read from the stage (built first if missing).

    Each role is read with the schema and column order of its view, so
    partition columns keep their declared types (week keys stay bigint). Sets the
    session so that joins may use a bucket layout by some of their keys.
    """
    found = stage(spark, sf_dir, root, buckets)
    views = Tables.from_driver_tables(spark, sf_dir)
    spark.conf.set(*BUCKET_CONF)

    def reader(role: str):
        def build() -> DataFrame:
            schema, path = views[role].schema, f"{found['attempt']}/{role}.parquet"
            if role in BUCKET_BY:
                return read_bucketed(spark, path, schema, BUCKET_BY[role], found["buckets"])
            df = spark.read.schema(schema).parquet(path)
            return df.select(*schema.fieldNames())
        return build

    return Tables(spark, {role: reader(role) for role in fixtures.builders(spark, sf_dir)})

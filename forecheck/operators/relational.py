"""Join building blocks shared by the business operators.

* ``Sides``: broadcast a join side only after its rows and bytes were measured.
* ``flag_in``: ``CASE WHEN key IN (set) THEN 1 ELSE 0 END`` as a left join
  against the distinct key set (NULL keys get 0, duplicates in the set are
  ignored, rows are never multiplied).
* ``membership`` and ``flags_in``: the same for several sets over one key, as one table
  of bit masks and one join.
* ``not_in_flag``: ``key NOT IN (set)`` with SQL's NULL rules from a hash join and
  two scalar guards, so it never degrades to a nested-loop join.
* ``spread``: deal a large scan out by its join key over as many tasks as its size needs.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecheck.config import DEFAULT_SIZING, Sizing

# a scan from SPREAD_MIN_BYTES of files on is dealt out by SPREAD_TASK_BYTES to a task
SPREAD_MIN_BYTES = 32 * 1024 * 1024
SPREAD_TASK_BYTES = 4 * 1024 * 1024

_ids = itertools.count()


def _fresh(prefix: str) -> str:
    return f"__{prefix}_{next(_ids)}"


@dataclass(frozen=True)
class Side:
    """A join side and whether its measured size allows a broadcast."""

    df: DataFrame
    fits: bool

    @property
    def frame(self) -> DataFrame:
        return F.broadcast(self.df) if self.fits else self.df

    def keys(self, key: Column | str, name: str = "key") -> Side:
        """Distinct values of ``key`` as a one-column side. They are no more and
        no larger than the rows they come from, so they need no check."""
        k = F.col(key) if isinstance(key, str) else key
        return Side(self.df.select(k.alias(name)).distinct(), self.fits)


class Sides:
    """Measures join sides and remembers what it persisted.

    A candidate side is read up to one row beyond ``sizing.broadcast_max_rows`` (each
    task stops there); that piece is persisted (MEMORY_AND_DISK) and summed up. If it is
    within the rows and ``sizing.broadcast_max_bytes``, it is the whole side: it is hinted
    and the join reads it, so a side is computed once; lost blocks are recomputed
    from lineage. Otherwise the piece is released and the side is returned as it was:
    it is never cached, the join shuffles both sides, and adaptive execution still
    splits skewed partitions.
    """

    def __init__(self, sizing: Sizing = DEFAULT_SIZING):
        self.sizing = sizing
        self.kept: list[DataFrame] = []

    def keep(self, df: DataFrame) -> DataFrame:
        """Persist a frame that several steps read."""
        kept = df.persist(StorageLevel.MEMORY_AND_DISK)
        self.kept.append(kept)
        return kept

    def check(self, df: DataFrame) -> Side:
        piece = df.limit(self.sizing.broadcast_max_rows + 1).persist(StorageLevel.MEMORY_AND_DISK)
        found = piece.agg(F.count(F.lit(1)).alias("n"),
                          F.coalesce(F.sum(_row_bytes(piece)), F.lit(0)).alias("size")).first()
        if found.n <= self.sizing.broadcast_max_rows and found.size <= self.sizing.broadcast_max_bytes:
            self.kept.append(piece)
            return Side(piece, True)
        piece.unpersist()
        return Side(df, False)

    def check_all(self, frames: dict[str, DataFrame]) -> dict[str, Side]:
        """Measure several sides at the same time."""
        with ThreadPoolExecutor(max_workers=max(1, len(frames))) as pool:
            return dict(zip(frames, pool.map(self.check, frames.values())))

    def close(self) -> None:
        """Release everything that was persisted."""
        while self.kept:
            self.kept.pop().unpersist()


def _row_bytes(df: DataFrame) -> Column:
    """Size of a row in memory: 8 bytes and 8 more per column, and what strings hold."""
    texts = [F.coalesce(F.octet_length(c), F.lit(0)) for c, kind in df.dtypes if kind in ("string", "binary")]
    return sum(texts, F.lit(8 + 8 * len(df.columns))).cast("long")


def estimated_bytes(df: DataFrame) -> int:
    """What the optimizer takes a frame's size to be; a scan's is its files' size."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def spread_tasks(scan: DataFrame) -> int | None:
    """Tasks that a scan's files call for: at least the session's shuffle partitions;
    None for a small scan."""
    size = estimated_bytes(scan)
    if size < SPREAD_MIN_BYTES:
        return None
    least = int(scan.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, math.ceil(size / SPREAD_TASK_BYTES))


def spread(scan: DataFrame, *keys: str) -> DataFrame:
    """Deal a scan out by ``keys``; the rows stay the same.

    For steps that widen the rows after their shuffle: adaptive execution sizes a task by
    the compressed bytes that were shuffled, which say little about the rows the task
    then holds. The tasks here follow the size of the scan's files (at least the session's
    shuffle partitions) and are not merged again. A small scan is returned as it is.
    """
    tasks = spread_tasks(scan)
    return scan if tasks is None else scan.repartition(tasks, *keys)


def bounded_broadcast(df: DataFrame) -> DataFrame:
    """Broadcast a side whose size is bounded by construction (e.g. at most one
    row per constant), no check needed."""
    return F.broadcast(df)


def flag_in(df: DataFrame, key: Column, keys: DataFrame, out: str) -> DataFrame:
    """Add ``out`` = 1 when ``key`` is in the one-column frame ``keys``, else 0.

    ``keys`` must be distinct (``Side.keys``); the join then cannot multiply
    rows. A NULL key never matches, which is the 0 of ``CASE WHEN x IN ...``.
    """
    k = _fresh("k")
    hit = _fresh("hit")
    right = keys.select(F.col(keys.columns[0]).alias(k), F.lit(1).alias(hit))
    return (df.join(right, key == F.col(k), "left")
            .withColumn(out, F.coalesce(F.col(hit), F.lit(0)))
            .drop(k, hit))


def membership(sets: dict[str, DataFrame]) -> DataFrame:
    """One row (key, mask) per key of any of the one-column ``sets``: bit k of the mask
    says whether the key is in the k-th set. One aggregate; repeated keys are fine."""
    parts = [keys.select(F.col(keys.columns[0]).alias("key"), F.lit(1 << bit).alias("mask"))
             for bit, keys in enumerate(sets.values())]
    return (reduce(DataFrame.unionByName, parts).where(F.col("key").isNotNull())
            .groupBy("key").agg(F.bit_or("mask").alias("mask")))


def flags_in(df: DataFrame, key: Column, members: DataFrame, names: Iterable[str]) -> DataFrame:
    """Add one 0/1 column per set of ``membership``, in its order: ``key`` is in the set.
    One join that cannot multiply rows; a NULL key is in no set."""
    k, mask = _fresh("k"), _fresh("mask")
    right = members.select(F.col("key").alias(k), F.col("mask").alias(mask))
    bits = F.coalesce(F.col(mask), F.lit(0))
    flags = {n: F.when(bits.bitwiseAND(F.lit(1 << bit)) != 0, F.lit(1)).otherwise(F.lit(0))
             for bit, n in enumerate(names)}
    return df.join(right, key == F.col(k), "left").withColumns(flags).drop(k, mask)


def not_in_flag(key: Column, hit: Column, keys: DataFrame) -> Column:
    """Boolean column for ``key NOT IN (keys)`` given ``hit`` = key matched the
    non-NULL set (from a left join). NULL when SQL would give NULL."""
    name = keys.columns[0]
    facts = keys.agg(F.count(F.lit(1)).alias("n"),
                     F.count(F.col(name)).alias("n_nonnull"))
    n_all = facts.select("n").scalar()
    n_nonnull = facts.select("n_nonnull").scalar()
    return (F.when(n_all == 0, F.lit(True))
            .when(hit, F.lit(False))
            .when(key.isNull() | (n_all != n_nonnull), F.lit(None).cast("boolean"))
            .otherwise(F.lit(True)))

"""Left joins whose right side may hold a hot key.

Adaptive execution splits a skewed partition of a left join on its left side only:
the rows of one key on the right must all meet every left row of that key in one
task. Here the keys that hold a large share of the right side are found first, and
only those are salted, inside one outer join:

* ``key_sketch``: a count-min sketch of the join key as a small table
  (row, cell, n); sketches of parts of a table merge by adding up cells;
* ``heavy_keys``: keys with at least ``share`` of all rows. The sketch never counts
  a key too low, so every heavy key lies in a heavy cell of each sketch row; only
  the rows in such cells are counted by key. There are at most 1 / share heavy keys;
* ``salted_left_join``: a heavy key's right rows are dealt over as many salts as they
  hold shares, and its left rows are repeated once per salt. A heavy key has right
  rows for certain, so a repeated left row that meets none in its salt is dropped
  instead of being kept with NULLs.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecheck.operators.relational import bounded_broadcast

HEAVY_SHARE = 1 / 200
SKETCH_ROWS, SKETCH_CELLS = 4, 2000


def _cell(keys: list[str], row: int) -> Column:
    return F.pmod(F.xxhash64(*keys, F.lit(row)), F.lit(SKETCH_CELLS)).cast("int")


def _complete(keys: list[str]) -> Column:
    """No part of the key is NULL: other rows never match."""
    return reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])


def key_sketch(df: DataFrame, keys: list[str]) -> DataFrame:
    """(row, cell, n): ``SKETCH_ROWS`` x ``SKETCH_CELLS`` counters at most. Each task
    sends its own counters, whatever the number of rows."""
    cells = F.array(*[F.struct(F.lit(r).alias("row"), _cell(keys, r).alias("cell"))
                      for r in range(SKETCH_ROWS)])
    return (df.where(_complete(keys)).select(F.inline(cells))
            .groupBy("row", "cell").agg(F.count(F.lit(1)).alias("n")))


def merge_sketches(*sketches: DataFrame) -> DataFrame:
    """The sketch of all rows together."""
    return (reduce(DataFrame.unionByName, sketches)
            .groupBy("row", "cell").agg(F.sum("n").alias("n")))


@dataclass(frozen=True)
class HeavyKeys:
    """Keys with their number of salts, 1 / share rows at most."""

    table: DataFrame
    keys: list[str]


def heavy_keys(df: DataFrame, keys: list[str], sketch: DataFrame | None = None,
               share: float = HEAVY_SHARE) -> HeavyKeys | None:
    """Keys that hold at least ``share`` of the rows of ``df`` (rows with a NULL key
    apart), or None. ``sketch``: of ``df``, if it is stored; else it is made here."""
    counters = (key_sketch(df, keys) if sketch is None else sketch).collect()
    total = sum(c.n for c in counters if c.row == 0)
    least = max(share * total, 1)
    heavy = {r: [c.cell for c in counters if c.row == r and c.n >= least] for r in range(SKETCH_ROWS)}
    if not total or not all(heavy.values()):
        return None
    inside = reduce(Column.__and__, [_cell(keys, r).isin(cells) for r, cells in heavy.items()])
    salts = F.ceil(F.count(F.lit(1)) / F.lit(float(least))).cast("int")
    found = (df.where(_complete(keys) & inside).groupBy(*keys)
             .agg(F.count(F.lit(1)).alias("n"), salts.alias("salts"))
             .where(F.col("n") >= F.lit(float(least))).drop("n"))
    rows = found.collect()                      # 1 / share rows at most
    if not rows:
        return None
    return HeavyKeys(df.sparkSession.createDataFrame(rows, found.schema), keys)


def salted_left_join(left: DataFrame, right: DataFrame, keys: list[str],
                     heavy: HeavyKeys | None) -> DataFrame:
    """Left join on equal ``keys``; ``heavy`` (of the right side's keys, each of which
    the right side must hold) spreads the rows of those keys over tasks."""
    if heavy is None:
        return left.join(right, keys, "left")
    salts = F.coalesce(F.col("__salts"), F.lit(1))
    marks = bounded_broadcast(heavy.table.withColumnRenamed("salts", "__salts"))
    own = F.xxhash64(*[c for c in right.columns if c not in keys], F.monotonically_increasing_id())
    dealt = (right.join(marks, keys, "left")
             .select(*right.columns, F.pmod(own, salts.cast("long")).cast("int").alias("__salt"),
                     F.lit(True).alias("__hit")))
    repeated = (left.join(marks, keys, "left")
                .withColumn("__salt", F.explode(F.sequence(F.lit(0), salts - 1))))
    # dealt by key and salt here: a layout by the key alone would satisfy the join too
    on = [*keys, "__salt"]
    return (repeated.repartition(*on).join(dealt.repartition(*on), on, "left")
            .where(F.col("__hit") | F.col("__salts").isNull())
            .select(*left.columns, *[c for c in right.columns if c not in keys]))

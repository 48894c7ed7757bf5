"""Hard-negative mining by a vertical scan with branch-and-bound (BOND).

Vectors are quantized to integers and dealt into blocks, anchors into groups; one
cell is a block and a group. Within a cell the block is stored by dimension. For an
anchor the dimensions are read in the order of its largest magnitudes; after every
few of them the part of the score that is still unread is bounded by the block's
minimum and maximum per dimension, and rows that can no longer matter leave the
candidate bitmap. What is left when all dimensions are read has exact scores.

Two scans, with a merge of the cells' results by window rank after each:

* positives: same label; a row leaves when its upper bound is below the lower
  bounds of ``n_positives`` others;
* negatives: other labels, one score window per positive; a row leaves a window when
  its bounds pass the window's ends, or when its upper bound is below the lower
  bounds of ``n_negatives`` rows that are in the window for certain. Rows scan on
  until they have left all windows of the anchor.

Blocks hold at most about ``BLOCK_ROWS`` rows and groups ``GROUP_ANCHORS`` anchors
whatever the input's size; rows are dealt by their position, so a label or a vector
that holds a third of all rows spreads evenly. A cell returns a bounded number of
rows per anchor, never a pair of rows that is no result of the cell.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from forecheck.llm.common import stored, table

BLOCK_ROWS = 65_536
LEAST_BLOCK_ROWS = 1_024                # smaller blocks return nearly all they hold
GROUP_ANCHORS = 4_096
SCAN_STEPS = (8, 16, 32, 40, 48, 56)    # dimensions read before each pruning
SCALE = 256
N_POSITIVES = 5
N_NEGATIVES = 10
WINDOW = (30, 90)                       # per cent of the positive's score


def quantized(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
              label_col: str = "label", scale: int = SCALE) -> DataFrame:
    """(row, id, label, v): rows that take part, components floor(scale * x) as
    integers. Rows with a NULL label or vector, or a NULL or non-finite component,
    take no part. ``row`` numbers the rows, so that repeated ids stay apart."""
    x = F.col("vector")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    return (vectors.select(vectors[id_col].cast("long").alias("id"),
                           vectors[label_col].cast("long").alias("label"),
                           vectors[vector_col].cast("array<double>").alias("vector"))
            .withColumn("row", F.monotonically_increasing_id())
            .where(F.col("label").isNotNull() & x.isNotNull() & finite)
            .select("row", "id", "label",
                    F.transform(x, lambda c: F.floor(c * F.lit(float(scale)))).alias("v")))


# --- inside a cell -----------------------------------------------------------

def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Rows by dimensions; shorter vectors are filled up with zeros."""
    column = column.combine_chunks()
    ends = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    width = int(ends.max(initial=0))
    if len(ends) and (ends == width).all():
        return values.reshape(len(ends), width)
    out = np.zeros((len(ends), width), np.int64)
    out[np.arange(width) < ends[:, None]] = values
    return out


def _same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    return tuple(np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (a, b))


class Block:
    """A block of vectors by dimension, with the range of each dimension."""

    def __init__(self, rows: np.ndarray, anchors: np.ndarray):
        most = max(rows.shape[1], 1)
        for m in (rows, anchors):
            most *= float(np.abs(m.astype(np.float64)).max(initial=0))
        if most >= 2.0 ** 62:
            raise OverflowError("scores of these vectors do not fit 64-bit integers")
        # doubles hold integers below 2^53 exactly and multiply faster
        self.kind = np.float64 if most < 2.0 ** 52 else np.int64
        self.by_dimension = np.ascontiguousarray(rows.T.astype(self.kind))
        self.low = self.by_dimension.min(axis=1) if rows.size else np.zeros(rows.shape[1], self.kind)
        self.high = self.by_dimension.max(axis=1) if rows.size else self.low

    def scan(self, anchor: np.ndarray, bitmap: np.ndarray, prune) -> tuple[np.ndarray, np.ndarray]:
        """Rows left and their exact scores. ``prune(rows, low, high)`` says which
        rows stay, given bounds of their scores."""
        q = anchor.astype(self.kind)
        order = np.argsort(-np.abs(q), kind="stable")
        ends = np.stack((q * self.low, q * self.high))[:, order]
        rest_low = np.append(np.cumsum(ends.min(axis=0)[::-1])[::-1], 0)
        rest_high = np.append(np.cumsum(ends.max(axis=0)[::-1])[::-1], 0)
        rows = np.flatnonzero(bitmap)
        score = np.zeros(len(rows), self.kind)
        done = 0
        for upto in (*(s for s in SCAN_STEPS if s < len(q)), len(q)):
            read = order[done:upto]
            part = self.by_dimension[read]
            if len(rows) < self.by_dimension.shape[1]:
                part = part[:, rows]
            score += q[read] @ part
            done = upto
            stays = prune(rows, score + rest_low[done], score + rest_high[done])
            rows, score = rows[stays], score[stays]
            if not len(rows):
                break
        return rows, score.astype(np.int64)


def _kth_largest(values: np.ndarray, k: int):
    return np.partition(values, len(values) - k)[len(values) - k]


def nearest(block: Block, anchor: np.ndarray, bitmap: np.ndarray, ids: np.ndarray,
            k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best rows of the bitmap (score, then least id) and their scores."""
    def prune(rows, low, high):
        if len(rows) <= k:
            return np.ones(len(rows), bool)
        return high >= _kth_largest(low, k)

    rows, score = block.scan(anchor, bitmap, prune)
    best = np.lexsort((ids[rows], -score))[:k]
    return rows[best], score[best]


def in_windows(block: Block, anchor: np.ndarray, bitmap: np.ndarray, ids: np.ndarray,
               least: np.ndarray, most: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per window [least, most] of scores the k best rows and their scores."""
    def prune(rows, low, high):
        stays = np.zeros(len(rows), bool)
        for a, b in zip(least, most):
            may = (high >= a) & (low <= b)
            sure = low[(low >= a) & (high <= b)]
            if len(sure) >= k:
                # rows that may still end above the window stay until they do
                may &= high >= _kth_largest(sure, k)
            stays |= may
        return stays

    if not (least <= most).any():
        return [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(least)
    rows, score = block.scan(anchor, bitmap, prune)
    out = []
    for a, b in zip(least, most):
        inside = np.flatnonzero((score >= a) & (score <= b))
        best = inside[np.lexsort((ids[rows[inside]], -score[inside]))[:k]]
        out.append((rows[best], score[best]))
    return out


# --- across cells --------------------------------------------------------------

def _dealt(n: int):
    return F.pmod(F.xxhash64("row"), F.lit(n).cast("long"))


def _each(n: int):
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))


class Cells:
    """Vectors dealt into blocks, anchors into groups; every pair of them is a cell."""

    def __init__(self, vectors: DataFrame, anchors: DataFrame):
        spark = vectors.sparkSession
        self.parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        n, n_anchors = vectors.count(), anchors.count()
        # blocks for every task where the rows suffice, more where they would pass BLOCK_ROWS
        self.blocks = max(1, min(self.parts, n // LEAST_BLOCK_ROWS), -(-n // BLOCK_ROWS))
        self.groups = max(1, -(-n_anchors // GROUP_ANCHORS))
        self.vectors = (vectors.withColumn("block", _dealt(self.blocks))
                        .withColumn("group", _each(self.groups)))

    def scan(self, anchors: DataFrame, run, schema: str) -> DataFrame:
        """``run(block table, anchor table)`` on every cell. Both sides are dealt by
        the same number of partitions, which adaptive execution leaves alone: cells
        are small in bytes and long in work."""
        # columns of their own, as both sides come from one table
        anchors = (anchors.select(*(F.col(c).alias(c) for c in anchors.columns))
                   .withColumn("group", _dealt(self.groups))
                   .withColumn("block", _each(self.blocks)))
        n = max(self.parts, min(self.blocks * self.groups, 10 * self.parts))
        sides = [d.repartition(n, "block", "group").groupBy("block", "group")
                 for d in (self.vectors, anchors)]
        return sides[0].cogroup(sides[1]).applyInArrow(run, schema)


def _scan_positives(k: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        if rows.num_rows and anchors.num_rows:
            v, a = _same_width(_matrix(rows["v"]), _matrix(anchors["v"]))
            block = Block(v, a)
            row, ids, label = (rows[c].to_numpy() for c in ("row", "id", "label"))
            order = _id_order(rows["id"])
            for at, me, own in zip(a, anchors["row"].to_pylist(), anchors["label"].to_numpy()):
                best, score = nearest(block, at, (label == own) & (row != me), order, k)
                out[0] += [me] * len(best)
                out[1] += row[best].tolist()
                out[2] += rows["id"].take(best).to_pylist() if len(best) else []
                out[3] += score.tolist()
        return pa.table([pa.array(c, pa.int64()) for c in out],
                        ["anchor_row", "positive_row", "positive_id", "positive_score"])
    return run


def _id_order(ids: pa.ChunkedArray) -> np.ndarray:
    """Places of the ids in ascending order; NULL comes last."""
    filled = ids.combine_chunks().fill_null(2**63 - 1)
    return filled.to_numpy(zero_copy_only=False)


def _scan_negatives(k: int, low: int, high: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        if rows.num_rows and anchors.num_rows:
            v, a = _same_width(_matrix(rows["v"]), _matrix(anchors["v"]))
            block = Block(v, a)
            label, order = rows["label"].to_numpy(), _id_order(rows["id"])
            ids = rows["id"].combine_chunks()
            for at, me, own, scores in zip(a, anchors["row"].to_pylist(), anchors["label"].to_numpy(),
                                           anchors["scores"].to_pylist()):
                # low * p <= 100 * n <= high * p in whole numbers
                least = np.array([-(-low * p // 100) for p in scores], np.int64)
                most = np.array([high * p // 100 for p in scores], np.int64)
                found = in_windows(block, at, label != own, order, least, most, k)
                for p, (best, score) in zip(scores, found):
                    out[0] += [me] * len(best)
                    out[1] += [p] * len(best)
                    out[2] += ids.take(pa.array(best)).to_pylist()
                    out[3] += score.tolist()
        return pa.table([pa.array(c, pa.int64()) for c in out],
                        ["anchor_row", "positive_score", "negative_id", "negative_score"])
    return run


def mine(vectors: DataFrame, is_anchor, id_col: str = "vec_id", vector_col: str = "embedding",
         label_col: str = "label", n_positives: int = N_POSITIVES, n_negatives: int = N_NEGATIVES,
         window: tuple[int, int] = WINDOW, scale: int = SCALE) -> DataFrame:
    """Hard negatives of every anchor: rows of another label whose score lies between
    ``window`` per cent of a positive's score; the ``n_negatives`` highest for each of
    the anchor's ``n_positives`` nearest rows of its label. ``is_anchor`` is a
    condition on the columns ``id`` and ``label``. Call ``common.ship`` first where
    this package is not installed on the executors.

    Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score;
    a positive without negatives in its window gives no row.

    Scores are integer inner products of components floor(scale * x); higher first,
    ties by the smaller id, NULL ids last. Vectors of unequal length are filled up
    with zeros; scores beyond 64 bits are an error. Rows with a NULL label or vector or
    a NULL or non-finite component take no part. Repeated rows (and ids) are rows of
    their own: an anchor's copy is another row and can be its positive. No anchors or
    an empty table give no rows; other columns are not read.
    """
    # written once: the row numbers must not change between the scans
    rows = stored(quantized(vectors, id_col, vector_col, label_col, scale), "vectors")
    anchors = rows.where(is_anchor)
    cells = Cells(rows, anchors)

    def best(df: DataFrame, keys: list[str], score: str, tie: str, k: int) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(F.desc(score), F.asc_nulls_last(tie))
        return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)

    positives = stored(best(
        cells.scan(anchors, _scan_positives(n_positives),
                   "anchor_row long, positive_row long, positive_id long, positive_score long"),
        ["anchor_row"], "positive_score", "positive_id", n_positives), "positives")
    # equal scores of an anchor share one window
    windows = (positives.groupBy("anchor_row")
               .agg(F.sort_array(F.collect_set("positive_score")).alias("scores")))
    with_windows = anchors.join(windows, anchors["row"] == windows["anchor_row"]).drop("anchor_row")
    negatives = best(
        cells.scan(with_windows, _scan_negatives(n_negatives, *window),
                   "anchor_row long, positive_score long, negative_id long, negative_score long"),
        ["anchor_row", "positive_score"], "negative_score", "negative_id", n_negatives)
    named = anchors.select(F.col("row").alias("anchor_row"), F.col("id").alias("anchor_id"))
    return (negatives.join(positives.drop("rank"), ["anchor_row", "positive_score"])
            .join(named, "anchor_row")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                    "negative_score"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every vector whose vec_id is divisible by 100, after the
    label of every vec_id divisible by 7 has become (label + 1) % 10."""
    vectors = table(spark, sf_dir, "embeddings")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(vectors.withColumn("label", shifted), F.col("id") % 100 == 0)

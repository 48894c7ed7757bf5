"""Helpers shared by the operators: tables, the shared folder, text as numpy."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from forecheck.session import shared_subdir

# ASCII white space of the word rule: space and 0x09-0x0D
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_GOLD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


# rows of an Arrow batch: texts are long, and a batch is held by both the JVM and
# the Python worker
BATCH_ROWS = 1000


def ship(spark: SparkSession) -> None:
    """Prepare a session: small Arrow batches, and this package's code sent to the
    Python workers, once per Spark context.

    The code is needed where it is not installed on the executors; Spark's own
    file server distributes it (some 100 kB).
    """
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, str(BATCH_ROWS))
    sc = spark.sparkContext
    if getattr(sc, "_forecheck_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    path = os.path.join(tempfile.mkdtemp(prefix="forecheck-code-"), "forecheck_code.zip")
    with open(path, "wb") as f:
        f.write(buffer.getvalue())
    sc.addPyFile(path)
    sc._forecheck_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder."""
    return shared_subdir(spark, "llm", f"{name}-{uuid.uuid4().hex}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage: a lost executor costs only the tasks it was running.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# --- text as numpy ---------------------------------------------------------

def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64, len(column) + 1, column.offset * 8)
    data = (np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None
            else np.zeros(0, np.uint8))
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``limit`` bytes (one row at least), to keep the
    numpy temporaries of a batch small whatever the batch holds."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def sliced(column: pa.Array, limit: int = 1 << 20):
    """(lo, hi, bytes, offsets) of each slice of a string column."""
    data, offsets = utf8(column)
    for lo, hi in slices(offsets, limit):
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``rows`` rows, where rows become Python objects."""
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every bit of a 64-bit value (splitmix64)."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


class RangeHash:
    """64-bit polynomial hashes of byte ranges of one buffer, from prefix sums.

    ``seed`` picks the value of each byte; the powers are shared by all seeds.
    """

    _base = _GOLD * 5 & _MASK | 5
    _power = _inverse = np.zeros(0, np.uint64)

    def __init__(self, data: np.ndarray, seed: int = 0):
        if len(self._power) <= len(data):
            size = max(len(data) + 1, 1 << 20)
            power = np.full(size, self._base, np.uint64)
            inverse = np.full(size, pow(self._base, -1, 1 << 64), np.uint64)
            power[0] = inverse[0] = 1
            RangeHash._power, RangeHash._inverse = np.cumprod(power), np.cumprod(inverse)
        value = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_GOLD) + np.uint64(seed))
        terms = value[data]
        terms *= self._power[:len(data)]
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(terms, out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self._inverse[start])


def word_spans(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE):
    """(start, end, row) of each word; words never cross rows."""
    if not len(data):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    inside = ~space[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | first[1:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | first[1:-1]
    starts = np.flatnonzero(start)
    ends = np.flatnonzero(end) + 1
    rows = np.searchsorted(offsets, starts, side="right") - 1
    return starts, ends, rows


def spread(flags_at: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Boolean cover of ``n`` cells by the spans [at, at + length)."""
    delta = np.zeros(n + 1, np.int64)
    np.add.at(delta, flags_at, 1)
    np.add.at(delta, np.minimum(flags_at + lengths, n), -1)
    return np.cumsum(delta[:n]) > 0

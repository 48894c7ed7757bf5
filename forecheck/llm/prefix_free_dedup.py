"""Exact removal of repeated 100-byte strings by prefix-free parsing.

Every byte covered by a 100-byte string that also starts earlier (smaller id, or
the same text at an earlier start) is removed. The corpus is never sorted as a
whole; it is parsed into phrases, and suffix order is only worked out where
phrases repeat with different neighbours.

* Parse. A rolling hash over ``GRAM`` bytes gives each 100-byte string a trigger:
  the position inside it with the least hash (the last of equal ones). The choice
  depends on the string alone, so equal strings have equal triggers. The strings
  of one trigger start in a short run; the bytes they span are its phrase.
  Grams that are frequent in the whole corpus (a bounded list from a count over
  hash cells) come last in the order, so boilerplate does not attract triggers.
* Dictionary. Phrases go to a partition by their trigger gram, as packed arrays
  of 26 bytes a phrase. Equal phrases beyond the first are repeats as a whole.
  First phrases whose trigger gram also occurs in other phrases may still share
  part of their strings; all others are done.
* Suffix order. Only those phrases come back with their bytes. The part left of
  the trigger is a dictionary phrase, whose suffixes are ordered by sorting the
  reversed phrases with their longest common prefixes (LCP); the part right of it
  stands for the suffix of the parse and is sorted with its LCP. A string is a
  phrase suffix and a parse prefix, so for each suffix length the two orders
  combine into classes of equal strings: runs where both LCPs are long enough.
  All members but the first of a class are repeats.

Texts are shuffled zstandard-compressed, by id, so neither a hot source nor a
large group of copies meets in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecheck.llm.common import RangeHash, mix, pieces, sliced, stored, table

LENGTH = 100            # bytes of the strings compared
GRAM = 24               # bytes of the rolling hash
REACH = LENGTH - GRAM + 1       # trigger positions inside a string
CELLS = 1 << 20         # hash cells of the count of frequent grams
FREQUENT = 1 << 15      # a cell is frequent from this share of all positions on (1 / FREQUENT)
SLICE_BYTES = 1 << 20

_PHRASES = ["gram", "phrase", "id", "tag", "trigger", "left", "more"]
_TYPES = [np.uint64, np.uint64, np.int64, np.int64, np.uint32, np.uint8, np.uint8]


def gram_hashes(data: np.ndarray) -> np.ndarray:
    at = np.arange(max(0, len(data) - GRAM + 1))
    return RangeHash(data, seed=3)(at, at + GRAM)


def _last_least(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the least value of each window, the last of equal ones."""
    # the position is packed into the low bits, larger first, so one minimum does
    n = len(values)
    low = np.uint64((1 << 24) - 1)
    packed = (values & ~low) | (low - np.arange(n, dtype=np.uint64))
    size, best = 1, packed
    while size * 2 <= width:
        best = np.minimum(best[:-size], best[size:])
        size *= 2
    if size < width:
        best = np.minimum(best[:len(best) - (width - size)], best[width - size:])
    return (low - (best & low)).astype(np.int64)


def phrases(data: np.ndarray, offsets: np.ndarray, frequent: np.ndarray):
    """Phrases of the texts of a slice (under 16 MB, or a single text):
    (row, first string, last string, trigger), and the gram hashes."""
    grams = gram_hashes(data)
    order = mix(grams + np.uint64(11)) >> np.uint64(1)
    order |= frequent[(grams & np.uint64(CELLS - 1)).astype(np.int64)].astype(np.uint64) << np.uint64(63)
    sizes = np.diff(offsets)
    starts = np.maximum(sizes - LENGTH + 1, 0)
    out = []
    step = (1 << 24) - 2 * LENGTH
    for lo in range(0, max(1, len(order)), step):
        part = order[lo:lo + step + REACH - 1]
        if len(part) >= REACH:
            out.append(_last_least(part, REACH) + lo)
    trigger = np.concatenate(out) if out else np.zeros(0, np.int64)
    # strings that stay inside their text
    row = np.repeat(np.arange(len(sizes)), starts)
    at = np.arange(starts.sum()) - np.repeat(np.cumsum(starts) - starts, starts) + offsets[:-1][row]
    trigger = trigger[at]
    if not len(at):
        return row, at, at, trigger, grams
    new = np.ones(len(at), bool)
    new[1:] = (trigger[1:] != trigger[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:], [len(at)])) - 1
    return row[first], at[first], at[last], trigger[first], grams


def _lowest():
    """The id that NULL stands for."""
    return F.lit(str(-2**63)).cast("long")


def _tagged(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, tag, text): rows of one id are told apart by a hash of their text."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    return docs.select(F.coalesce(docs[id_col].cast("long"), _lowest()).alias("id"),
                       F.xxhash64(text).alias("tag"), text.alias("text"))


def frequent_cells(texts: DataFrame) -> np.ndarray:
    """Which hash cells hold at least 1 / ``FREQUENT`` of all gram positions.

    Each slice reports its cells above that share, so no frequent cell can be
    missed, and at most ``FREQUENT`` numbers a slice and in all are sent on.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, _ in sliced(batch.column(0), SLICE_BYTES):
                cells = np.bincount((gram_hashes(data) & np.uint64(CELLS - 1)).astype(np.int64),
                                    minlength=CELLS)
                total = int(cells.sum())
                heavy = np.flatnonzero((cells * FREQUENT >= total) & (cells > 0)
                                       & (cells >= total // FREQUENT + 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.append(heavy, -1)), pa.array(np.append(cells[heavy], total))],
                    ["cell", "n"])

    sums = texts.select("text").mapInArrow(run, "cell long, n long").groupBy("cell").agg(
        F.sum("n").alias("n"))
    total = F.max(F.when(F.col("cell") == -1, F.col("n")))
    sums = sums.join(F.broadcast(sums.agg(total.alias("total"))),
                     (F.col("cell") >= 0) & (F.col("n") * FREQUENT >= F.col("total")))
    found = np.zeros(CELLS, bool)
    found[[r.cell for r in sums.select("cell").collect()]] = True
    return found


def _packed_phrases(texts: DataFrame, frequent: np.ndarray, buckets: int) -> DataFrame:
    """One row per slice and bucket: the slice's phrases as packed arrays."""
    cells = np.packbits(frequent).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = np.unpackbits(np.frombuffer(cells, np.uint8)).astype(bool)
        for batch in batches:
            ids = batch.column("id").to_numpy()
            tags = batch.column("tag").to_numpy()
            for lo, _, data, offsets in sliced(batch.column("text"), SLICE_BYTES):
                row, first, last, trigger, grams = phrases(data, offsets, marked)
                if not len(row):
                    continue
                whole = mix(RangeHash(data, seed=5)(first, last + LENGTH)
                            + (trigger - first).astype(np.uint64))
                gram = grams[trigger]
                bucket = (mix(gram + np.uint64(77)) % np.uint64(buckets)).astype(np.int32)
                # of equal phrases of the slice's texts all are sent: each needs its mark
                order = np.argsort(bucket, kind="stable")
                columns = [c[order].astype(t) for c, t in zip(
                    (gram, whole, ids[lo + row], tags[lo + row], trigger - offsets[row],
                     trigger - first, last - first), _TYPES)]
                cut = np.flatnonzero(np.diff(bucket[order], prepend=-1))
                ends = [*cut[1:].tolist(), len(order)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[order][cut]),
                     *(pa.array([c[a:b].tobytes() for a, b in zip(cut.tolist(), ends)], pa.binary())
                       for c in columns)], ["bucket", *_PHRASES])

    return texts.mapInArrow(run, "bucket int, " + ", ".join(f"{n} binary" for n in _PHRASES))


def _marks(packed: DataFrame, buckets: int) -> DataFrame:
    """(id, tag, open, begin, end, trigger): repeated phrases as byte spans
    (``open`` false), and phrases whose strings have to be ordered (true)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[list[bytes]] = [[] for _ in _PHRASES]
        for batch in batches:
            for k, name in enumerate(_PHRASES):
                parts[k] += batch.column(name).to_pylist()
        gram, whole, ids, tags, trigger, left, more = (
            np.frombuffer(b"".join(p), t) for p, t in zip(parts, _TYPES))
        if not len(gram):
            return
        del parts
        order = np.lexsort((trigger, tags, ids, whole, gram))
        g, w = gram[order], whole[order]
        new_gram = np.ones(len(g), bool)
        new_gram[1:] = g[1:] != g[:-1]
        new = new_gram.copy()
        new[1:] |= w[1:] != w[:-1]
        group = np.cumsum(new_gram) - 1
        several = np.bincount(group, new)[group] > 1
        # rows that stand twice in the table are equal in everything: one phrase
        i, t, p = ids[order], tags[order], trigger[order]
        same_row = np.zeros(len(g), bool)
        same_row[1:] = ~new[1:] & (i[1:] == i[:-1]) & (t[1:] == t[:-1]) & (p[1:] == p[:-1])
        head = np.maximum.accumulate(np.where(new, np.arange(len(g)), 0))
        is_first = (i == i[head]) & (t == t[head]) & (p == p[head])
        for kind in (False, True):
            take = np.flatnonzero((new & several if kind else ~is_first) & ~same_row)
            at = order[take]
            begin = trigger[at].astype(np.int64) - left[at]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[at]), pa.array(tags[at]), pa.array(np.full(len(at), kind)),
                 pa.array(begin.astype(np.int32)),
                 pa.array((begin + more[at] + LENGTH).astype(np.int32)),
                 pa.array(trigger[at].astype(np.int32))],
                ["id", "tag", "open", "begin", "end", "trigger"])

    return packed.repartition(buckets, "bucket").mapInArrow(
        run, "id long, tag long, open boolean, begin int, end int, trigger int")


def _zipped(texts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in pieces(batches):
            zipped = [pack(t.encode()) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in batch.schema.names if n != "text"),
                 pa.array(zipped, pa.binary())],
                [*(n for n in batch.schema.names if n != "text"), "zipped"])

    kept = [f"{f.name} {f.dataType.simpleString()}" for f in texts.schema if f.name != "text"]
    return texts.mapInArrow(run, ", ".join([*kept, "zipped binary"]))


def _open_contexts(texts: DataFrame, marks: DataFrame, buckets: int) -> DataFrame:
    """The bytes of the open phrases, packed per bucket of their trigger gram."""
    wanted = (marks.where("open").groupBy("id", "tag")
              .agg(F.collect_list(F.struct("begin", "end", "trigger")).alias("spans")))
    one = _zipped(texts).join(wanted, ["id", "tag"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in pieces(batches):
            rows, where = [], []
            for doc, tag, zipped, spans in zip(*(batch.column(n).to_pylist() for n in
                                                 ("id", "tag", "zipped", "spans"))):
                raw = unpack(zipped)
                for s in spans:
                    b, e, t = s["begin"], s["end"], s["trigger"]
                    rows.append((doc, tag, b, t - b, raw[b:e]))
                    where.append(raw[t:t + GRAM])
            if not rows:
                continue
            bucket = np.array([int.from_bytes(hashlib.blake2b(g, digest_size=4).digest(), "big")
                               for g in where]) % buckets
            order = np.argsort(bucket, kind="stable")
            columns = list(zip(*rows))
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[order].astype(np.int32)),
                 *(pa.array(c, t).take(pa.array(order)) for c, t in zip(columns, types))],
                ["bucket", "id", "tag", "begin", "left", "content"])

    # one row per phrase; texts that occur twice in the table send equal rows
    return one.mapInArrow(run, "bucket int, id long, tag long, begin int, left int, content binary")


def _fixed(rows: list[bytes], width: int) -> np.ndarray:
    """Byte rows padded with zeros to one width."""
    return np.frombuffer(b"".join(r.ljust(width, b"\0") for r in rows), np.uint8).reshape(-1, width)


def _sorted_with_lcp(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows and the LCP of each with the one before it."""
    width = matrix.shape[1]
    order = np.argsort(np.ascontiguousarray(matrix).view(f"S{width}").ravel(), kind="stable")
    lcp = np.zeros(len(order), np.int64)
    for lo in range(1, len(order), 50_000):
        a = matrix[order[lo:lo + 50_000]]
        b = matrix[order[lo - 1:lo - 1 + len(a)]]
        differ = a != b
        lcp[lo:lo + len(a)] = np.where(differ.any(1), differ.argmax(1), width)
    return order, lcp


def repeated_strings(left: list[bytes], right: list[bytes]) -> list[np.ndarray]:
    """For phrases in corpus order, cut at their triggers: the lengths of the left
    suffixes whose string ``suffix + right[:LENGTH - len(suffix)]`` occurs in an
    earlier phrase."""
    n = len(left)
    sizes = np.array([len(x) for x in left])
    fewest = LENGTH - np.array([len(x) for x in right])      # shortest suffix in use
    # suffixes of dictionary phrases: reversed phrases in sorted order
    by_left, lcp_left = _sorted_with_lcp(_fixed([x[::-1] for x in left], REACH))
    by_right, lcp_right = _sorted_with_lcp(_fixed(right, LENGTH))
    found: list[list[int]] = [[] for _ in range(n)]
    class_left, class_right = np.empty(n, np.int64), np.empty(n, np.int64)
    for length in range(int(fewest.min()), int(sizes.max()) + 1):
        used = np.flatnonzero((sizes >= length) & (fewest <= length))
        if len(used) < 2:
            continue
        class_left[by_left] = np.cumsum(lcp_left < length)
        class_right[by_right] = np.cumsum(lcp_right < LENGTH - length)
        _, first, which = np.unique(class_left[used] * (n + 1) + class_right[used],
                                    return_index=True, return_inverse=True)
        for k in used[first[which] != np.arange(len(used))].tolist():
            found[k].append(length)
    return [np.array(x, np.int64) for x in found]


def _ordered(contexts: DataFrame, buckets: int) -> DataFrame:
    """(id, tag, begin, end): byte spans of repeated strings of open phrases."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: set[tuple] = set()
        for batch in batches:
            rows.update(zip(*(batch.column(n).to_pylist()
                              for n in ("id", "tag", "begin", "left", "content"))))
        if not rows:
            return
        ordered = sorted(rows, key=lambda r: (r[0], r[1], r[2] + r[3]))
        del rows
        lengths = repeated_strings([r[4][:r[3]] for r in ordered], [r[4][r[3]:] for r in ordered])
        out = []
        for (doc, tag, begin, left, _), found in zip(ordered, lengths):
            if len(found):
                starts = (begin + left - found)[::-1]
                runs = np.flatnonzero(np.diff(starts, prepend=-2) != 1)
                for a, b in zip(runs.tolist(), [*runs[1:].tolist(), len(starts)]):
                    out.append((doc, tag, int(starts[a]), int(starts[b - 1]) + LENGTH))
        if out:
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                             ["id", "tag", "begin", "end"])

    return contexts.repartition(buckets, "bucket").mapInArrow(
        run, "id long, tag long, begin int, end int")


def removed_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, tag, begin, end) of all removed byte spans; spans may overlap."""
    texts = _tagged(docs, id_col, text_col)
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    marks = stored(_marks(_packed_phrases(texts, frequent_cells(texts), buckets), buckets), "phrases")
    rest = _ordered(_open_contexts(texts, marks, buckets), buckets)
    return marks.where("not open").select("id", "tag", "begin", "end").unionByName(rest)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          out: str = "dedup") -> DataFrame:
    """One row per input row: all its columns, with ``text_col`` replaced by what
    is left, and ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs) and
    ``kept_sha256`` (of the remaining bytes) as one struct column ``out``.

    The text that is left drops the remains of a character that a span has cut;
    ``kept_sha256`` is of the exact bytes. NULL text counts as empty (and stays
    empty), NULL ids as the smallest. Ids are integers. Rows with one id are
    ordered by a hash of their text; of rows equal in id and text the first is
    judged as if it stood alone, the others are removed from byte 0 on if they
    have 100 bytes. Any other columns are carried along.
    """
    spans = (removed_spans(docs, id_col, text_col).groupBy("id", "tag")
             .agg(F.collect_list(F.struct("begin", "end")).alias("spans")))
    others = [c for c in docs.columns if c not in (text_col,)]
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    base = docs.select(F.coalesce(docs[id_col].cast("long"), _lowest()).alias("id"),
                       F.xxhash64(text).alias("tag"), text.alias("text"),
                       F.struct(*(docs[c].alias(f"c{k}") for k, c in enumerate(others))).alias("rest"))
    joined = _zipped(base).join(spans, ["id", "tag"], "left").withColumn("copy", F.row_number().over(
        _by_row())).select("zipped", "rest", "spans", "copy")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in pieces(batches):
            out = []
            for zipped, found, copy in zip(*(batch.column(n).to_pylist()
                                             for n in ("zipped", "spans", "copy"))):
                raw = unpack(zipped)
                parts, at, runs, removed = [], 0, 0, 0
                if copy > 1 and len(raw) >= LENGTH:
                    found = [{"begin": 0, "end": len(raw)}]
                for b, e in sorted((s["begin"], s["end"]) for s in found or ()):
                    if b > at or not runs:
                        parts.append(raw[at:b])
                        runs += 1
                        removed += e - b
                        at = e
                    elif e > at:
                        removed += e - at
                        at = e
                parts.append(raw[at:])
                kept = b"".join(parts)
                whole = "".join(p.decode(errors="ignore") for p in parts)
                out.append((whole, len(raw), removed, runs, hashlib.sha256(kept).hexdigest()))
            types = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            columns = [pa.array(c, t) for c, t in zip(zip(*out), types)] if out else [
                pa.array([], t) for t in types]
            yield pa.RecordBatch.from_arrays([batch.column("rest"), *columns], [
                "rest", "text", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    rest_type = base.schema["rest"].dataType.simpleString()
    done = joined.mapInArrow(run, f"rest {rest_type}, text string, n_bytes long, n_removed long, "
                                  "n_spans long, kept_sha256 string")
    figures = F.struct("n_bytes", "n_removed", "n_spans", "kept_sha256").alias(out)
    return done.select(*(F.col("text").alias(c) if c == text_col else
                         F.col(f"rest.c{others.index(c)}").alias(c) for c in docs.columns), figures)


def _by_row():
    from pyspark.sql import Window

    return Window.partitionBy("id", "tag").orderBy("id", "tag")


def op3_prefix_free_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts of ``documents``."""
    done = dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "dedup.*")

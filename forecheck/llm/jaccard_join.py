"""Near-duplicate self-join on five-word shingles: all pairs with a Jaccard
similarity of 0.8 or more, by MinHash buckets and Bayesian candidate pruning.

1. Every text becomes its set of shingles (64-bit hashes), a 64-value MinHash
   signature and a 128-bit hash of the set. Equal sets form a class; only one
   member of a class takes part in what follows.
2. 21 bands of three MinHash values give buckets. A pair at the threshold shares
   none of them with probability 6e-7. Buckets with the same members
   are kept once.
3. A kept bucket is worked on in blocks of bounded size, one task per pair of
   blocks, so a group of any size is spread over many tasks and no pair is ever
   written out. A pair is looked at in the first kept bucket that both share.
4. In a block, signatures are compared 16 values at a time. After n values with
   m equal ones the posterior probability of a similarity of at least 0.8 under a
   uniform prior is P(Binomial(n + 1, 0.8) <= m); pairs below ``TOLERANCE`` are
   dropped, the rest are verified exactly on the shingle sets.
5. Each block returns, per class, its number of links and a root of its linked
   block members: a spanning forest. Links are summed per class, groups are the
   connected components of the forests (large-star and small-star rounds).

Words are runs of anything but ASCII white space. A text of fewer than five
words, but not none, is one shingle; texts without words have no links.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecheck.llm.common import RangeHash, mix, sliced, stored, table, word_spans

SHINGLE = 5
THRESHOLD = 0.8
ROWS, BANDS = 3, 21
HASHES = 64                     # 63 of them make the bands
CHUNK = 16                      # MinHash values compared at a time
TOLERANCE = 1e-7                # posterior probability below which a pair is dropped
BLOCK_TEXTS = 2_000             # classes of a block, about
BLOCK_SHINGLES = 2_000_000      # shingles of a block, about

_RNG = np.random.default_rng(20_077)
_MULTIPLY = _RNG.integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(0, 2**63, HASHES, dtype=np.uint64)


def least_equal(threshold: float, tolerance: float) -> dict[int, int]:
    """Fewest equal values after n compared ones for which a pair stays."""
    out = {}
    for n in range(CHUNK, HASHES + 1, CHUNK):
        total, m = 0.0, -1
        while total < tolerance:
            m += 1
            total += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out[n] = m
    return out


# --- sketches --------------------------------------------------------------

def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every distinct shingle, ordered by row and hash."""
    starts, ends, rows = word_spans(data, offsets)
    n_rows = len(offsets) - 1
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    words = RangeHash(data)(starts, ends)
    counts = np.bincount(rows, minlength=n_rows)
    firsts = np.cumsum(counts) - counts
    n = np.maximum(counts - SHINGLE + 1, np.minimum(counts, 1))      # shingles of a row
    row = np.repeat(np.arange(n_rows), n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(firsts, n)
    size = np.minimum(counts, SHINGLE)[row]
    value = size.astype(np.uint64)
    for k in range(SHINGLE):
        has = size > k
        word = np.where(has, words[np.minimum(at + k, len(words) - 1)], np.uint64(0))
        value = mix(value * np.uint64(0x9E3779B97F4A7C15) + word)
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[new], value[new]


def set_keys(row: np.ndarray, value: np.ndarray, n_rows: int):
    """Per row: number of shingles and a 128-bit hash of the set."""
    counts = np.bincount(row, minlength=n_rows)
    keys = np.zeros((n_rows, 2), np.uint64)
    full = np.flatnonzero(counts)
    if len(full):
        at = np.cumsum(counts)[full] - counts[full]
        keys[full, 0] = np.add.reduceat(mix(value), at)
        keys[full, 1] = np.bitwise_xor.reduceat(mix(value + np.uint64(0x51ED27)), at)
    return counts, keys


def signatures(counts: np.ndarray, value: np.ndarray) -> np.ndarray:
    """(rows, HASHES) MinHash values."""
    out = np.full((len(counts), HASHES), 2**32 - 1, np.uint32)
    full = np.flatnonzero(counts)
    if len(full):
        at = np.cumsum(counts)[full] - counts[full]
        for k in range(HASHES):
            h = value * _MULTIPLY[k]
            h += _ADD[k]
            h >>= np.uint64(32)
            out[full, k] = np.minimum.reduceat(h, at)
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """(rows, BANDS) hashes of the bands; the band's number is part of them."""
    part = signature[:, :ROWS * BANDS].reshape(len(signature), BANDS, ROWS).astype(np.uint64)
    out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), part.shape[:2]).copy()
    for k in range(ROWS):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + part[:, :, k])
    return out


def _binary(rows: np.ndarray) -> pa.Array:
    """A row of bytes per row of a contiguous array."""
    return pa.array([r.tobytes() for r in rows], pa.binary())


def _sketches(docs: DataFrame) -> DataFrame:
    """(id, tag, key, n, sig) of every row of (id, tag, text)."""
    id_type = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in sliced(batch.column("text")):
                row, value = shingles(data, offsets)
                counts, keys = set_keys(row, value, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(lo, hi - lo), batch.column("tag").slice(lo, hi - lo),
                     _binary(keys), pa.array(counts), _binary(signatures(counts, value))],
                    ["id", "tag", "key", "n", "sig"])

    return docs.mapInArrow(run, f"id {id_type}, tag long, key binary, n long, sig binary")


def _bands(classes: DataFrame) -> DataFrame:
    """(bucket, band, key, n) for every class and band."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint32)
            keys = band_keys(sig.reshape(-1, HASHES))
            which = np.repeat(np.arange(batch.num_rows), BANDS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel().view(np.int64)),
                 pa.array(np.tile(np.arange(BANDS, dtype=np.int32), batch.num_rows)),
                 batch.column("key").take(pa.array(which)), batch.column("n").take(pa.array(which))],
                ["bucket", "band", "key", "n"])

    return classes.select("key", "n", "sig").mapInArrow(
        run, "bucket long, band int, key binary, n long")


# --- blocks ----------------------------------------------------------------

class _Members:
    """Classes of one block, as arrays."""

    def __init__(self, rows: list[dict]):
        self.keys = [r["key"] for r in rows]
        self.copies = np.array([r["copies"] for r in rows], np.int64)
        self.sig = np.frombuffer(b"".join(r["sig"] for r in rows), np.uint32).reshape(-1, HASHES)
        self.bands = band_keys(self.sig)
        self.kept = np.array([r["kept"] for r in rows], np.int64)
        self.sets = [np.frombuffer(r["shingles"], np.uint64) for r in rows]
        self.n = np.array([len(s) for s in self.sets], np.int64)


def _candidates(a: _Members, b: _Members, band: int, same: bool, least: dict[int, int],
                threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a piece of ``a`` and all of ``b`` that this bucket owns and that
    Bayesian pruning leaves."""
    step = max(1, 1_000_000 // max(1, len(b.n)))
    for lo in range(0, len(a.n), step):
        part = slice(lo, lo + step)
        small = np.minimum(a.n[part, None], b.n[None, :])
        ok = small >= threshold * np.maximum(a.n[part, None], b.n[None, :]) - 1e-9
        if same:
            ok &= np.arange(len(a.n))[part, None] < np.arange(len(b.n))[None, :]
        for earlier in range(band):
            kept = (a.kept[part] >> earlier & 1).astype(bool)
            if kept.any():
                ok &= ~((a.bands[part, None, earlier] == b.bands[None, :, earlier]) & kept[:, None])
        i, j = np.nonzero(ok)
        i += lo
        equal = np.zeros(len(i), np.int64)
        for n, least_n in least.items():
            cut = slice(n - CHUNK, n)
            equal += (a.sig[i, cut] == b.sig[j, cut]).sum(1)
            stay = equal >= least_n
            i, j, equal = i[stay], j[stay], equal[stay]
        yield i, j


def _verified(a: _Members, b: _Members, i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs reach the threshold, from the shingle sets."""
    common = np.zeros(len(i), np.int64)
    if len(i) <= 16:
        for k in range(len(i)):
            common[k] = len(np.intersect1d(a.sets[i[k]], b.sets[j[k]], assume_unique=True))
    else:
        every = np.concatenate(b.sets)
        names, dense = np.unique(every, return_inverse=True)
        ends = np.concatenate(([0], np.cumsum(b.n)))
        marked = np.zeros(len(names) + 1, bool)
        cuts = np.flatnonzero(np.diff(i, prepend=-1))
        for lo, hi in zip(cuts, [*cuts[1:], len(i)]):
            own = a.sets[i[lo]]
            at = np.searchsorted(names, own)
            at = at[(at < len(names)) & (names[np.minimum(at, len(names) - 1)] == own)]
            marked[at] = True
            partners = j[lo:hi]
            if 4 * len(partners) > len(b.n):
                sums = np.concatenate(([0], np.cumsum(marked[dense])))
                common[lo:hi] = sums[ends[partners + 1]] - sums[ends[partners]]
            else:
                common[lo:hi] = [np.count_nonzero(marked[dense[ends[p]:ends[p + 1]]])
                                 for p in partners.tolist()]
            marked[at] = False
    return common >= threshold * (a.n[i] + b.n[j] - common) - 1e-9


def _block_links(rows: list[dict], threshold: float, least: dict[int, int]) -> list[tuple]:
    """(key, links, root) of every class of the block pair that has a link."""
    first = rows[0]
    # a class arrives more than once when its first row is repeated in the table
    sides = [{r["key"]: r for r in rows if r["block"] == x} for x in {first["lo"], first["hi"]}]
    same = first["lo"] == first["hi"]
    members = [_Members(list(s.values())) for s in sides if s]
    if (len(members) < 2 and not same) or (same and len(members[0].n) < 2):
        return []
    a, b = members[0], members[0] if same else members[1]
    offset = 0 if same else len(a.n)
    links = np.zeros(offset + len(b.n), np.int64)
    root = np.arange(len(links))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, j in _candidates(a, b, first["band"], same, least, threshold):
        good = _verified(a, b, i, j, threshold)
        i, j = i[good], j[good]
        np.add.at(links, i, b.copies[j])
        np.add.at(links, j + offset, a.copies[i])
        for x, y in zip(i.tolist(), (j + offset).tolist()):
            x, y = find(x), find(y)
            if x != y:
                root[max(x, y)] = min(x, y)
    keys = a.keys if same else a.keys + b.keys
    return [(keys[x], int(links[x]), keys[find(x)]) for x in np.flatnonzero(links).tolist()]


def _joined_blocks(payload: DataFrame, threshold: float) -> DataFrame:
    """(key, links, root) rows of all block pairs."""
    least = least_equal(threshold, TOLERANCE)
    names = ["bucket", "band", "lo", "hi", "block", "key", "copies", "sig", "kept", "shingles"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[dict] = []
        out: list[tuple] = []
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in names]
            for values in zip(*columns):
                if group and values[:4] != tuple(group[0][n] for n in names[:4]):
                    out += _block_links(group, threshold, least)
                    group = []
                group.append(dict(zip(names, values)))
            if len(out) > 10_000:
                yield _rows(out)
                out = []
        if group:
            out += _block_links(group, threshold, least)
        if out:
            yield _rows(out)

    def _rows(out: list[tuple]) -> pa.RecordBatch:
        types = (pa.binary(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                          ["key", "links", "root"])

    where = ["bucket", "band", "lo", "hi"]
    return (payload.select(*names).repartition(*where).sortWithinPartitions(*where)
            .mapInArrow(run, "key binary, links long, root binary"))


# --- components ------------------------------------------------------------

def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of (u, v) edges; the root is the least node.

    Alternating large-star and small-star rounds; every round is written to the
    shared folder, so it survives lost executors and lineage stays short.
    """
    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = stored(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                 .distinct(), "edges")
    last = state(now)
    while last[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u != v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        tied = large.join(low, "u")
        small = (tied.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))))
        oriented = small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        now = stored(oriented.where("u != v").distinct(), "edges")
        state_now = state(now)
        if state_now == last:
            break
        last = state_now
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


# --- the operator ----------------------------------------------------------

def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: id, ``text_hash`` (xxhash64, NULL as empty),
    ``n_shingles``, ``copies`` (rows with the same shingle set, itself included),
    ``n_links`` (other rows with a similarity of at least ``threshold``),
    ``exact_id`` (least id of its copies), ``group_id`` (least id of its connected
    component) and ``is_first`` (the row is the component's least by id and text
    hash).

    NULL, empty and blank texts have no shingles: no links, ``copies`` 1, both ids
    their own, ``is_first`` true. Rows that repeat an id count as rows of their
    own; rows equal in id and text are both first or both not. An empty table
    gives no rows; other columns are not read.
    """
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    base = docs.select(docs[id_col].alias("id"), F.xxhash64(text).alias("tag"), text.alias("text"))
    sketches = stored(_sketches(base), "sketches")
    classes = stored(sketches.where("n > 0").groupBy("key").agg(
        F.min(F.struct("id", "tag")).alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"),
        F.first("sig").alias("sig")), "classes")
    bands = _bands(classes)
    member = F.xxhash64("key")
    buckets = (bands.groupBy("bucket", "band")
               .agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("total"),
                    F.bit_xor(member).alias("x"), F.min(member).alias("y"))
               .where("size > 1").groupBy("size", "total", "x", "y")
               .agg(F.min(F.struct("band", "bucket")).alias("b"))
               .select(F.col("b.bucket").alias("bucket"), F.col("b.band").alias("band"),
                       F.ceil(F.greatest(F.col("size") / BLOCK_TEXTS, F.col("total") / BLOCK_SHINGLES))
                       .cast("int").alias("blocks")))
    places = (bands.select("bucket", "band", "key").join(buckets, ["bucket", "band"])
              .groupBy("key").agg(F.collect_list(F.struct("bucket", "band", "blocks")).alias("places"),
                                  F.sum(F.expr("shiftleft(1L, band)")).alias("kept")))
    wanted = classes.select("key", "rep", "copies", "sig").join(places, "key")
    texts = base.join(wanted, base["id"].eqNullSafe(F.col("rep.id"))
                      & (base["tag"] == F.col("rep.tag")))

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in sliced(batch.column("text")):
                row, value = shingles(data, offsets)
                counts = np.bincount(row, minlength=hi - lo)
                cut = np.split(value, np.cumsum(counts)[:-1]) if hi > lo else []
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("key", "copies", "sig", "kept", "places")),
                     _binary(cut)], ["key", "copies", "sig", "kept", "places", "shingles"])

    place_type = wanted.schema["places"].dataType.simpleString()
    loaded = texts.select("text", "key", "copies", "sig", "kept", "places").mapInArrow(
        load, f"key binary, copies long, sig binary, kept long, places {place_type}, shingles binary")
    dealt = (loaded.withColumn("p", F.explode("places")).drop("places")
             .withColumn("block", F.pmod(F.xxhash64("key"), F.col("p.blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("p.blocks") - 1)))
             .select(F.col("p.bucket").alias("bucket"), F.col("p.band").alias("band"),
                     F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
                     "block", "key", "copies", "sig", "kept", "shingles"))
    linked = stored(_joined_blocks(dealt, threshold), "links")
    links = linked.groupBy("key").agg(F.sum("links").alias("links"))
    roots = components(linked.select(F.col("key").alias("u"), F.col("root").alias("v")))
    own = (classes.select("key", "rep", "copies").join(links, "key", "left")
           .join(roots.withColumnRenamed("node", "key"), "key", "left")
           .withColumn("root", F.coalesce("root", "key")))
    least = own.groupBy("root").agg(F.min("rep").alias("first"))
    judged = own.join(least, "root").select(
        "key", "copies", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        "rep", "first")
    found = sketches.select("id", "tag", "n", "key").join(judged, "key", "left")
    has = F.col("n") > 0
    return found.select(
        F.col("id").alias(id_col), F.col("tag").alias("text_hash"), F.col("n").alias("n_shingles"),
        F.when(has, F.col("copies")).otherwise(1).alias("copies"),
        F.when(has, F.col("n_links")).otherwise(0).alias("n_links"),
        F.when(has, F.col("rep.id")).otherwise(F.col("id")).alias("exact_id"),
        F.when(has, F.col("first.id")).otherwise(F.col("id")).alias("group_id"),
        F.when(has, F.col("id").eqNullSafe(F.col("first.id")) & (F.col("tag") == F.col("first.tag")))
        .otherwise(True).alias("is_first"))


def first_of_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = THRESHOLD) -> DataFrame:
    """The rows, with all their columns, that are first of their component; of
    rows equal in id and text one stays."""
    judged = jaccard_join(docs, id_col, text_col, threshold).where("is_first")
    wanted = judged.select(F.col(id_col).alias("id"), F.col("text_hash").alias("tag")).distinct()
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    rows = docs.select(docs[id_col].alias("id"), F.xxhash64(text).alias("tag"),
                       F.struct(*(docs[c].alias(f"c{k}") for k, c in enumerate(docs.columns))).alias("row"))
    kept = rows.join(wanted, rows["id"].eqNullSafe(wanted["id"]) & (rows["tag"] == wanted["tag"]),
                     "left_semi").dropDuplicates(["id", "tag"])
    return kept.select(*(F.col(f"row.c{k}").alias(c) for k, c in enumerate(docs.columns)))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` against each other; the hashes of the texts, which only tell
    rows of equal ids apart, are left out."""
    return jaccard_join(table(spark, sf_dir, "documents")).drop("text_hash")

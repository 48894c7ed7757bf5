"""Ranked lexical search with bag deduplication.

Every document is restricted to the words of the items (its bag: term numbers and
frequencies) and to its length figure m; nothing else of it enters a score. Documents
with the same bag and the same m form a class: they are grouped by a hash of both and
verified by comparing both (Spark's grouping does the two), each class is scored
once, and only the classes that can reach an item's list are expanded to their
members, by ascending id.

An item's list needs at most its first ``k`` classes by (score, least member): each
of those puts at least its least member before every member of a later class. Of
each such class at most its ``k`` least members are needed. So the two cuts to ``k``
lose nothing, whatever number of documents share a bag.

Passes: bags (map only, written), corpus figures (sums), classes (one aggregate with
partial sums, so a class of a third of all rows sends one row per task), scores (map
only, at most k classes per item and task), expansion.

The items are dealt into blocks of about ``BLOCK_ITEMS`` items and ``BLOCK_BYTES`` of
text at most (one item at least), and each block is searched on its own; so neither the
vocabulary that tasks hold nor the lists of classes grow with the items.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from forecheck.llm.common import RangeHash, sliced, stored, table, word_spans

K = 20
BLOCK_BYTES = 8 << 20
BLOCK_ITEMS = 10_000
SCORE_CELLS = 1 << 21       # cells of a score matrix (classes by items)

# ASCII bytes that are not letters or digits separate words
_APART = np.zeros(256, bool)
_APART[:128] = True
for _a, _b in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B)):
    _APART[_a:_b] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


class Vocabulary:
    """The words of a block of items: hash -> number, checked by their bytes."""

    def __init__(self, words: list[bytes]):
        words = sorted(words)
        self.size = len(words)
        self.lengths = np.array([len(w) for w in words], np.int64)
        self.data = np.frombuffer(b"".join(words), np.uint8)
        self.begins = np.cumsum(self.lengths) - self.lengths
        hashes = RangeHash(self.data)(self.begins, self.begins + self.lengths)
        self.order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.order]
        if self.size > 1 and (np.diff(self.hashes) == 0).any():
            raise ValueError("two words of the items have one hash")

    def find(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The number of each word of ``data``, -1 for others."""
        if not self.size or not len(start):
            return np.full(len(start), -1, np.int64)
        hashes = RangeHash(data)(start, end)
        at = np.minimum(np.searchsorted(self.hashes, hashes), self.size - 1)
        number = np.where(self.hashes[at] == hashes, self.order[at], -1)
        found = np.flatnonzero(number >= 0)
        same = self.lengths[number[found]] == (end - start)[found]
        number[found[~same]] = -1
        found = found[same]
        # equal hashes: compare the bytes
        n = (end - start)[found]
        total = np.cumsum(n)
        inner = np.arange(int(total[-1]) if len(n) else 0) - np.repeat(total - n, n)
        differ = (data[np.repeat(start[found], n) + inner]
                  != self.data[np.repeat(self.begins[number[found]], n) + inner])
        if differ.any():
            number[found[np.searchsorted(total, np.flatnonzero(differ), side="right")]] = -1
        return number


def _words(data: np.ndarray, offsets: np.ndarray):
    data = _LOWER[data]
    return data, *word_spans(data, offsets, _APART)


def item_terms(items: DataFrame, item_col: str, text_col: str, block: str) -> DataFrame:
    """(block, key, item_id, term, times): each item's words and their occurrences;
    ``key`` numbers the items, so that repeated ids stay apart."""
    lower = F.translate(F.col("text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    term = F.regexp_extract_all(lower, F.lit(r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)"), 1)
    return (items.withColumn("term", F.explode(term))
            .groupBy(block, "key", item_col, "term").agg(F.count("*").alias("times")))


def bags(docs: DataFrame, words: Vocabulary, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n, bag): the number of words of every whole text, and its bag as
    pairs of 32-bit integers (term number, frequency), ascending."""
    picked = docs.select(docs[id_col].cast("long").alias("id"),
                         docs[text_col].cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Vocabulary = shared.value
        for batch in batches:
            for lo, hi, data, offsets in sliced(batch.column(1)):
                data, start, end, row = _words(data, offsets)
                number = known.find(data, start, end)
                n = np.bincount(row, minlength=hi - lo)
                hit = number >= 0
                cell, times = np.unique(row[hit] * known.size + number[hit], return_counts=True)
                owner = cell // max(known.size, 1)
                packed = np.stack((cell - owner * known.size, times), axis=1).astype("<i4")
                ends = np.searchsorted(owner, np.arange(hi - lo + 1)) * 8
                bag = pa.Array.from_buffers(pa.binary(), hi - lo, [
                    None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(packed.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(n, pa.int64()), bag],
                    ["doc_id", "n", "bag"])

    return picked.mapInArrow(run, "doc_id long, n long, bag binary")


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, frequency) of the pairs of a column of bags."""
    ends = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4).astype(np.int64)
    data = column.buffers()[2]
    pairs = np.frombuffer(data, "<i4", (int(ends[-1]) - int(ends[0])) // 4, int(ends[0])) \
        if data is not None and ends[-1] > ends[0] else np.zeros(0, "<i4")
    row = np.repeat(np.arange(len(column)), np.diff(ends) // 8)
    return row, pairs[0::2].astype(np.int64), pairs[1::2].astype(np.int64)


def document_frequencies(held: DataFrame, size: int) -> DataFrame:
    """(term, df): tasks count their own documents, one row per term and task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for batch in batches:
            df += np.bincount(_flat(batch.column(0))[1], minlength=size)
        terms = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.int64()), pa.array(df[terms], pa.int64())],
                                         ["term", "df"])

    return (held.select("bag").mapInArrow(run, "term long, df long")
            .groupBy("term").agg(F.sum("df").alias("df")))


class Scorer:
    """Scores of classes for all items of a block, and the best k per item so far."""

    def __init__(self, weight: np.ndarray, item_begin: np.ndarray, item: np.ndarray,
                 times: np.ndarray, n_items: int, k: int):
        # postings of a term: items[item_begin[t]:item_begin[t + 1]]
        self.weight, self.begin, self.item, self.times = weight, item_begin, item, times
        self.n_items, self.k = n_items, k
        self.most_terms = int(np.bincount(item, minlength=1).max())   # of one item
        self.least = np.zeros(n_items, np.int64)
        self.kept = [np.zeros(0, np.int64) for _ in range(4)]   # item, score, least id, class

    def add(self, row, term, tf, m, least_id, key) -> None:
        """Classes given by their pairs (row, term, tf) and by row: m, least id, key."""
        value = 1_000_000_000 * tf // (1000 * tf + 12 * m[row])
        counts = self.begin[term + 1] - self.begin[term]
        step = max(1, SCORE_CELLS // max(self.n_items, 1))
        for lo in range(0, len(m), step):
            hi = min(lo + step, len(m))
            a, b = np.searchsorted(row, (lo, hi))
            n = counts[a:b]
            total = np.cumsum(n)
            if not len(n) or not total[-1]:
                continue
            at = np.arange(total[-1]) + np.repeat(self.begin[term[a:b]] - total + n, n)
            share = np.repeat(self.weight[term[a:b]] * value[a:b], n) * self.times[at]
            cell = np.repeat(row[a:b] - lo, n) * self.n_items + self.item[at]
            score = np.zeros((hi - lo) * self.n_items, np.int64)
            if float(share.max()) * self.most_terms < 2.0 ** 53:     # sums exact in doubles
                score += np.bincount(cell, share, len(score)).astype(np.int64)
            else:
                np.add.at(score, cell, share)
            score = score.reshape(hi - lo, self.n_items)
            r, i = np.nonzero((score > 0) & (score >= self.least))
            self._merge(i, score[r, i], least_id[lo + r], key[lo + r])

    def _merge(self, item, score, least_id, key) -> None:
        new = [np.concatenate(x) for x in zip(self.kept, (item, score, least_id, key))]
        order = np.lexsort((new[2], -new[1], new[0]))
        new = [x[order] for x in new]
        first = np.searchsorted(new[0], np.arange(self.n_items + 1))
        place = np.arange(len(order)) - first[new[0]]
        self.kept = [x[place < self.k] for x in new]
        full = np.flatnonzero(np.diff(first) >= self.k)
        self.least[full] = new[1][first[full] + self.k - 1]


def _search_block(docs: DataFrame, terms: list, id_col: str, text_col: str, k: int) -> DataFrame:
    """(key, rank, doc_id, score) of the items whose terms (key, term, times) are given."""
    spark = docs.sparkSession
    words = Vocabulary(list({r.term.encode() for r in terms}))
    number = {w: i for i, w in enumerate(sorted({r.term.encode() for r in terms}))}
    held = stored(bags(docs, words, id_col, text_col)
                  .withColumn("row", F.monotonically_increasing_id()), "bags")

    total = held.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"),
                     F.coalesce(F.sum("n"), F.lit(0)).alias("words")).first()
    n_docs, n_words = total.docs, total.words
    df = np.zeros(words.size, np.int64)
    for r in document_frequencies(held, words.size).collect():   # one row per word of the items
        df[r.term] = r.df
    weight = np.floor(1000 * np.log((2.0 * n_docs + 2) / (2.0 * df + 1))).astype(np.int64)

    keys = sorted({r.key for r in terms})
    place = {key: i for i, key in enumerate(keys)}
    postings = sorted((number[r.term.encode()], place[r.key], r.times) for r in terms)
    posting = np.array(postings, np.int64).reshape(len(postings), 3)
    begin = np.searchsorted(posting[:, 0], np.arange(words.size + 1))
    shared = spark.sparkContext.broadcast((weight, begin, posting[:, 1], posting[:, 2]))

    # the figure m of a document with n words; documents without a word of the
    # items score nothing for any of them
    m = F.lit(75) + F.expr(f"(25 * n * {n_docs}L) div {max(n_words, 1)}L")
    with_m = held.where(F.length("bag") > 0).withColumn("m", m)
    last = F.coalesce(F.col("doc_id"), F.lit(2**63 - 1))
    classes = with_m.groupBy("bag", "m").agg(F.min(last).alias("least_id"), F.min("row").alias("class"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*shared.value, len(keys), k)
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in (1, 2, 3)]
            scorer.add(*_flat(batch.column(0)), *columns)
        item, score, least_id, key = scorer.kept
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, pa.int64()) for x in (np.array(keys, np.int64)[item], score, least_id, key)],
            ["key", "score", "least_id", "class"])

    scored = (classes.select("bag", "m", "least_id", "class")
              .mapInArrow(run, "key long, score long, least_id long, class long"))
    w = Window.partitionBy("key").orderBy(F.desc("score"), F.asc("least_id"))
    best = stored(scored.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)
                  .select("key", "score", "class"), "classes")

    # members of those classes (k per item of the block at most, as numbers): found by
    # the hash of bag and m, verified by both
    chosen = best.select("class").distinct()
    mark = F.xxhash64("bag", "m")
    picked = (with_m.join(F.broadcast(chosen), F.col("row") == F.col("class"))
              .select("class", "bag", "m", mark.alias("mark")))
    likely = with_m.withColumn("mark", mark).join(
        F.broadcast(picked.select("mark").distinct()), "mark", "left_semi")
    least = Window.partitionBy("mark", "bag", "m").orderBy(F.asc_nulls_last("doc_id"))
    members = (likely.withColumn("place", F.row_number().over(least)).where(F.col("place") <= k)
               .join(picked, ["mark", "bag", "m"]).select("class", "doc_id"))
    w = Window.partitionBy("key").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (best.join(members, "class").withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= k).select("key", "rank", "doc_id", "score"))


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", k: int = K) -> DataFrame:
    """The ``k`` highest-scoring documents of every item, over all documents. Call
    ``common.ship`` first where this package is not installed on the executors.

    Returns item_id, rank (from 1), doc_id, score. Scores are whole numbers; equal
    scores by ascending doc_id, NULL ids last; only scores above 0. Words are runs of
    ASCII letters and digits and of characters beyond ASCII, A-Z lower-cased. NULL and
    empty texts have none: such documents count nowhere, such items get no rows.
    Repeated document rows are documents of their own and share a class; repeated item
    rows each get their list (ranks then repeat under one item_id). Empty tables give
    no rows; other columns are not read.
    """
    spark = docs.sparkSession
    own = (items.select(items[item_col].alias("item_id"), items[item_text_col].cast("string").alias("text"))
           .withColumn("key", F.monotonically_increasing_id()))
    size = own.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes"),
                   F.count("*").alias("items")).first()
    # twice as many as needed where one does not do, as a hash deals them unevenly
    blocks = max(1, *(-(-2 * n // most) if n > most else 1
                      for n, most in ((size["bytes"], BLOCK_BYTES), (size["items"], BLOCK_ITEMS))))
    terms = stored(item_terms(own.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int")),
                              "item_id", "text", "block"), "item-terms")
    found = None
    for block in range(blocks):
        rows = terms.where(F.col("block") == block).select("key", "term", "times").collect()
        if not rows:
            continue
        part = _search_block(docs, rows, id_col, text_col, k)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], "key long, rank int, doc_id long, score long")
    names = terms.select("key", "item_id").distinct()
    return found.join(names, "key").select("item_id", "rank", "doc_id", "score")


def op11_bag_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` ranked for each item of ``benchmark``, 20 per item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))

"""Quality rule: repetition inside a text, from a suffix array over its words.

Each text is a sequence of words (runs of anything but ASCII white space). A
suffix array orders the word suffixes of every text; neighbours' longest common
prefixes (LCP) describe the LCP intervals, whose values are the right-maximal
repeated substrings. The deepest interval that holds suffix ``i`` has the value
``max(lcp[rank i], lcp[rank i + 1])``: the longest repeat that starts at word
``i``. Extending to the left until that value stops growing gives the maximal
repeats; the union of their spans and the longest of them are limited.

One pass over the rows, no shuffle: texts are independent, so a hot source or a
group of copies is just more rows. Batches are cut into slices of a few MB, so
memory is bounded by the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from forecheck.llm.common import RangeHash, sliced, spread, table, word_spans

SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True

MIN_WORDS = 20          # base rule: shorter texts fail
BASE_WINDOW = 8         # base rule: words of a repeated window
BASE_PERCENT = 30       # base rule: most words in repeated windows, in percent
MIN_REPEAT = 5          # verdict: shortest repeat that counts, in words
MAX_COVERED = 40        # verdict: most words covered by repeats, in percent
MAX_LONGEST = 100       # verdict: longest repeat allowed, in words

SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, "
          "n_repeat_words long, n_covered_words long, longest_repeat long, "
          "base_failed boolean, kept boolean")


def suffix_array(words: np.ndarray, rows: np.ndarray):
    """Suffix order of every row's words at once, by prefix doubling.

    Returns the order and the ranks after 1, 2, 4, ... words (equal rank: equal
    so far). Suffixes of different rows never tie; only suffixes that still tie
    are sorted again.
    """
    n = len(words)
    _, ids = np.unique(words, return_inverse=True)
    key = rows * np.int64(n + 1) + ids
    order = np.argsort(key, kind="stable")
    rank = _ranks(key[order], order, n)
    left = np.bincount(rows, minlength=int(rows[-1]) + 1).cumsum()[rows] - np.arange(n)
    levels, step = [rank], 1
    while True:
        counts = np.bincount(rank, minlength=n)
        tied = np.flatnonzero(counts[rank[order]] > 1)       # places in the order
        at = order[tied]
        if not len(at) or not (left[at] > step).any():
            return order, levels
        after = np.zeros(len(at), np.int64)
        inside = left[at] > step
        after[inside] = rank[at[inside] + step] + 1
        sub = np.lexsort((after, rank[at]))
        order[tied] = at[sub]
        pair = rank[at[sub]] * np.int64(n + 2) + after[sub]
        rank = rank.copy()
        new = np.ones(len(sub), bool)
        new[1:] = pair[1:] != pair[:-1]
        rank[at[sub]] = tied[np.maximum.accumulate(np.where(new, np.arange(len(sub)), 0))]
        if np.array_equal(rank, levels[-1]):
            return order, levels
        levels.append(rank)
        step *= 2


def _ranks(sorted_key: np.ndarray, order: np.ndarray, n: int) -> np.ndarray:
    new = np.ones(n, bool)
    new[1:] = sorted_key[1:] != sorted_key[:-1]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    return rank


def longest_repeats(words: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """For each word, the length of the longest repeat of its text that starts
    there: the value of the deepest LCP interval around its suffix."""
    n = len(words)
    if n < 2:
        return np.zeros(n, np.int64)
    order, levels = suffix_array(words, rows)
    a, b = order[:-1], order[1:]
    pairs = np.flatnonzero(levels[0][a] == levels[0][b])
    i, j = a[pairs], b[pairs]
    ends = np.bincount(rows, minlength=int(rows[-1]) + 1).cumsum()[rows]
    length = np.zeros(len(pairs), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        # a pair may agree on this many words more than once at the top level
        while True:
            x, y = i + length, j + length
            ok = (x < ends[i]) & (y < ends[j])
            ok[ok] = levels[k][x[ok]] == levels[k][y[ok]]
            ok &= (length + (1 << k) <= np.minimum(ends[i] - i, ends[j] - j))
            if not ok.any():
                break
            length[ok] += 1 << k
            if k < len(levels) - 1:
                break
    lcp = np.zeros(n + 1, np.int64)
    lcp[pairs + 1] = length
    best = np.empty(n, np.int64)
    best[order] = np.maximum(lcp[:-1], lcp[1:])
    return best


def _lines_repeated(text: str | None) -> int:
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if line.strip(" \t\x0b\x0c\r"):
            repeated += line in seen
            seen.add(line)
    return repeated


def _measure(column: pa.Array, min_repeat: int, max_covered: int, max_longest: int):
    out = {k: [] for k in ("n_words", "word_chars", "n_symbols", "n_repeat_words",
                           "n_covered_words", "longest_repeat")}
    for _, _, data, offsets in sliced(column):
        n_rows = len(offsets) - 1
        starts, ends, rows = word_spans(data, offsets)
        count = lambda flags: np.diff(np.concatenate(([0], np.cumsum(flags)))[offsets])
        inside = np.zeros(len(data) + 1, np.int64)
        inside[starts] += 1
        inside[ends] -= 1
        leads = (data & 0xC0) != 0x80
        per_row = lambda weights: np.bincount(rows, weights, n_rows).astype(np.int64)
        best = longest_repeats(RangeHash(data)(starts, ends), rows)
        # maximal: a repeat one word to the left does not already contain it
        maximal = np.ones(len(best), bool)
        maximal[1:] = (best[1:] >= best[:-1]) | (rows[1:] != rows[:-1])
        longest = np.zeros(n_rows, np.int64)
        np.maximum.at(longest, rows, best)
        out["n_words"].append(np.bincount(rows, minlength=n_rows))
        out["word_chars"].append(count(leads & (np.cumsum(inside[:-1]) > 0)))
        out["n_symbols"].append(count(SYMBOLS[data]))
        for name, least in (("n_repeat_words", BASE_WINDOW), ("n_covered_words", min_repeat)):
            at = np.flatnonzero(maximal & (best >= least))
            out[name].append(per_row(spread(at, best[at], len(best))))
        out["longest_repeat"].append(longest)
    got = {k: np.concatenate(v) if v else np.zeros(0, np.int64) for k, v in out.items()}
    got["n_dup_lines"] = np.array([_lines_repeated(t) for t in column.to_pylist()], np.int64)
    failed = ((got["n_words"] < MIN_WORDS)
              | (100 * got["n_repeat_words"] > BASE_PERCENT * got["n_words"]))
    got["base_failed"] = failed
    got["kept"] = (~failed & (100 * got["n_covered_words"] <= max_covered * got["n_words"])
                   & (got["longest_repeat"] <= max_longest))
    return got


def repetition(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_repeat: int = MIN_REPEAT, max_covered: int = MAX_COVERED,
               max_longest: int = MAX_LONGEST) -> DataFrame:
    """One row per input row: counts, repeats, and whether the text is kept.

    ``n_covered_words`` are the words inside maximal repeats of ``min_repeat``
    words or more, ``longest_repeat`` the longest of any length. A text is kept
    when it passes the base rule, at most ``max_covered`` percent of its words
    are covered and no repeat is longer than ``max_longest`` words.

    NULL or empty text: no words, all counts 0, fails the base rule. Repeated
    rows and repeated ids: one result each. Empty table: no rows. Only the two
    named columns are read, so other columns may have any name.
    """
    picked = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    id_type = picked.schema["id"].dataType.simpleString()
    names = [f.split()[0] for f in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = _measure(batch.column(1), min_repeat, max_covered, max_longest)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(got[k]) for k in names)], ["id", *names])

    return (picked.mapInArrow(run, f"id {id_type}, {SCHEMA}").withColumnRenamed("id", id_col))


def op1_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` with the base counts and the verdict."""
    return repetition(table(spark, sf_dir, "documents")).drop("longest_repeat")

"""License scan: winnowed fingerprints find candidates, banded alignment decides.

Templates (whole licences, headers and notices, 32,000 words in all) and texts
are folded to words. Hashes of
three consecutive words are winnowed: of every two neighbours the smaller hash
stays (the later one on ties), so any run of four common words shares a
fingerprint. Fingerprints of the templates form an inverted index (hash ->
template, place), sent to every task. A hit of a text's fingerprint gives a
diagonal; hits of one template on near diagonals and at near places are one
candidate, whose words are aligned with the template inside a band around the
diagonal (match 2, other word or gap -1, local). The text before and after is
aligned again, until no hit is left. A match of a notice or header is taken only if
the phrases that name its licence (name, variant, version) stand in its span word by
word; whole texts compete: of matches that overlap the best score stays. It reports
the share of template words found and its span in the text.

One pass over the rows; no shuffle. Work follows the text, candidates included:
every hit is aligned, none is capped. A candidate is passed over only if too few
template words have an equal text word anywhere in the band, as no alignment in
it could then reach the coverage.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from forecheck.llm.common import RangeHash, mix, sliced, table, word_spans
from forecheck.llm.license_templates import DISTINCT, FOREIGN, TEMPLATES, TITLES

GRAM = 3                # words of a fingerprint; of two neighbours one stays
BAND = 6                # words an alignment may drift from its diagonal
DRIFT = 200             # one more for so many words of the template
MIN_COVERAGE = 0.8      # share of template words that must be found

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A"):ord("Z") + 1] += 32
# word characters: ASCII letters and digits and everything outside ASCII
_BREAK = np.ones(256, bool)
for _lo, _hi in (("a", "z"), ("0", "9")):
    _BREAK[ord(_lo):ord(_hi) + 1] = False
_BREAK[128:] = False

MATCHES = ("array<struct<license:string,coverage:double,matched:int,first_word:int,last_word:int,"
           "begin:int,end:int>>")


def _words(data: np.ndarray, offsets: np.ndarray):
    folded = _FOLD[data]
    starts, ends, rows = word_spans(folded, offsets, _BREAK)
    return starts, ends, rows, RangeHash(folded, seed=9)(starts, ends)


def _versioned(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether each word is a number that goes on in the next one, as 2 in 2.1
    (2.0 is 2)."""
    digit = (data >= ord("0")) & (data <= ord("9"))
    on = np.zeros(len(starts), bool)
    gap = ends[:-1]
    on[:-1] = ((starts[1:] == gap + 1) & (data[gap] == ord(".")) & digit[gap - 1]
               & digit[starts[1:]] & (data[starts[1:]] != ord("0")))
    return on


def _runs(words: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Places of ``words`` where ``phrase`` begins."""
    n = len(words) - len(phrase) + 1
    hit = np.ones(max(n, 0), bool)
    for k, word in enumerate(phrase if n > 0 else ()):
        hit &= words[k:n + k] == word
    return np.flatnonzero(hit)


def fingerprints(words: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of the first word, hash) of the winnowed grams; grams and windows
    do not cross rows. A row with fewer grams than a window keeps its least."""
    n = len(words) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    value = np.zeros(n, np.uint64)
    for k in range(GRAM):
        value = mix(value * np.uint64(0x9E3779B97F4A7C15) + words[k:n + k])
    at = np.flatnonzero(rows[:n] == rows[GRAM - 1:])
    value, row = value[at], rows[at]
    keep = np.zeros(len(at), bool)
    single = np.ones(len(at), bool)
    same = row[1:] == row[:-1]
    later = value[1:] <= value[:-1]
    keep[1:] |= same & later
    keep[:-1] |= same & ~later
    single[1:] &= ~same
    single[:-1] &= ~same
    keep |= single
    return at[keep], value[keep]


class Index:
    """Templates with their words, the inverted index of their fingerprints and
    their distinguishing phrases (words, template places they concern)."""

    def __init__(self, templates: dict[str, str], distinct: dict[str, tuple[str, ...]] | None = None,
                 titles: dict[str, str] | None = None, foreign: dict[str, tuple[str, ...]] | None = None):
        self.names = sorted(templates)
        raw = [templates[n].encode() for n in self.names]
        data = np.frombuffer(b"".join(raw), np.uint8)
        offsets = np.concatenate(([0], np.cumsum([len(r) for r in raw]))).astype(np.int64)
        _, _, rows, words = _words(data, offsets)
        firsts = np.searchsorted(rows, np.arange(len(raw) + 1))
        self.words = [words[a:b] for a, b in zip(firsts[:-1], firsts[1:])]
        at, value = fingerprints(words, rows)
        order = np.argsort(value, kind="stable")
        self.hashes = value[order]
        self.template = rows[at][order]
        self.place = (at - firsts[rows[at]])[order]
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        self.phrases: list[list[tuple[np.ndarray, int, int]]] = [[] for _ in self.names]
        for k, name in enumerate(self.names):
            own = [(p, False) for p in (distinct or {}).get(name, ())]
            own += [(titles[name], True)] if name in (titles or {}) else []
            for phrase, title in own:
                part = self._phrase(phrase)
                at = int(_runs(self.words[k], part)[0]) if title else 0
                end = at + len(part) if title else len(self.words[k])
                self.phrases[k].append((part, at, end))
        self.foreign = [[self._phrase(p) for p in (foreign or {}).get(n, ())] for n in self.names]

    @staticmethod
    def _phrase(text: str) -> np.ndarray:
        part = np.frombuffer(text.encode(), np.uint8)
        return _words(part, np.array([0, len(part)]))[3]


def align(template: np.ndarray, text: np.ndarray, diagonal: int, band: int = BAND):
    """Best local alignment inside the band: (score, matched template words,
    first and last text word, first and last template word), or None. ``diagonal``
    is text place minus template place; of equal scores the earliest end wins."""
    lo = max(0, diagonal - band)
    part = text[lo:max(lo, diagonal + band + len(template))].tolist()
    above: dict[int, tuple] = {}
    best = None
    for i, word in enumerate(template.tolist()):
        row: dict[int, tuple] = {}
        left = None
        for j in range(max(lo, i + diagonal - band), min(lo + len(part), i + diagonal + band + 1)):
            same = part[j - lo] == word
            before = above.get(j - 1)
            cell = None
            if before is not None and before[0] > 0:
                cell = ((before[0] + 2, before[1] + 1, before[2], j, before[4], i) if same
                        else (before[0] - 1, *before[1:]))
            elif same:
                cell = (2, 1, j, j, i, i)
            for other in (above.get(j), left):
                if other is not None and (cell is None or other[0] - 1 > cell[0]):
                    cell = (other[0] - 1, *other[1:])
            left = cell if cell is not None and cell[0] > 0 else None
            if left is not None:
                row[j] = left
                if best is None or left[0] > best[0]:
                    best = left
        above = row
    return best


def _in_band(template: np.ndarray, text: np.ndarray, diagonal: int, band: int) -> int:
    """Template words that have an equal text word in the band."""
    near = np.zeros(len(template) + 2 * band, np.uint64)
    at = diagonal - band
    a, b = max(at, 0), min(at + len(near), len(text))
    if a >= b:
        return 0
    near[a - at:b - at] = text[a:b]
    found = np.zeros(len(template), bool)
    for k in range(2 * band + 1):
        found |= near[k:k + len(template)] == template
    return int(found.sum())


def _told_apart(index: Index, template: int, words: np.ndarray, versioned: np.ndarray, got: tuple) -> bool:
    """Whether the phrases of the template stand in the span of a match, and no phrase
    of another licence does."""
    span = words[got[2]:got[3] + 1]
    for phrase, at, end in index.phrases[template]:
        if got[4] < end and at <= got[5]:
            places = got[2] + _runs(span, phrase)
            if not (~versioned[places + len(phrase) - 1]).any():
                return False
    return not any(len(_runs(span, phrase)) for phrase in index.foreign[template])


def _occurrences(index: Index, template: int, words: np.ndarray, versioned: np.ndarray,
                 places: list[int], diagonals: list[int], min_coverage: float) -> Iterator[tuple]:
    """Matches of one template; its hits come in text order. The first hit left is
    aligned, with those on near diagonals around it. An alignment of enough words
    splits the text, also where it is of another licence: the hits before and after
    it are aligned again, each on its side. Otherwise its hits are done."""
    own = index.words[template]
    reach = BAND + len(own) // DRIFT
    done = bytearray(len(places))
    todo = [(0, len(words), 0, len(places))]
    while todo:
        lo, hi, k, end = todo.pop()
        while k < end and done[k]:
            k += 1
        if k == end or hi - lo < min_coverage * len(own):
            continue
        last = bisect_right(places, places[k] + len(own) + 2 * reach, k, end)
        group = [j for j in range(k, last) if not done[j] and abs(diagonals[j] - diagonals[k]) <= reach]
        low, high = min(diagonals[j] for j in group), max(diagonals[j] for j in group)
        diagonal, band = (low + high) // 2 - lo, reach + (high - low + 1) // 2
        part = words[lo:hi]
        got = None
        if _in_band(own, part, diagonal, band) >= min_coverage * len(own):
            got = align(own, part, diagonal, band)
        if got is None or got[1] < min_coverage * len(own):
            for j in group:
                done[j] = 1
            todo.append((lo, hi, k, end))
            continue
        first, final = lo + got[2], lo + got[3]
        if _told_apart(index, template, part, versioned[lo:hi], got):
            yield index.names[template], got[1] / len(own), got[1], first, final, got[0]
        todo.append((final + 1, hi, bisect_right(places, final, k, end), end))
        todo.append((lo, first, k, bisect_left(places, first, k, end)))


def _matches(index: Index, words: np.ndarray, versioned: np.ndarray,
             hits: list[tuple[int, int, int]], min_coverage: float) -> list[tuple]:
    """Matches of one text; ``hits`` are (template, text place, diagonal)."""
    found: list[tuple] = []
    hits.sort()
    for template, own in groupby(hits, key=lambda h: h[0]):
        _, places, diagonals = zip(*own)
        found += _occurrences(index, template, words, versioned, places, diagonals, min_coverage)
    # where matches overlap, the one with the best score stays
    out: list[tuple] = []
    for m in sorted(found, key=lambda m: (-m[5], -m[1], m[3], m[0])):
        at = bisect_left(out, m[3], key=lambda o: o[3])
        if (at == 0 or out[at - 1][4] < m[3]) and (at == len(out) or m[4] < out[at][3]):
            out.insert(at, m)
    return out


def scan(docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id",
         text_col: str = "text", min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """One row per input row: id, ``n_matches``, ``licenses`` (sorted names, joined
    by commas) and ``matches`` (name, coverage, matched words, word and byte span
    of each match, in text order; spans end after the last matched word).

    NULL or empty texts have no matches; repeated rows get a result each; an
    empty table gives none; other columns are not read. A template of fewer
    than three words has no fingerprint and is never found. ``templates`` of one's
    own have no distinguishing phrases.
    """
    known = (TEMPLATES, DISTINCT, TITLES, FOREIGN) if templates is None else (templates, {}, {}, {})
    picked = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    id_type = picked.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(*known)
        for batch in batches:
            found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for lo, _, data, offsets in sliced(batch.column(1)):
                starts, ends, rows, words = _words(data, offsets)
                at, value = fingerprints(words, rows)
                if not len(at) or not len(index.hashes):
                    continue
                a = np.searchsorted(index.hashes, value, "left")
                n = np.searchsorted(index.hashes, value, "right") - a
                which = np.repeat(np.arange(len(at)), n)
                entry = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + a[which]
                firsts = np.searchsorted(rows, np.arange(len(offsets)))
                # a text too short for the coverage of a template cannot match it
                size = np.diff(firsts)[rows[at[which]]]
                long = size >= min_coverage * index.sizes[index.template[entry]]
                which, entry = which[long], entry[long]
                place = at[which] - firsts[rows[at[which]]]
                versioned = _versioned(data, starts, ends)
                hits: dict[int, list] = {}
                for row, t, p, q in zip(rows[at[which]].tolist(), index.template[entry].tolist(),
                                        place.tolist(), index.place[entry].tolist()):
                    hits.setdefault(row, []).append((t, p, p - q))
                for row, own in hits.items():
                    b, e = firsts[row], firsts[row + 1]
                    for m in _matches(index, words[b:e], versioned[b:e], own, min_coverage):
                        found[lo + row].append({
                            "license": m[0], "coverage": m[1], "matched": m[2], "first_word": m[3],
                            "last_word": m[4], "begin": int(starts[b + m[3]] - offsets[row]),
                            "end": int(ends[b + m[4]] - offsets[row])})
            struct = pa.struct([("license", pa.string()), ("coverage", pa.float64()),
                                ("matched", pa.int32()), ("first_word", pa.int32()),
                                ("last_word", pa.int32()), ("begin", pa.int32()), ("end", pa.int32())])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(m) for m in found], pa.int64()),
                 pa.array([",".join(sorted({x["license"] for x in m})) for m in found], pa.string()),
                 pa.array(found, pa.list_(struct))], ["id", "n_matches", "licenses", "matches"])

    return (picked.mapInArrow(run, f"id {id_type}, n_matches long, licenses string, matches {MATCHES}")
            .withColumnRenamed("id", id_col))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` against all templates."""
    return scan(table(spark, sf_dir, "documents"))

"""Toxicity by compression distance: two zstandard dictionaries, one score.

* ``fit`` learns from a bounded sample of labelled rows. The toxic dictionary holds
  segments of toxic texts: runs of byte 5-grams that make up a clearly larger share
  of toxic than of ordinary texts. A gram counts once per context (the four bytes
  on both sides), so copies of a text count once and long texts by what they say.
  Behind the segments
  both dictionaries hold the same base, trained by zstandard on the windows of
  ordinary texts that hold none of the segments. The shared base makes everyday text
  compress alike under both, so a window's gain, ``length(ordinary) -
  length(toxic)``, comes from toxic segments.
* Calibration is cross-fitted: each half of the sample is measured with the
  dictionaries of the other half, the final dictionaries come from all of it. A
  window's evidence is the log-likelihood ratio of its gain; windows without a gain
  count against toxicity, so the evidence of ordinary text falls with its length
  and a long text needs toxic windows at the rate of toxic texts. A logistic curve
  over a text's evidence and its number of windows gives the score. The sample is
  weighted to the class shares of all training rows, so a score means the same
  probability at every table size.
* ``score`` cuts every whole text into overlapping windows, compresses each
  under both dictionaries and adds the evidence up. One pass, no shuffle.

Labels, language, source and id are never inputs of a score.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecheck.llm.common import mix, table, utf8

# bounds of the fitting sample (rows per class, bytes of a text)
SAMPLE_TOXIC = 1200
SAMPLE_ORDINARY = 3600
SAMPLE_BYTES = 20_000

WINDOW = 128            # bytes of a window
STEP = 118              # consecutive windows share 10 bytes, so no short word is cut in both
BASE_BYTES = 4096       # shared part of both dictionaries
SEGMENT_BYTES = 4096    # toxic segments in front of it
GRAM = 5
MIN_Z = 6.0             # z score of a gram's shares of contexts
MIN_TIMES = 10          # contexts of the gram in toxic texts
MIN_RATIO = 8.0         # share of toxic over share of ordinary contexts
BODY = 5                # bytes of a segment that no window of the base may hold
GAINS = (-20, 40)       # gains are clipped to this range
PRIOR_WINDOWS = 50.0    # weight of the pooled share in the ratio of a gain

_GOLD = 0x9E3779B97F4A7C15
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


@dataclass(frozen=True)
class Model:
    toxic: bytes
    ordinary: bytes
    weights: tuple[float, ...]      # evidence of each clipped gain
    curve: tuple[float, ...]        # of the evidence, of log(1 + windows), constant


def _fold(text: str | None) -> bytes:
    """ASCII lower case, with a space at both ends."""
    raw = np.frombuffer((" " + (text or "") + " ").encode(), np.uint8)
    return _LOWER[raw].tobytes()


def _grams(raw: bytes) -> np.ndarray:
    x = np.frombuffer(raw, np.uint8).astype(np.uint64)
    n = max(0, len(x) - GRAM + 1)
    out = np.zeros(n, np.uint64)
    for k in range(GRAM):
        out = out << np.uint64(8) | x[k:n + k]
    return out


def _contexts(raw: bytes) -> np.ndarray:
    """The grams of a text, each with 24 hash bits of the bytes beside it."""
    own = _grams(raw)
    padded = np.pad(own, GRAM - 1)
    beside = mix(padded[:len(own)] * np.uint64(_GOLD) ^ mix(padded[2 * (GRAM - 1):]))
    return np.unique(own << np.uint64(24) | beside >> np.uint64(40))


def _counts(contexts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
    """Grams, the different contexts of each, and all contexts. What copies of a
    text repeat counts once. Taken by ranges of values, to keep the temporaries small."""
    found, total = [], 0
    for first in range(0, 256, 8):
        low, high = np.uint64(first << 56), np.uint64((first + 7 << 56) + (1 << 56) - 1)
        cut = [c[np.searchsorted(c, low):np.searchsorted(c, high, side="right")] for c in contexts]
        every = np.unique(np.concatenate(cut))
        total += len(every)
        found.append(np.unique(every >> np.uint64(24), return_counts=True))
    grams, counts = (np.concatenate(x) for x in zip(*found))
    return grams, counts, total


def _toxic_segments(toxic: list[bytes], toxic_contexts: list, ordinary_contexts: list) -> list[bytes]:
    """Segments of toxic texts whose grams ordinary texts hardly hold, the most
    frequent last (nearest), each new gram once."""
    grams, times, nt = _counts(toxic_contexts)
    others, counts, no = _counts(ordinary_contexts)
    at = np.minimum(np.searchsorted(others, grams), len(others) - 1)
    other = np.where(others[at] == grams, counts[at], 0)
    p, q = times / nt, other / no
    share = (times + other) / (nt + no)
    z = (p - q) / np.sqrt(share * (1 - share) * (1 / nt + 1 / no) + 1e-18)
    marked = grams[(z >= MIN_Z) & (times >= MIN_TIMES) & (p > MIN_RATIO * q)]
    if not len(marked):
        return []
    runs: Counter[bytes] = Counter()
    for raw in toxic:
        own = _grams(raw)
        at = np.minimum(np.searchsorted(marked, own), len(marked) - 1)
        hit = np.flatnonzero(marked[at] == own)
        if not len(hit):
            continue
        cut = np.flatnonzero(np.diff(hit) > 1)
        begins = np.concatenate((hit[:1], hit[cut + 1]))
        ends = np.concatenate((hit[cut], hit[-1:])) + GRAM
        for a, b in zip(begins.tolist(), ends.tolist()):
            words = [w for w in raw[a:b].split(b" ")]
            # a word keeps the spaces that the run holds
            for k, word in enumerate(words):
                if len(word) >= GRAM - 1:
                    runs[b" " * (k > 0) + word + b" " * (k < len(words) - 1)] += 1
    wanted = {int(g).to_bytes(GRAM, "big") for g in marked}
    seen: set[bytes] = set()
    packed, size = [], 0
    for run, _ in sorted(runs.items(), key=lambda x: (-x[1], x[0])):
        own = {run[k:k + GRAM] for k in range(len(run) - GRAM + 1)}
        if (own & wanted) - seen and size + len(run) <= SEGMENT_BYTES:
            seen |= own
            packed.append(run)
            size += len(run)
    return packed[::-1]


def _dictionaries(toxic: list[bytes], ordinary: list[bytes], toxic_contexts: list,
                  ordinary_contexts: list) -> tuple[bytes, bytes]:
    segments = _toxic_segments(toxic, toxic_contexts, ordinary_contexts)
    bodies = {s.strip()[:BODY] for s in segments}
    every = [w for raw in ordinary for w in _windows(raw)]
    windows = [w for w in every if not any(b in w for b in bodies)] or every
    try:
        base = zstandard.train_dictionary(BASE_BYTES + 1024, windows).as_bytes()[-BASE_BYTES:]
    except zstandard.ZstdError:          # too little text to train on: take it as it is
        base = b"".join(windows)[:BASE_BYTES]
    return b"".join(segments) + base, base


def _windows(raw: bytes) -> list[bytes]:
    return [raw[i:i + WINDOW] for i in range(0, max(1, len(raw) - (WINDOW - STEP)), STEP)]


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    params = zstandard.ZstdCompressionParameters(
        window_log=15, chain_log=14, hash_log=14, search_log=5, min_match=6, target_length=16,
        strategy=zstandard.STRATEGY_LAZY, write_checksum=False, write_content_size=False,
        write_dict_id=False)
    shared = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    shared.precompute_compress(compression_params=params)
    return zstandard.ZstdCompressor(dict_data=shared, compression_params=params)


class Gains:
    """Compares windows under two dictionaries."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        self.toxic, self.ordinary = _compressor(toxic), _compressor(ordinary)

    def __call__(self, raw: bytes) -> np.ndarray:
        """Clipped gain of each window, counted from 0."""
        t, o = self.toxic.compress, self.ordinary.compress
        found = [len(o(w)) - len(t(w)) for w in _windows(raw)]
        return np.clip(np.array(found, np.int64), *GAINS) - GAINS[0]


class Scorer:
    def __init__(self, model: Model):
        self.gains = Gains(model.toxic, model.ordinary)
        self.weights, self.curve = np.array(model.weights), np.array(model.curve)

    def scores(self, column: pa.Array) -> np.ndarray:
        """Score of every text of a string column."""
        data, offsets = utf8(column)
        raw = _LOWER[data].tobytes()
        at = offsets.tolist()
        x = np.zeros((len(at) - 1, 3))
        x[:, 2] = 1.0
        for k, (a, b) in enumerate(zip(at[:-1], at[1:])):
            if raw[a:b].strip():
                x[k] = _features(self.gains(b" " + raw[a:b] + b" "), self.weights)
        return 1 / (1 + np.exp(-np.clip(x @ self.curve, -500, 500)))


def _features(gains: np.ndarray, weights: np.ndarray) -> tuple[float, float, float]:
    return float(weights[gains].sum()), float(np.log1p(len(gains))), 1.0


def _logistic(a: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Coefficients by Newton steps with a small ridge; ``weight`` per row."""
    w = np.zeros(a.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        gradient = a.T @ (weight * (p - y)) + 1e-2 * w
        hessian = (a * (weight * p * (1 - p))[:, None]).T @ a + 1e-2 * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit_texts(toxic: list[str], ordinary: list[str], counts: tuple[int, int] | None = None) -> Model:
    """Model from labelled texts. ``counts`` are the toxic and ordinary rows the texts
    stand for (by default the texts themselves).

    With fewer than four texts in a class nothing can be learned: the weights
    are 0 and every score is the share of toxic texts (0 when there are none).
    """
    t, o = [_fold(x) for x in toxic], [_fold(x) for x in ordinary]
    counts = (len(t), len(o)) if counts is None else counts
    share = counts[0] / max(1, sum(counts))
    if min(len(t), len(o)) < 4:
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Model(b" ", b" ", (0.0,) * (GAINS[1] - GAINS[0] + 1),
                     (0.0, 0.0, float(np.log(share / (1 - share)))))
    counted = [[_contexts(raw) for raw in texts] for texts in (t, o)]
    size, none = GAINS[1] - GAINS[0] + 1, 1 - GAINS[0]
    seen: list[list[np.ndarray]] = [[], []]
    for k in (0, 1):
        gains = Gains(*_dictionaries(t[k::2], o[k::2], *(c[k::2] for c in counted)))
        for texts, found in zip((t, o), seen):
            found += [gains(raw) for raw in texts[1 - k::2]]
    hist = np.stack([np.bincount(np.concatenate(x), minlength=size) for x in seen]).astype(float)
    # windows without a gain are one kind; ratios shrink to the pooled share where
    # few windows have a gain
    hist = np.concatenate((hist[:, :none].sum(1, keepdims=True), hist[:, none:]), axis=1)
    pooled = hist.sum(0) / hist.sum()
    own = (hist + PRIOR_WINDOWS * pooled) / (hist.sum(1, keepdims=True) + PRIOR_WINDOWS)
    ratio = np.log(np.maximum(own[0], 1e-12) / np.maximum(own[1], 1e-12))
    weights = np.concatenate((np.full(none, min(ratio[0], 0.0)), np.maximum(ratio[1:], 0.0)))
    x = np.array([_features(g, weights) for group in seen for g in group])
    sizes = [len(seen[0]), len(seen[1])]
    y = np.repeat([1.0, 0.0], sizes)
    weight = np.repeat([share * sum(sizes) / sizes[0], (1 - share) * sum(sizes) / sizes[1]], sizes)
    return Model(*_dictionaries(t, o, *counted), tuple(weights.tolist()),
                 tuple(_logistic(x, y, weight).tolist()))


def _training_labels(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """``id`` and ``label`` of every labelled id that is not held out."""
    return (labels.where(labels[label_col].isin(0, 1) & labels[id_col].isNotNull()
                         & ~held_out(labels[id_col]))
            .groupBy(labels[id_col].alias("id")).agg(F.max(labels[label_col]).alias("label")))


def class_counts(labels: DataFrame, id_col: str = "doc_id", label_col: str = "toxic") -> tuple[int, int]:
    """Toxic and ordinary training rows, in the sample or not."""
    toxic = F.col("label") == 1
    row = _training_labels(labels, id_col, label_col).agg(
        F.count_if(toxic).alias("toxic"), F.count_if(~toxic).alias("ordinary")).first()
    return row.toxic, row.ordinary


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", label_col: str = "toxic") -> tuple[list, list]:
    """Texts of the sample: per class the rows with the smallest id hashes, of
    those whose id is not held out. At most ``SAMPLE_TOXIC`` and
    ``SAMPLE_ORDINARY`` rows of up to ``SAMPLE_BYTES`` bytes reach the driver."""
    own = _training_labels(labels, id_col, label_col).withColumn("h", F.xxhash64("id"))
    wanted = None
    for label, most in ((1, SAMPLE_TOXIC), (0, SAMPLE_ORDINARY)):
        part = own.where(F.col("label") == label).orderBy("h", "id").limit(most)
        wanted = part if wanted is None else wanted.unionByName(part)
    texts = (docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
             .where((F.octet_length("text") <= SAMPLE_BYTES) & (F.octet_length("text") > 0)))
    # the ids are bounded by the sample sizes, so they may be broadcast
    rows = (texts.join(F.broadcast(wanted), "id").groupBy("id")
            .agg(F.first("label").alias("label"), F.max("text").alias("text"), F.first("h").alias("h"))
            .collect())
    rows.sort(key=lambda r: (r.h, r.id))
    return [r.text for r in rows if r.label == 1], [r.text for r in rows if r.label == 0]


def held_out(id_column):
    """crc32 of the id as text, modulo 5, is 0."""
    return F.crc32(id_column.cast("string").cast("binary")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic") -> Model:
    sample = training_rows(docs, labels, id_col, text_col, label_col)
    return fit_texts(*sample, class_counts(labels, id_col, label_col))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Per input row: the id, ``score`` (0 to 1, higher: toxic is likelier) and
    ``predicted`` (1 from 0.5 on).

    NULL, empty or blank texts have no evidence and get the score of no windows.
    Repeated rows get a result each; an empty table gives none.
    """
    picked = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    id_type = picked.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            p = scorer.scores(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                ["id", "score", "predicted"])

    return (picked.mapInArrow(run, f"id {id_type}, score double, predicted int")
            .withColumnRenamed("id", id_col))


def accepted(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, whose score is below 0.5."""
    where = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            yield batch.filter(pa.array(scorer.scores(batch.column(where)) < 0.5))

    return docs.mapInArrow(run, docs.schema)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of ``documents``, scored by a model of its labelled rows."""
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")

"""Order-preserving packing of tokenized documents into fixed windows.

Each task reads its documents in the order of the table as one stream of tokens
(every document followed by its end id) and chooses where the windows are cut by
dynamic programming. Cuts are possible at document and sentence ends; a sentence
of over ``LONG_SENTENCE`` tokens may also be cut inside. With f[j] the least cost
of packing the stream up to cut j,

    f[j] = cut_cost[j] + min( size - p[j] + min over p[i] >= p[j] - size of (f[i] + p[i]),
                              min over powers of two k of f[i] with p[i] = p[j] - k )
                  + the cost of a window

The first part is a window padded to its full size: the inner minimum runs over a
sliding window of cuts, kept in a monotone queue, so each cut enters and leaves it
once. The second part are windows whose length is a power of two, which need no
padding. ``cut_cost`` is the truncation penalty: nothing at a document's end, some
tokens' worth at a sentence's end, more inside a sentence.

One pass, no shuffle. A task holds the stream of at most ``SEGMENT`` tokens and one
document: the windows of a segment are settled up to its cheapest late cut, what
stands behind it opens the next segment. Only the last window of a task is bound to
end with its stream.

Tokens come from the tokenizer's library. White space never joins with what stands
next to it (words are matched apart from it, and nothing composes with a space), so
a text's ids are those of its parts between spaces and line feeds, end to end; each
task keeps the ids of parts it has seen (``STORE_PARTS`` at most, then it starts
anew; results do not depend on it).
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from forecheck.llm.common import slices, table

SEQUENCE = 2048
END_ID = 1
SENTENCE_CUT = 8.0      # tokens of padding that a cut at a sentence's end is worth
INSIDE_CUT = 48.0       # the same for a cut inside a sentence
WINDOW_COST = 2.0       # of each window, so that equal paddings prefer fewer windows
LEAST_WINDOW = 64       # shortest window that is cut to a power of two on purpose
LONG_SENTENCE = 256
INSIDE_STEP = 64
SEGMENT = 1 << 18
STORE_PARTS = 1_200_000
GROUP_BYTES = 8 << 20

_MARK = "\0"
# byte-level spelling: a printable byte is its own character, the others follow from
# U+0100 on in order
_PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_SPELL = {b: 0x100 + k for k, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
_SPELLING = {chr(b): chr(c) for b, c in _SPELL.items()}
_TAIL = ".,;:!?"
_LATIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
_STOPS = (".", "!", "?", "…", "。", "！", "？")
_CLOSING = "\"')]}»”’"


class Parts:
    """Token ids of the parts of texts between spaces and line feeds.

    A part made of Latin letters and a tail of ASCII punctuation is two units, its
    lower-cased letters (the tokenizer lower-cases and takes letters apart) and its
    tail; any other part is one unit. The library sees each new unit once; words go to
    its model without the normalizers and the split rule, which they do not need.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # tasks are the parallelism
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_str(definition)
        self.whole.encode_special_tokens = True           # their strings are ordinary text
        # the same model for lower-cased words whose bytes are spelled out already
        plain = json.loads(definition) | {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}}
        self.plain = Tokenizer.from_str(json.dumps(plain))
        self.plain.encode_special_tokens = True
        self.clear()

    def clear(self) -> None:
        # nothing between two spaces; a line feed ends a sentence
        self.place = _Numbers({"": 0, "\n": 1})
        self.ends = np.array([False, True])
        self.offsets, self.ids = np.zeros(3, np.int64), np.zeros(0, np.uint32)
        self.unit = {"": 0}
        self.unit_offsets, self.unit_ids = np.zeros(2, np.int64), np.zeros(0, np.uint32)

    def _learn_units(self, new: list[str], tokenizer, spelled: list[str]) -> None:
        """One call for all: the units, as ``spelled``, with a mark between them."""
        def encode(text: str) -> np.ndarray:
            return np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

        mark = _MARK if tokenizer is self.whole else _SPELLING[_MARK]
        flat, sign = encode(f" {mark} ".join(spelled)), encode(mark)
        marks = np.flatnonzero(flat == sign[0]) if len(sign) == 1 and len(new) > 1 else flat[:0]
        if len(marks) == len(new) - 1:
            counts = np.diff(np.concatenate(([-1], marks, [len(flat)]))) - 1
            flat = np.delete(flat, marks)
        else:                                             # a unit holds the mark: one by one
            found = [encode(u) for u in spelled]
            counts, flat = np.array([len(x) for x in found], np.int64), np.concatenate(found)
        self.unit.update(zip(new, range(len(self.unit), len(self.unit) + len(new))))
        self.unit_offsets = _longer(self.unit_offsets, counts)
        self.unit_ids = np.concatenate((self.unit_ids, flat))

    def learn(self, new: list[str]) -> None:
        halves, words, stops = [], set(), np.empty(len(new), bool)
        for k, part in enumerate(new):
            word = part.rstrip(_TAIL)
            tail = part[len(word):]
            if word.isalpha() and (word.isascii() or _LATIN.fullmatch(word)):
                word = word.lower()
                words.add(word)
                halves += (word, tail)
                stops[k] = tail.endswith(_STOPS)
            else:
                halves += (part, "")
                stops[k] = part.rstrip(_CLOSING).endswith(_STOPS)
        known = self.unit
        fresh = [w for w in words if w not in known]
        if fresh:
            self._learn_units(fresh, self.plain, [
                w if w.isascii() else w.encode().decode("latin-1").translate(_SPELL) for w in fresh])
        rest = [u for u in set(halves) if u not in known]
        marked = [u for u in rest if _MARK in u]
        for units in ([u for u in rest if _MARK not in u], *([u] for u in marked)):
            if units:
                self._learn_units(units, self.whole, units)
        at = np.fromiter(map(self.unit.__getitem__, halves), np.int64, len(halves))
        ids, ends = _taken(self.unit_offsets, self.unit_ids, at)
        self.offsets = _longer(self.offsets, np.diff(ends[::2]))
        self.ids = np.concatenate((self.ids, ids))
        self.ends = np.concatenate((self.ends, stops))

    def _group(self, texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
        if len(self.place) > STORE_PARTS:
            self.clear()
        # ASCII letters lower-cased here (the tokenizer does so anyway): fewer parts
        parts = pc.split_pattern(pc.replace_substring(pc.ascii_lower(texts), "\n", " \n "), " ")
        coded = parts.flatten().dictionary_encode()
        names = coded.dictionary.to_pylist()
        known = len(self.place)
        place = np.fromiter(map(self.place.__getitem__, names), np.int64, len(names))
        if len(self.place) > known:
            self.learn([names[k] for k in np.flatnonzero(place >= known).tolist()])
        at = place[coded.indices.to_numpy()]
        ids, total = _taken(self.offsets, self.ids, at)
        ends = np.flatnonzero(self.ends[at])
        rows = parts.offsets.to_numpy() - parts.offsets[0].as_py()
        first, after = total[rows], total[ends + 1]
        cut = np.searchsorted(ends, rows)
        return [(ids[a:b], after[c:d] - a) for a, b, c, d in zip(
            first[:-1].tolist(), first[1:].tolist(), cut[:-1].tolist(), cut[1:].tolist())]

    def __call__(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, numbers of ids before each sentence end) of every whole text; NULL
        counts as empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        sizes = pc.binary_length(texts).to_numpy()
        offsets = np.concatenate(([0], np.cumsum(sizes)))
        for lo, hi in slices(offsets, GROUP_BYTES):
            if sizes[lo] > GROUP_BYTES:          # a long text is a slice of its own
                yield _joined([self._group(pa.array([x], pa.large_string()))[0]
                               for x in _text_pieces(texts[lo].as_py())])
            else:
                yield from self._group(texts.slice(lo, hi - lo))


def _longer(offsets: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return np.concatenate((offsets, offsets[-1] + np.cumsum(counts)))


def _taken(offsets: np.ndarray, values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lists ``at`` of a store of lists, end to end, and their offsets."""
    kind = pa.LargeListArray.from_arrays(pa.array(offsets), pa.array(values))
    found = kind.take(pa.array(at))
    return found.values.to_numpy(), found.offsets.to_numpy()


class _Numbers(dict):
    """Numbers keys in the order in which they are first asked for."""

    def __missing__(self, key):
        number = self[key] = len(self)
        return number


def _joined(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    base = np.cumsum([0, *(len(ids) for ids, _ in found)])
    return (np.concatenate([ids for ids, _ in found]),
            np.concatenate([ends + b for (_, ends), b in zip(found, base)]))


def _text_pieces(text: str) -> Iterator[str]:
    """The text in pieces that end at a space, to keep the lists of parts small."""
    lo = 0
    while lo <= len(text):
        hi = text.find(" ", lo + GROUP_BYTES)
        hi = len(text) if hi < 0 else hi
        yield text[lo:hi]
        lo = hi + 1


def cut_places(n_ids: int, ends: np.ndarray, size: int = SEQUENCE) -> tuple[np.ndarray, np.ndarray]:
    """Places (ids before the cut) where a document of ``n_ids`` ids, its end id
    included, may be cut, and the penalty of each; the last is its end."""
    ends = np.unique(ends[(ends > 0) & (ends < n_ids - 1)])
    marks = np.concatenate(([0], ends, [n_ids]))
    gaps = np.diff(marks)
    step = min(INSIDE_STEP, size)
    extra = np.where(gaps > min(LONG_SENTENCE, size), (gaps - 1) // step, 0)
    first = np.repeat(marks[:-1], extra)
    steps = np.arange(int(extra.sum())) - np.repeat(np.cumsum(extra) - extra, extra) + 1
    inside = first + steps * step
    places = np.concatenate((ends, inside, [n_ids]))
    costs = np.concatenate((np.full(len(ends), SENTENCE_CUT), np.full(len(inside), INSIDE_CUT), [0.0]))
    order = np.argsort(places, kind="stable")
    return places[order], costs[order]


def best_cuts(places: np.ndarray, costs: np.ndarray, size: int = SEQUENCE,
              to_end: bool = True) -> tuple[list[int], float]:
    """Window ends (ascending, as places) of least total cost and that cost.

    ``places`` are the possible cuts after 0, ascending and at most ``size``
    apart. The windows end at the last place, or, without ``to_end``, at the
    cheapest of the places in the last ``size``.
    """
    p = np.concatenate(([0], places))
    n, last = len(p), int(p[-1])
    # for every cut the earlier cuts that lie a power of two before it
    at = np.full(last + 1, -1, np.int64)
    at[p] = np.arange(n)
    exact: dict[int, list[int]] = {}
    k = LEAST_WINDOW
    while k < size:
        to = np.flatnonzero(p >= k)
        source = at[p[to] - k]
        for j, i in zip(to[source >= 0].tolist(), source[source >= 0].tolist()):
            exact.setdefault(j, []).append(i)
        k *= 2
    # the queue: cuts with ascending f + p, as three lists read from ``head`` on
    queue, places_in, keys = [0], [0], [0.0]
    head, f, back = 0, [0.0], [0]
    for j, here, cost in zip(range(1, n), p[1:].tolist(), costs.tolist()):
        while places_in[head] < here - size:
            head += 1
        i = queue[head]
        least = keys[head] + size - here
        if j in exact:
            for e in exact[j]:
                if f[e] < least:
                    least, i = f[e], e
        least += WINDOW_COST + cost
        f.append(least)
        back.append(i)
        key = least + here
        while len(keys) > head and keys[-1] > key:
            del queue[-1], places_in[-1], keys[-1]
        queue.append(j)
        places_in.append(here)
        keys.append(key)
    j = n - 1
    if not to_end:
        late = int(np.searchsorted(p, last - size, side="right"))
        j = min(range(max(late, 1), n), key=f.__getitem__)
    total, cuts = f[j], []
    while j:
        cuts.append(int(p[j]))
        j = back[j]
    return cuts[::-1], total


class Stream:
    """The documents of a task that are not packed yet, and its windows so far."""

    def __init__(self, size: int):
        self.size, self.windows = size, 0
        self.docs: list[tuple] = []       # (row's carried value, ids, ids packed before)
        self.places: list[np.ndarray] = []
        self.costs: list[np.ndarray] = []
        self.length = 0

    def add(self, carried, ids: np.ndarray, ends: np.ndarray) -> None:
        places, costs = cut_places(len(ids), ends, self.size)
        self.docs.append((carried, ids, 0))
        self.places.append(places + self.length)
        self.costs.append(costs)
        self.length += len(ids)

    def settle(self, to_end: bool) -> Iterator[tuple]:
        """Pieces (carried, start, length, ids, doc_tokens, window, offset) of the
        windows that are settled; the rest stays in the stream."""
        if not self.length:
            return
        places, costs = np.concatenate(self.places), np.concatenate(self.costs)
        cuts, _ = best_cuts(places, costs, self.size, to_end)
        lo, d, begin = 0, 0, 0            # begin: place of document d's first unpacked id
        for hi in cuts:
            at = lo
            while at < hi:
                carried, ids, start = self.docs[d]
                n = min(len(ids) - start, hi - at)
                yield carried, start, n, ids[start:start + n], len(ids), self.windows, at - lo
                at += n
                if start + n == len(ids):
                    d += 1
                else:
                    self.docs[d] = (carried, ids, start + n)
            self.windows += 1
            lo = hi
        self.docs = self.docs[d:]
        left = places > lo
        self.places, self.costs = [places[left] - lo], [costs[left]]
        self.length -= lo


_PARTS: dict[str, Parts] = {}


def _parts(definition: str) -> Parts:
    """The worker's store for a tokenizer, built once per process."""
    if definition not in _PARTS:
        _PARTS.clear()
        _PARTS[definition] = Parts(definition)
    return _PARTS[definition]


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         size: int = SEQUENCE, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """Pack every row's whole text into sequences of at most ``size`` tokens (a
    power of two). Call ``common.ship`` first where this package is not installed
    on the executors; queries do so through ``common.table``.

    Returns one row per piece: id, ``start`` (the document's ids before the
    piece), ``length``, ``ids_crc32`` (of the little-endian 32-bit ids),
    ``doc_tokens`` (with the end id), ``sequence_id``, ``offset`` (in the
    sequence, gapless from 0), ``padding`` (of the whole sequence, 0 at a power
    of two) and, with ``with_ids``, ``ids`` (array of int).

    NULL or empty text: the end id alone. Rows with a NULL or repeated id are
    documents of their own. An empty table gives no pieces; other columns are not
    read. Sequences follow the order of the rows in each partition, and their ids
    hold the partition's number: write the result before using it twice if the
    rows come in an order that may change.
    """
    if size < 1 or size & (size - 1):
        raise ValueError("the size of a sequence must be a power of two")
    picked = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    id_type = picked.schema["id"].dataType.simpleString()
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = f.read()
    # the tokenizer's file (a fixed file, under 2 MB), once per executor
    shared = docs.sparkSession.sparkContext.broadcast(definition)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, stream = _parts(shared.value), Stream(size)
        prefix = TaskContext.get().partitionId() << 32
        id_kind = None

        def settled(to_end: bool) -> Iterator[pa.RecordBatch]:
            rows = list(stream.settle(to_end))
            if not rows:
                return
            used: dict[int, int] = {}
            for r in rows:
                used[r[5]] = used.get(r[5], 0) + r[2]
            pads = {w: 0 if not n & (n - 1) else size - n for w, n in used.items()}
            whole = [r[3].astype("<u4") for r in rows]
            columns = [
                pa.array([r[0] for r in rows], id_kind),
                *(pa.array([r[k] for r in rows], pa.int64()) for k in (1, 2)),
                pa.array([zlib.crc32(x.tobytes()) for x in whole], pa.int64()),
                pa.array([r[4] for r in rows], pa.int64()),
                pa.array([prefix + r[5] for r in rows], pa.int64()),
                pa.array([r[6] for r in rows], pa.int64()),
                pa.array([pads[r[5]] for r in rows], pa.int64())]
            if with_ids:
                columns.append(pa.ListArray.from_arrays(
                    pa.array(np.cumsum([0, *map(len, whole)]), pa.int32()),
                    pa.array(np.concatenate(whole).astype(np.int32), pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names)

        end = np.array([end_id], np.uint32)
        for batch in batches:
            id_kind = batch.schema.field(0).type
            for carried, (ids, ends) in zip(batch.column(0).to_pylist(), parts(batch.column(1))):
                stream.add(carried, np.concatenate((ids, end)), ends)
                if stream.length >= SEGMENT:
                    yield from settled(False)
        yield from settled(True)

    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
             "padding", *["ids"] * with_ids]
    schema = (f"id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, "
              "sequence_id long, offset long, padding long" + ", ids array<int>" * with_ids)
    return picked.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` by the 49k word tokenizer."""
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"),
                public_tokenizers.path("word_bpe_49k.json"), with_ids=False)

"""Byte-level BPE encoding and decoding by corpus-level merge replay.

Each task takes the distinct pretokens ("words") of a slice of the corpus that
it has not encoded before, lays their bytes out as one array of tokens with
links to the left and right neighbour, and builds an inverted index from merge
rank (the token pair) to the positions of that pair. Merges are then replayed
in rank order: all positions of the lowest pending rank are merged at once, and
only the pairs to the left and right of a merge are looked up again and put into
the index. A text's ids are the ids of its words in order.

A merge may create a neighbour pair of a lower rank than its own; for those
ranks only the first occurrence in each word is merged before the index is
asked again, so every word sees exactly the greedy lowest-rank-first order.

Words are told apart by a 64-bit hash of their bytes; every text is decoded from
its ids and compared with its source, so a collision could not pass unseen.

One pass over the rows, no shuffle. A slice is 4 MB of text; the store of
encoded words is emptied when it passes ``STORE_WORDS`` words (it saves work
only, results do not depend on it), so memory stays bounded.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from forecheck.llm.common import RangeHash, slices, table, utf8

STORE_WORDS = 500_000
SLICE_BYTES = 4 << 20
_NONE = np.int32(2**31 - 1)


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Merges:
    """Vocabulary tables: pair -> merged token, byte -> token, token -> bytes."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs, descending = {}, set()
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is None or b is None:
                    continue
                pairs[a << 32 | b] = rank
                for part, text in ((a, token[:cut]), (b, token[cut:])):
                    if len(text) > 1 and part > rank:
                        descending.add(part)
        self.keys = np.array(sorted(pairs), np.int64)
        self.merged = np.array([pairs[k] for k in self.keys.tolist()], np.int32)
        self.descending = frozenset(descending)
        self.of_byte = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        size = max(ranks.values()) + 1
        tokens = [b""] * size
        for token, rank in ranks.items():
            tokens[rank] = token
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.begins = np.concatenate(([0], np.cumsum(self.lengths)))[:-1]
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.texts = np.array([str(i) for i in range(size)], object)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``_NONE`` where it has no merge."""
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.merged[at], _NONE)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Replay all merges over words laid end to end (none of them empty);
        returns (tokens, number of tokens of each word)."""
        n = len(data)
        token = self.of_byte[data]
        word = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        after = np.arange(1, n + 1)
        before = np.arange(-1, n - 1)
        after[offsets[1:] - 1] = n                     # n: no right neighbour
        before[offsets[:-1]] = -1
        live = np.ones(n, bool)
        pair = np.full(n, _NONE, np.int32)
        inner = np.flatnonzero(after < n)
        pair[inner] = self.rank(token[inner], token[inner + 1])
        at = np.flatnonzero(pair != _NONE)
        at = at[np.argsort(pair[at], kind="stable")]
        starts = np.flatnonzero(np.diff(pair[at], prepend=-1))
        index: dict[int, list] = defaultdict(list)     # rank -> arrays or positions
        for lo, hi in zip(starts.tolist(), [*starts[1:].tolist(), len(at)]):
            index[int(pair[at[lo]])] = at[lo:hi].tolist()
        heap = sorted(index)

        def look_up(places: np.ndarray, right: np.ndarray) -> None:
            rank = self.rank(token[places], token[right])
            pair[places] = rank
            some = rank != _NONE
            for r, p in zip(rank[some].tolist(), places[some].tolist()):
                if r not in index:
                    heapq.heappush(heap, r)
                index[r].append(p)

        while heap:
            rank = heapq.heappop(heap)
            at = np.sort(np.array(index.pop(rank), np.int64))
            ok = live[at] & (pair[at] == rank)
            ok[1:] &= at[1:] != at[:-1]
            at = at[ok]
            if not len(at):
                continue
            if len(at) > 1:
                if rank in self.descending:
                    first = np.ones(len(at), bool)
                    first[1:] = word[at[1:]] != word[at[:-1]]
                    later = at[~first]
                    at = at[first]
                    if len(later):
                        index[rank] = later.tolist()
                        heapq.heappush(heap, rank)
                else:
                    # of overlapping occurrences every second one is merged
                    joined = np.zeros(len(at), bool)
                    joined[1:] = after[at[:-1]] == at[1:]
                    place = np.arange(len(at))
                    run = np.maximum.accumulate(np.where(joined, 0, place))
                    at = at[(place - run) % 2 == 0]
            gone = after[at]
            token[at] = rank
            live[gone] = False
            pair[gone] = _NONE
            right = after[gone]
            after[at] = right
            has = right < n
            before[right[has]] = at[has]
            pair[at[~has]] = _NONE
            look_up(at[has], right[has])
            left = before[at]
            has = left >= 0
            look_up(left[has], at[has])
        keep = np.flatnonzero(live)
        return token[keep], np.bincount(word[keep], minlength=len(offsets) - 1)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of the ids end to end, byte offsets of each id)."""
        return gather(self.bytes, self.begins[ids], self.lengths[ids])


def gather(values: np.ndarray, begins: np.ndarray, lengths: np.ndarray):
    """Concatenate the slices [begin, begin + length) of ``values``."""
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    return values[np.repeat(begins - offsets[:-1], lengths) + np.arange(offsets[-1])], offsets


class Splitter:
    """Pretokens of the published split rule (``public_tokenizers.PATTERN``), as
    boundaries over a whole slice of texts instead of one regex match at a time.

    The rule: contractions (``'s 't 're 've 'm 'll 'd``); runs of letters, of
    numbers, or of other signs, each with one space before it if there is one;
    runs of white space, without the last character when a word follows.
    """

    LETTER, NUMBER, SPACE, OTHER = range(4)

    def __init__(self):
        # class of each code point, from the regex library's Unicode tables
        every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        self.kind = np.full(0x110000, self.OTHER, np.uint8)
        for kind, pattern in ((self.LETTER, r"\p{L}+"), (self.NUMBER, r"\p{N}+"),
                              (self.SPACE, r"\s+")):
            for found in regex.finditer(pattern, every):
                run = np.array([ord(c) for c in found.group()])
                self.kind[run] = kind

    def __call__(self, data: np.ndarray, offsets: np.ndarray):
        """(start byte, end byte) of each pretoken and its number in each row;
        pretokens never cross rows."""
        if not len(data):
            empty = np.zeros(0, np.int64)
            return empty, empty, np.zeros(len(offsets), np.int64)
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        code = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        kind = self.kind[code]
        n = len(code)
        rows = np.searchsorted(lead, offsets)          # first character of each row
        fresh = np.zeros(n + 1, bool)                  # a row begins (or ends) here
        fresh[rows] = True
        start = fresh[:n].copy()
        start[1:] |= kind[1:] != kind[:-1]
        space = kind == self.SPACE
        # the last white space before a word stands alone, or joins it if it is " "
        last = np.zeros(n, bool)
        last[:-1] = space[:-1] & ~space[1:] & ~fresh[1:n]
        start |= last
        joins = np.flatnonzero(last & (code == 0x20)) + 1
        start[joins] = False
        # contractions: an apostrophe that begins a run of other signs
        mark = np.flatnonzero(start & (code == 0x27))
        if len(mark):
            padded = np.concatenate((code, np.zeros(2, np.uint32)))
            c1, c2 = padded[mark + 1], padded[mark + 2]
            ends1, ends2 = fresh[mark + 1], fresh[np.minimum(mark + 2, n)]
            one = ~ends1 & np.isin(c1, [ord(c) for c in "stmd"])
            two = ~ends1 & ~ends2 & (((c1 == ord("r")) & (c2 == ord("e")))
                                     | ((c1 == ord("v")) & (c2 == ord("e")))
                                     | ((c1 == ord("l")) & (c2 == ord("l"))))
            for hit, size in ((one, 2), (two & ~one, 3)):
                at = mark[hit]
                start[at + 1] = False
                after = at + size
                start[after[after < n]] = True
        begin = np.flatnonzero(start)
        bounds = np.concatenate((lead[begin], [len(data)]))
        return bounds[:-1], bounds[1:], np.searchsorted(begin, rows)


class Encoder:
    """Encodes texts; keeps the ids of words seen before, by their hash."""

    def __init__(self, merges: Merges):
        self.merges, self.split = merges, Splitter()
        self.clear()

    def clear(self) -> None:
        self.hashes = np.zeros(0, np.uint64)           # sorted
        self.begins = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def _learn(self, hashes: np.ndarray, data: np.ndarray, lengths: np.ndarray) -> None:
        ids, counts = self.merges.encode(data, np.concatenate(([0], np.cumsum(lengths))))
        begins = len(self.ids) + np.cumsum(counts) - counts
        self.ids = np.concatenate((self.ids, ids))
        place = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, place, hashes)
        self.begins = np.insert(self.begins, place, begins)
        self.counts = np.insert(self.counts, place, counts)

    def __call__(self, data: np.ndarray, offsets: np.ndarray):
        """Yields (first row, last row, ids end to end, offsets of each row)."""
        if len(self.hashes) > STORE_WORDS:
            self.clear()
        parts, new = [], []
        for lo, hi in slices(offsets):
            own = data[offsets[lo]:offsets[hi]]
            start, end, rows = self.split(own, offsets[lo:hi + 1] - offsets[lo])
            words, first, which = np.unique(RangeHash(own)(start, end), return_index=True,
                                            return_inverse=True)
            at = np.minimum(np.searchsorted(self.hashes, words), len(self.hashes) - 1)
            fresh = first if not len(self.hashes) else first[self.hashes[at] != words]
            hashes = words if not len(self.hashes) else words[self.hashes[at] != words]
            lengths = end[fresh] - start[fresh]
            new.append((hashes, gather(own, start[fresh], lengths)[0], lengths))
            parts.append((lo, hi, words, which, rows))
        hashes, first = np.unique(np.concatenate([x[0] for x in new] or [self.hashes[:0]]),
                                  return_index=True)
        if len(hashes):
            lengths = np.concatenate([x[2] for x in new])
            begins = np.cumsum(lengths) - lengths
            taken, _ = gather(np.concatenate([x[1] for x in new]), begins[first], lengths[first])
            self._learn(hashes, taken, lengths[first])
        del new
        for lo, hi, words, which, rows in parts:
            at = np.searchsorted(self.hashes, words)[which]
            ids, ends = gather(self.ids, self.begins[at], self.counts[at])
            yield lo, hi, ids, ends[rows]


_ENCODERS: dict[str, Encoder] = {}


def _encoder(key: str, ranks: dict[bytes, int]) -> Encoder:
    """The worker's encoder for a vocabulary, built once per process."""
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(Merges(ranks))
    return _ENCODERS[key]


def encode(docs: DataFrame, rank_path: str, id_col: str = "doc_id", text_col: str = "text",
           with_ids: bool = True) -> DataFrame:
    """Encode every row's whole text without special tokens, then decode the ids.
    A decoded text that differs from its source is an error.

    Returns per input row: id, ``n_tokens``, ``ids_sha256`` (decimal ids joined
    by commas), ``decoded_sha256`` (bytes of the decoded ids) and, with
    ``with_ids``, ``ids`` (array of int) for training. NULL or empty text: no
    tokens and the digests of the empty string. Repeated rows give a result
    each; an empty table gives none; other columns are not read.
    """
    picked = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    id_type = picked.schema["id"].dataType.simpleString()
    ranks = read_ranks(rank_path)
    key = hashlib.sha256(repr(sorted(ranks.items())).encode()).hexdigest()
    # one broadcast of the vocabulary (a fixed file, about 1 MB), not one per task
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(key, shared.value)
        sha = hashlib.sha256
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for first, last in slices(offsets, SLICE_BYTES):
                own, cut = data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
                for lo, hi, ids, ends in encoder(own, cut):
                    decoded, places = encoder.merges.decode(ids)
                    if not np.array_equal(decoded, own[cut[lo]:cut[hi]]):
                        raise ValueError("decoded bytes differ from the text")
                    names = encoder.merges.texts[ids]
                    spans = list(zip(ends[:-1].tolist(), ends[1:].tolist()))
                    columns = [
                        batch.column(0).slice(first + lo, hi - lo),
                        pa.array(np.diff(ends), pa.int64()),
                        pa.array([sha(",".join(names[a:b]).encode()).hexdigest()
                                  for a, b in spans], pa.string()),
                        pa.array([sha(decoded[places[a]:places[b]]).hexdigest()
                                  for a, b in spans], pa.string())]
                    if with_ids:
                        columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                                                pa.array(ids, pa.int32())))
                    yield pa.RecordBatch.from_arrays(columns, names_out)

    names_out = ["id", "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids]
    schema = (f"id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string"
              + ", ids array<int>" * with_ids)
    return picked.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, rank_path: str, id_col: str = "doc_id",
           ids_col: str = "ids", out: str = "bytes") -> DataFrame:
    """Bytes of each row's ids (NULL ids: empty). Decode as UTF-8 for the text."""
    picked = encoded.select(encoded[id_col].alias("id"), encoded[ids_col].alias("ids"))
    id_type = picked.schema["id"].dataType.simpleString()
    shared = encoded.sparkSession.sparkContext.broadcast(read_ranks(rank_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = {rank: token for token, rank in shared.value.items()}
        for batch in batches:
            texts = [b"".join([tokens[i] for i in ids or ()])
                     for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.binary())], ["id", "bytes"])

    return (picked.mapInArrow(run, f"id {id_type}, bytes binary")
            .withColumnsRenamed({"id": id_col, "bytes": out}))


def op5_bpe_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` by the multilingual 50k rank file."""
    import public_tokenizers

    return encode(table(spark, sf_dir, "documents"),
                  public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), with_ids=False)

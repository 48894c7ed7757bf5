"""Lexical search, hard negatives and packing against brute force."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from forecheck.llm import hard_negatives, lexical_search, packing

# --- lexical search --------------------------------------------------------

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _terms(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return _WORD.findall(lower)


def _ranked(docs, items, k):
    """(item_id, rank, doc_id, score) straight from the rule."""
    bags = [(i, _terms(t)) for i, t in docs]
    n_docs, words = sum(bool(w) for _, w in bags), sum(len(w) for _, w in bags)
    df = Counter(t for _, w in bags for t in set(w))
    out = []
    for item, text in items:
        scored = []
        for doc, w in bags:
            tf, m = Counter(w), 100 - 25 + (25 * len(w) * n_docs) // max(words, 1)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * ((10**9 * tf[t]) // (1000 * tf[t] + 12 * m)) for t in _terms(text) if tf[t])
            if score > 0:
                scored.append((-score, doc is None, doc))
        scored.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, r, d, -s) for r, (s, _, d) in enumerate(scored[:k], 1)]
    return sorted(out, key=str)


def _found(docs, items, k=20):
    return sorted(map(tuple, lexical_search.search(docs, items, k=k).collect()), key=str)


@pytest.mark.parametrize("seed,k", [(1, 20), (2, 3)])
def test_search_equals_the_rule(spark, seed, k):
    rng = random.Random(seed)
    vocabulary = ["Alpha", "beta", "gamma", "déjà", "vu", "x9", "日本", "the", "THE", "a-b", "omega"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, n)))
    docs = [(i, text(12)) for i in range(150)]
    # a third of all rows is one text, ids in no order, some repeated, one missing
    docs += [(1000 - i, "the alpha beta") for i in range(80)] + [(7, text(5)), (7, text(5)), (None, "omega vu"),
                                                                  (3000, None), (3001, ""), (3002, "---")]
    items = [(i, text(8)) for i in range(12)] + [(3, "omega omega the"), (None, "vu"), (99, None), (98, "nowhere")]
    got = _found(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5),
                 spark.createDataFrame(items, "item_id bigint, text string"), k)
    assert got == _ranked(docs, items, k) and got


def test_search_in_blocks_of_items(spark, monkeypatch):
    """Blocks of items (and of a score matrix) change nothing."""
    rng = random.Random(5)
    words = [f"w{k}" for k in range(30)]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(1, 15)))) for i in range(120)]
    items = [(i, " ".join(rng.choices(words, k=4))) for i in range(30)]
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    q = spark.createDataFrame(items, "item_id bigint, text string")
    monkeypatch.setattr(lexical_search, "BLOCK_ITEMS", 12)
    monkeypatch.setattr(lexical_search, "SCORE_CELLS", 64)
    assert _found(d, q) == _ranked(docs, items, 20)


def test_search_of_odd_and_no_rows(spark, odd_docs, no_docs):
    items = odd_docs.select(F.col("doc_id").alias("item_id"), "text", "score", F.lit(1).alias("key"),
                            F.lit(1).alias("block"))
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert _found(odd_docs, items) == _ranked(rows, rows, 20)
    assert lexical_search.search(no_docs, items).count() == 0
    empty = lexical_search.search(odd_docs, items.limit(0))
    assert empty.count() == 0 and empty.columns == ["item_id", "rank", "doc_id", "score"]


def test_words_are_told_apart_by_their_bytes(monkeypatch):
    """Equal hashes of different words do not make them one."""
    known = lexical_search.Vocabulary([b"ab", b"cd"])
    fake = known.hashes.copy()
    monkeypatch.setattr(lexical_search, "RangeHash", lambda data: lambda a, b: np.full(len(a), fake[0]))
    data = np.frombuffer(b"ab xy cd", np.uint8)
    first = int(known.order[0])
    got = known.find(data, np.array([0, 3, 6]), np.array([2, 5, 8]))
    assert got.tolist() == [first if known.order[0] == 0 else -1, -1, first if known.order[0] == 1 else -1]


# --- hard negatives ----------------------------------------------------------

def _mined(rows, anchor, n_pos=5, n_neg=10):
    """(anchor, positive, rank, negative, positive score, negative score) by full scores."""
    part = [(i, y, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, y in rows
            if y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    key = lambda x: (-x[0], x[1] is None, x[1] or 0)
    out = []
    for k, (i, y, q) in enumerate(part):
        if not anchor(i):
            continue
        others = [(dot(q, v), j, z) for m, (j, z, v) in enumerate(part) if m != k]
        for p, pid, _ in sorted((o for o in others if o[2] == y), key=key)[:n_pos]:
            inside = sorted((o for o in others if o[2] != y and 30 * p <= 100 * o[0] <= 90 * p), key=key)[:n_neg]
            out += [(i, pid, r, j, p, s) for r, (s, j, _) in enumerate(inside, 1)]
    return sorted(out, key=str)


def _vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")


@pytest.mark.parametrize("seed", [1, 2])
def test_hard_negatives_equal_full_scores(spark, seed, monkeypatch):
    rng = np.random.default_rng(seed)
    monkeypatch.setattr(hard_negatives, "LEAST_BLOCK_ROWS", 20)
    if seed == 2:
        monkeypatch.setattr(hard_negatives, "GROUP_ANCHORS", 3)
        monkeypatch.setattr(hard_negatives, "SCAN_STEPS", (1, 2, 3, 5, 8))
    rows = [(i, rng.normal(0, 0.1, 12).tolist(), int(rng.integers(0, 3))) for i in range(300)]
    # a third of the rows is one vector of one label; ties everywhere, repeated rows and ids
    rows += [(1000 + i, rows[0][1], 1) for i in range(120)] + [rows[10], rows[10], (20, rows[30][1], 2)]
    rows += [(None, rows[5][1], 0), (5000, None, 1), (5001, rows[1][1], None), (5002, [0.1, None] * 6, 0),
             (5003, [0.1, float("nan")] * 6, 0), (5004, [float("inf")] * 12, 1), (5010, [], 2), (5020, [0.3, 0.1], 2)]
    got = hard_negatives.mine(_vectors(spark, rows), F.col("id") % 10 == 0)
    want = _mined(rows, lambda i: i is not None and i % 10 == 0)
    assert sorted(map(tuple, got.collect()), key=str) == want and len(want) > 500


def test_hard_negatives_of_no_rows_and_large_numbers(spark):
    none = hard_negatives.mine(_vectors(spark, []), F.col("id") % 10 == 0)
    assert none.count() == 0 and none.columns == ["anchor_id", "positive_id", "rank", "negative_id",
                                                  "positive_score", "negative_score"]
    # beyond exact doubles, within 64 bits
    rows = [(i, [float(2**21 + 3 * i), 1.0], i % 2) for i in range(40)]
    got = hard_negatives.mine(_vectors(spark, rows).withColumn("row", F.lit(1)).withColumn("block", F.lit("x")),
                              F.col("id") % 10 == 0, window=(90, 110))
    dots = {(r.anchor_id, r.negative_id): r.negative_score for r in got.collect()}
    quantized = {i: [math.floor(256 * x) for x in v] for i, v, _ in rows}
    assert dots and all(s == sum(a * b for a, b in zip(quantized[i], quantized[j])) for (i, j), s in dots.items())
    huge = _vectors(spark, [(i, [3e13, 1.0], i % 2) for i in range(4)])
    with pytest.raises(Exception, match="64-bit"):
        hard_negatives.mine(huge, F.col("id") == 0).collect()


def test_bounds_prune_and_lose_nothing():
    """Rows leave before all dimensions are read; what is left is exact."""
    rng = np.random.default_rng(3)
    v = np.floor(256 * rng.normal(0, 0.1, (4000, 64))).astype(np.int64)
    block, seen = hard_negatives.Block(v, v[:8]), []
    scan = block.scan

    def counted(anchor, bitmap, prune):
        return scan(anchor, bitmap, lambda r, lo, hi: (seen.append(len(r)), prune(r, lo, hi))[1])

    block.scan = counted
    ids = rng.permutation(4000)
    for q in v[:8]:
        rows, score = hard_negatives.nearest(block, q, np.ones(4000, bool), ids, 5)
        full = v @ q
        order = np.lexsort((ids, -full))[:5]
        assert rows.tolist() == order.tolist() and score.tolist() == full[order].tolist()
    assert sum(seen[6::7]) < 0.25 * 8 * 4000


# --- packing -------------------------------------------------------------------

@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return path, t


def _odd_texts(seed, n):
    rng = random.Random(seed)
    pieces = ["a", "É", "ß", "'s", "'", "\0", " ", "  ", "\n", "\t", " ", "́", "é", "1", "½", "²",
              "日本", "!", ".", "<|endoftext|>", "\x1c", "\x85", "İ", "Σ", "ς", "ﬁ", "_", "-", "'LL", " ",
              "\U0001F600", "Ⅷ", "ª", "µ", "word.", "Word", "Ā", "don't"]
    return ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_ids_equal_the_library(tokenizer, monkeypatch):
    path, library = tokenizer
    texts = _odd_texts(3, 1500) + [None, "", " ", "\n\n", "x" * 3000, "one two. " * 2000]
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    with open(path) as f:
        definition = f.read()
    for size, most in ((8 << 20, 10**6), (64, 50)):     # pieces of texts, a store that empties
        monkeypatch.setattr(packing, "GROUP_BYTES", size)
        monkeypatch.setattr(packing, "STORE_PARTS", most)
        parts = packing.Parts(definition)
        got = list(parts(pa.array(texts, pa.string())))
        assert [ids.tolist() for ids, _ in got] == want
        assert all(((e >= 0) & (e <= len(i))).all() and (np.diff(e) >= 0).all() for i, e in got)


def _least(places, costs, size, to_end):
    """Least cost by trying every pair of cuts."""
    p = [0, *places]
    f = [0.0] + [math.inf] * len(places)
    for j in range(1, len(p)):
        for i in range(j):
            n = p[j] - p[i]
            if n <= size:
                exact = n >= packing.LEAST_WINDOW and n & (n - 1) == 0
                f[j] = min(f[j], f[i] + (0 if exact else size - n) + packing.WINDOW_COST + costs[j - 1])
    return f[-1] if to_end else min(f[j] for j in range(1, len(p)) if p[j] > p[-1] - size)


@pytest.mark.parametrize("to_end", [True, False])
def test_cuts_have_the_least_cost(to_end, monkeypatch):
    monkeypatch.setattr(packing, "LEAST_WINDOW", 4)
    rng = random.Random(7)
    for _ in range(150):
        size = rng.choice([16, 32, 64])
        places = np.cumsum([rng.randint(1, size) for _ in range(rng.randint(1, 60))])
        costs = np.array([rng.choice([0.0, 8.0, 48.0]) for _ in places])
        cuts, total = packing.best_cuts(places, costs, size, to_end)
        assert total == _least(places.tolist(), costs.tolist(), size, to_end)
        ends = [0, *cuts]
        assert set(cuts) <= set(places.tolist()) and all(0 < b - a <= size for a, b in zip(ends, ends[1:]))
        assert not to_end or cuts[-1] == places[-1]


def _check_pieces(rows, want, size):
    """Every id in exactly one piece, sequences gapless; returns the padding's share."""
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for doc, ids in want.items():
        own = sorted(docs.pop(doc), key=lambda r: r.start)
        assert [r.start for r in own] == np.cumsum([0, *(r.length for r in own)])[:-1].tolist()
        assert sum(r.length for r in own) == len(ids) and {r.doc_tokens for r in own} == {len(ids)}
        for r in own:
            part = ids[r.start:r.start + r.length]
            assert r.length > 0 and r.ids == part
            assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
    assert not docs
    padding = 0
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        n = sum(r.length for r in own)
        assert [r.offset for r in own] == np.cumsum([0, *(r.length for r in own)])[:-1].tolist() and n <= size
        assert {r.padding for r in own} == {0 if n & (n - 1) == 0 else size - n}
        padding += own[0].padding
    return padding / (padding + sum(map(len, want.values())))


def test_packing_keeps_every_id(spark, tokenizer, monkeypatch):
    path, library = tokenizer
    rng = random.Random(2)
    sentence = lambda: " ".join(rng.choice(["Lorem", "ipsum", "dolor", "été"]) for _ in range(rng.randint(1, 30))) + "."  # noqa: E731,E501
    texts = [" ".join(sentence() for _ in range(rng.randint(0, 60))) for _ in range(300)] + _odd_texts(4, 50)
    texts += [None, "", "word " * 9000]                   # no sentence ends in the long one
    want = {i: [*library.encode(t or "", add_special_tokens=False).ids, 1] for i, t in enumerate(texts)}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3, "doc_id")
    share = _check_pieces(packing.pack(docs, path).collect(), want, 2048)
    assert share < 0.05
    share = _check_pieces(packing.pack(docs, path, size=64).collect(), want, 64)
    with pytest.raises(ValueError, match="power of two"):
        packing.pack(docs, path, size=100)


def test_packing_in_segments(tokenizer, monkeypatch):
    """A stream that is settled piece by piece keeps its order and every id."""
    rng = random.Random(6)
    stream, out, docs = packing.Stream(32), [], []
    for k in range(400):
        ids = np.array([rng.randint(2, 99) for _ in range(rng.randint(0, 90))] + [1], np.uint32)
        docs.append(ids.tolist())
        stream.add(k, ids, np.array(sorted(rng.sample(range(len(ids) + 1), min(3, len(ids))))))
        if stream.length >= 200:
            out += stream.settle(False)
    out += stream.settle(True)
    assert stream.length == 0 and not list(stream.settle(True))
    assert [i for r in out for i in r[3].tolist()] == [i for d in docs for i in d]
    assert [r[5] for r in out] == sorted(r[5] for r in out)


def test_packing_of_odd_and_no_rows(spark, tokenizer, odd_docs, no_docs):
    path, library = tokenizer
    rows = packing.pack(odd_docs, path).collect()
    want = Counter(len(library.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in odd_docs.collect())
    assert Counter(r.doc_tokens for r in rows if r.start == 0) == want
    assert sum(r.length for r in rows) == sum(n * k for n, k in want.items())
    assert packing.pack(no_docs, path).count() == 0

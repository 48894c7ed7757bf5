"""Row-wise operators: repetition, byte-level BPE, license scan, toxicity."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from forecheck.llm import bpe_replay, license_scan, repetition, toxicity
from forecheck.llm.common import RangeHash, utf8, word_spans


# --- repetition ------------------------------------------------------------

def test_longest_repeats_against_brute_force():
    rng = np.random.default_rng(5)
    for _ in range(150):
        n, kinds = int(rng.integers(1, 45)), int(rng.integers(1, 4))
        rows = np.unique(np.sort(rng.integers(0, 3, n)), return_inverse=True)[1].astype(np.int64)
        words = rng.integers(0, kinds, n).astype(np.uint64)
        got = repetition.longest_repeats(words, rows)
        for i in range(n):
            best = 0
            for j in range(n):
                k = 0
                while (i != j and max(i, j) + k < n and rows[i + k] == rows[j + k] == rows[i] == rows[j]
                       and words[i + k] == words[j + k]):
                    k += 1
                best = max(best, k)
            assert got[i] == best


def _brute_repetition(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")

    def covered(size):
        times = Counter(tuple(w[i:i + size]) for i in range(len(w) - size + 1))
        hit = set()
        for i in range(len(w) - size + 1):
            if times[tuple(w[i:i + size])] > 1:
                hit.update(range(i, i + size))
        return len(hit)

    lines, seen = 0, set()
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            lines += line in seen
            seen.add(line)
    failed = len(w) < 20 or 100 * covered(8) > 30 * len(w)
    kept = not failed and 100 * covered(5) <= 40 * len(w) and not covered(101)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), lines, covered(8),
            failed, kept)


def test_repetition_matches_brute_force(spark, odd_docs, no_docs):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["a", "bé", "c#", "d\n"]) for _ in range(rng.randint(0, 120)))
             for _ in range(40)]
    passage = " ".join(f"x{k}" for k in range(130))
    many = " ".join(f"y{k}" for k in range(900))
    texts += [f"{passage} {many} {passage}", many, f"{passage[:100]} {many} {passage[:100]}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    for frame in (docs, odd_docs):
        source = sorted(((r.doc_id or -1, r.text) for r in frame.collect()), key=str)
        got = repetition.repetition(frame).collect()
        want = sorted((i, *_brute_repetition(t)) for i, t in source)
        assert sorted((r.doc_id or -1, *(r[c] for c in cols)) for r in got) == want
    assert repetition.repetition(no_docs).count() == 0


# --- byte-level BPE --------------------------------------------------------

def _tokenizer():
    import public_tokenizers
    import tiktoken

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = bpe_replay.read_ranks(path)
    return path, ranks, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN,
                                          mergeable_ranks=ranks, special_tokens={})


def test_merge_replay_equals_the_library():
    _, ranks, library = _tokenizer()
    rng = random.Random(1)
    texts = ["".join(map(chr, range(a, a + 64))) for a in range(0, 0xD800, 640)]
    texts += ["a" * 3000, " " * 999 + "x", "=" * 777, "", "'", "'r", "'re", "x'", "'s's 'l ''s", "\x1c\x85 x"]
    texts += ["".join(rng.choice(" theyouandi.ng\n\tó1'''slrevd") for _ in range(60)) for _ in range(1500)]
    encoder = bpe_replay.Encoder(bpe_replay.Merges(ranks))
    data, offsets = utf8(pa.array(texts, pa.string()))
    got = [ids[a:b].tolist() for _, _, ids, ends in encoder(data, offsets)
           for a, b in zip(ends[:-1], ends[1:])]
    assert got == [library.encode_ordinary(t) for t in texts]


def test_a_small_store_gives_the_same_ids(monkeypatch):
    _, ranks, library = _tokenizer()
    monkeypatch.setattr(bpe_replay, "STORE_WORDS", 3)
    encoder = bpe_replay.Encoder(bpe_replay.Merges(ranks))
    for text in ("the cat sat on the mat", "then the dog", "the cat again"):
        (_, _, ids, _), = encoder(*utf8(pa.array([text])))
        assert ids.tolist() == library.encode_ordinary(text)


def test_encode_and_decode_rows(odd_docs, no_docs):
    path, _, library = _tokenizer()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    encoded = bpe_replay.encode(odd_docs, path)
    want = []
    for r in odd_docs.collect():
        ids = library.encode_ordinary(r.text or "")
        want.append((r.doc_id or -1, len(ids), sha(",".join(map(str, ids)).encode()),
                     sha((r.text or "").encode())))
    got = encoded.collect()
    assert sorted((r.doc_id or -1, *r[1:4]) for r in got) == sorted(want)
    back = {r.bytes for r in bpe_replay.decode(encoded, path).collect()}
    assert back == {(r.text or "").encode() for r in odd_docs.collect()}
    assert bpe_replay.encode(no_docs, path).count() == 0


# --- license scan ----------------------------------------------------------

def _full_alignment(a, b):
    """Matched words of the best local alignment, without a band."""
    best = (0, 0)
    above = [(0, 0)] * (len(b) + 1)
    for x in a:
        row = [(0, 0)]
        for j, y in enumerate(b):
            d = above[j]
            cell = max((d[0] + 2, d[1] + 1) if x == y else (d[0] - 1, d[1]),
                       (above[j + 1][0] - 1, above[j + 1][1]), (row[j][0] - 1, row[j][1]))
            row.append(cell if cell[0] > 0 else (0, 0))
            best = max(best, row[-1])
        above = row
    return best[1]


def _fold(text):
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", "".join(
        c.lower() if c.isascii() else c for c in text or ""))


def test_license_scan_against_full_alignment(spark, odd_docs, no_docs):
    rng = random.Random(2)
    noise = lambda n: " ".join(rng.choice("abcdefgh") * rng.randint(1, 6) for _ in range(n))
    templates = {"long": noise(60), "short": "released under the odd license", "other": noise(25)}
    texts = []
    for _ in range(40):
        name = rng.choice(list(templates))
        words = templates[name].split()
        for _ in range(rng.randint(0, 6)):
            at = rng.randrange(len(words))
            words[at:at + rng.randint(0, 1)] = [noise(1)] * rng.randint(0, 1)
        texts.append(f"{noise(rng.randint(0, 80))} {' '.join(words).upper()}. {noise(20)}")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    exact = 0
    for r in license_scan.scan(docs, templates).collect():
        words = _fold(texts[r.doc_id])
        aligned = {n for n, t in templates.items()
                   if _full_alignment(_fold(t), words) >= license_scan.MIN_COVERAGE * len(_fold(t))}
        # a run of four common words always shares a fingerprint
        runs = lambda w: {tuple(w[k:k + 4]) for k in range(len(w) - 3)}
        sure = {n for n in aligned if runs(_fold(templates[n])) & runs(words)}
        found = {m.license for m in r.matches}
        assert sure <= found <= aligned
        exact += len(sure)
        for m in r.matches:
            part = texts[r.doc_id].encode()[m.begin:m.end].decode()
            assert _fold(part) == words[m.first_word:m.last_word + 1]
    assert exact > 25
    got = license_scan.scan(odd_docs).collect()
    assert len(got) == odd_docs.count() and {r.n_matches for r in got} == {0}
    assert license_scan.scan(no_docs).count() == 0
    plain = spark.createDataFrame([(1, "x Licensed under the Apache License, Version 2.0. y")], "doc_id int, text string")
    assert license_scan.scan(plain).first().licenses == "Apache-2.0-notice"


LIKE_LICENSES = [
    ("Licensed under CC BY-ND 4.0.", "CC-BY-ND-4.0-notice"),
    ("Licensed under CC BY 3.0.", "CC-BY-3.0-notice"),
    ("Licensed under CC BY-NC-SA 2.5.", "CC-BY-NC-SA-2.5-notice"),
    ("Licensed under CC BY 4.0.", "CC-BY-4.0-notice"),
    ("Licensed under CC BY 7.0.", ""),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivs 3.0 Unported License.",
     "CC-BY-NC-ND-3.0-long-notice"),
    ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0-notice"),
    ("This work is licensed under the GNU General Public License, version 3.0.", "GPL-3.0-notice"),
    ("This work is licensed under the GNU Lesser General Public License, version 2.1.", "LGPL-2.1-notice"),
    ("This work is licensed under the GNU General Public License, version 2.1.", ""),
    ("Licensed under the Apache License, Version 1.1.", "Apache-1.1-notice"),
    ("Released under the BSD License.", "BSD-notice"),
    ("Released under the Foo License.", ""),
    ("Released under the MIT License.", "MIT-notice"),
]


def test_licenses_are_told_apart(spark):
    from forecheck.llm.license_templates import DISTINCT, TEMPLATES, TITLES

    header, whole = TEMPLATES["GPL-3.0"], TEMPLATES["GPL-3.0-text"].split("How to Apply")[0]
    cases = LIKE_LICENSES + [(TEMPLATES[n], n) for n in sorted(TEMPLATES)]
    cases += [(header.replace("version 3", "version 4"), ""),
              (header.replace("GNU General", "GNU Other General"), ""),
              (whole.replace("GNU GENERAL PUBLIC", "GNU AFFERO GENERAL PUBLIC", 1), ""),
              (whole.split("Preamble", 1)[1], "GPL-3.0-text")]
    docs = spark.createDataFrame([(k, f"before it {t} after it") for k, (t, _) in enumerate(cases)],
                                 "doc_id int, text string")
    got = {r.doc_id: r.licenses for r in license_scan.scan(docs).collect()}
    assert [(c[0][:90], got[k]) for k, c in enumerate(cases)] == [(t[:90], n) for t, n in cases]
    for name, phrases in [*DISTINCT.items(), *((n, (t,)) for n, t in TITLES.items())]:
        for phrase in phrases:
            assert f" {' '.join(_fold(phrase))} " in f" {' '.join(_fold(TEMPLATES[name]))} "


@pytest.mark.parametrize("share", [0.05, 0.10])
def test_altered_licenses_are_found(spark, share):
    """Whole texts with a share of their words changed behind the first twelve."""
    from forecheck.llm.license_templates import TEMPLATES

    names = ["MIT-text", "Apache-2.0-text", "BSD-3-Clause-text"]
    rows = []
    for name in names:
        for seed in range(6):
            rng, words = random.Random(seed), TEMPLATES[name].split()
            for k in rng.sample(range(12, len(words)), int(share * len(words))):
                words[k] = "changed"
            rows.append((len(rows), name, "some text before " + " ".join(words) + " and after"))
    docs = spark.createDataFrame(rows, "doc_id int, name string, text string")
    got = {r.doc_id: r.licenses for r in license_scan.scan(docs).collect()}
    assert [(n, got[k]) for k, n, _ in rows] == [(n, n) for _, n, _ in rows]


def test_adjacent_notices_are_all_found(spark):
    lines = ["Released under the MIT License.\n", "Licensed under CC BY 4.0.\n",
             "Licensed under the Apache License, Version 2.0.\n"]
    names = ["MIT-notice", "CC-BY-4.0-notice", "Apache-2.0-notice"]
    rng = random.Random(6)
    mixed = [rng.randrange(3) for _ in range(300)]
    runs = [[k] * n for k in range(3) for n in (1, 2, 3, 1000)] + [mixed]
    texts = ["".join(lines[k] for k in run) for run in runs]
    # damaged notices right before and after whole ones and another licence
    runs += [[0, 0, 0], [3, 1]]
    names.append("CC-BY-ND-4.0-notice")
    texts.append("Released under X the MIT License. Released under the MIT License. Released under X the MIT License.")
    texts.append("Licensed under CC BY-ND 4.0. Under CC BY 4.0.")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    for r in license_scan.scan(docs).collect():
        assert r.n_matches == len(runs[r.doc_id])
        assert [m.license for m in r.matches] == [names[k] for k in runs[r.doc_id]]
        if r.doc_id < len(runs) - 2:
            at = 0
            for m, k in zip(r.matches, runs[r.doc_id]):
                assert (m.begin, m.end) == (at, at + len(lines[k].rstrip(".\n")))
                at += len(lines[k])


# --- toxicity --------------------------------------------------------------

def _labelled(n, seed):
    rng = random.Random(seed)
    syllables = "th er in an re on at en nd ti es or te of ed is it al ar st".split()
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    rows = []
    for k in range(n):
        words = [word() for _ in range(rng.randint(20, 200))]
        toxic = k % 5 == 0
        if toxic:
            for _ in range(rng.randint(3, 6)):
                words.insert(rng.randrange(len(words)), rng.choice(["blockhead", "vermin", "nitwit"]))
        rows.append((k, " ".join(words), int(toxic)))
    return rows


def test_held_out_accuracy_and_defined_cases(spark, odd_docs, no_docs):
    docs = spark.createDataFrame([r[:2] for r in _labelled(900, 4)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in _labelled(900, 4)], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, labels)
    fresh = _labelled(400, 9)
    table = spark.createDataFrame([r[:2] for r in fresh], "doc_id bigint, text string")
    got = {r.doc_id: r for r in toxicity.score(table, model).collect()}
    right = sum(got[i].predicted == label for i, _, label in fresh)
    assert right >= 0.95 * len(fresh)
    assert all((r.score >= 0.5) == (r.predicted == 1) and 0 <= r.score <= 1 for r in got.values())
    odd = toxicity.score(odd_docs, model).collect()
    assert len(odd) == odd_docs.count() and all(r.score is not None for r in odd)
    kept = toxicity.accepted(table, model)
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.predicted}
    assert toxicity.accepted(odd_docs, model).columns == odd_docs.columns
    assert toxicity.score(no_docs, model).count() == 0


def test_long_ordinary_texts_are_not_rejected():
    """Evidence of ordinary windows falls with the length of a text; a toxic text
    stays toxic at any length."""
    rows = _labelled(1200, 4)
    model = toxicity.fit_texts([t for _, t, y in rows if y], [t for _, t, y in rows if not y])
    scorer = toxicity.Scorer(model)
    fresh = _labelled(3000, 11)
    alone = scorer.scores(pa.array([t for _, t, _ in fresh]))
    ordinary = [t for (_, t, y), p in zip(fresh, alone) if not y and p < 0.5]
    bad = [t for _, t, y in fresh if y]
    assert model.weights[0] < 0 < max(model.weights)
    for size in (20_000, 200_000, 1_000_000):
        long = lambda texts: " ".join(texts)[:size]
        low, high = scorer.scores(pa.array([long(ordinary * 4), long(bad * 20)]))
        assert low < 0.01 and high > 0.99, (size, low, high)


def test_copies_do_not_mark_a_gram():
    """A toxic text that is copied many times says no more than one."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7))
    copied = " ".join(word() for _ in range(60))
    toxic = [copied] * 60 + [" ".join([*(word() for _ in range(30)), "blockhead", word()]) for _ in range(60)]
    ordinary = [" ".join(word() for _ in range(40)) for _ in range(300)]
    fold = lambda texts: [toxicity._fold(t) for t in texts]
    contexts = [[toxicity._contexts(t) for t in fold(x)] for x in (toxic, ordinary)]
    segments = toxicity._toxic_segments(fold(toxic), *contexts)
    assert segments and all(b"block" in s or b"head" in s or b"ckhe" in s for s in segments)


def test_labels_of_held_out_rows_are_not_read(spark):
    docs = spark.createDataFrame([(k, f"text number {k}") for k in range(200)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(200)], "doc_id bigint, toxic int")
    import zlib

    toxic, ordinary = toxicity.training_rows(docs, labels)
    ids = {int(t.split()[-1]) for t in toxic + ordinary}
    assert ids == {k for k in range(200) if zlib.crc32(str(k).encode()) % 5}


def test_scores_keep_the_class_shares_of_all_rows(spark, monkeypatch):
    """Labels that the texts tell nothing of: the score is the share of toxic rows,
    however many of each class are sampled."""
    texts = [(k, t) for k, t, _ in _labelled(1500, 7) if k % 5]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, int(j % 10 == 0)) for j, (k, _) in enumerate(texts)],
                                   "doc_id bigint, toxic int")
    for most in (80, 10_000):
        monkeypatch.setattr(toxicity, "SAMPLE_TOXIC", most)
        monkeypatch.setattr(toxicity, "SAMPLE_ORDINARY", 3 * most)
        scores = [r.score for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()]
        assert 0.07 < sum(scores) / len(scores) < 0.13


@pytest.mark.parametrize("rows", [[], [(1, 0)], [(k, 0) for k in range(40)]])
def test_too_few_labels_give_a_constant_score(spark, rows):
    docs = spark.createDataFrame([(k, f"some text {k}") for k in range(40)], "doc_id bigint, text string")
    labels = spark.createDataFrame(rows, "doc_id bigint, toxic int")
    model = toxicity.fit(docs, labels)
    assert {r.predicted for r in toxicity.score(docs, model).collect()} == {0}


def test_range_hashes_agree_on_equal_ranges():
    data = np.frombuffer(b"abcabcabxabc", np.uint8)
    at = np.array([0, 3, 9])
    h = RangeHash(data)(at, at + 3)
    assert h[0] == h[1] == h[2] != RangeHash(data)(np.array([6]), np.array([9]))[0]
    starts, ends, rows = word_spans(np.frombuffer(b"ab cd", np.uint8), np.array([0, 1, 1, 5]))
    assert list(zip(starts, ends, rows)) == [(0, 1, 0), (1, 2, 2), (3, 5, 2)]

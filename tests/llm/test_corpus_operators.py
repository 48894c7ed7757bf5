"""Operators over a whole corpus, against brute force on small fixtures."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from forecheck.llm import (chat_format, decontamination, jaccard_join, prefix_free_dedup, url_rules,
                           warc_seekable)


# --- suffix-array dedup ----------------------------------------------------

def _brute_dedup(rows, size=100):
    """rows: (id, text) in corpus order -> (n_bytes, n_removed, n_spans, sha)."""
    seen, out = set(), []
    for _, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - size + 1):
            part = raw[s:s + size]
            if part in seen:
                gone[s:s + size] = b"\1" * size
            seen.add(part)
        spans = len(re.findall(b"\1+", bytes(gone)))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def _repetitive(seed, n):
    rng = random.Random(seed)
    pool = ["".join(rng.choice("abcdé \n") for _ in range(rng.randint(40, 260))) for _ in range(8)]
    texts = []
    for _ in range(n):
        parts = [rng.choice(pool) if rng.random() < 0.5 else
                 "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(0, 150)))
                 for _ in range(rng.randint(0, 6))]
        text = "".join(parts)
        texts.append(text[rng.randint(0, 50):])
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_prefix_free_dedup_against_brute_force(spark, seed):
    texts = _repetitive(seed, 60) + ["z" * 700, "ab" * 400, "x" * 99, "", None, "q" * 100]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = sorted((r.doc_id, *r.dedup) for r in prefix_free_dedup.dedup(docs).collect())
    assert got == [(i, *w) for (i, _), w in zip(rows, _brute_dedup(rows))]


def test_one_hot_passage_in_every_text(spark):
    """A frequent passage with different neighbours everywhere, longer than a string."""
    rng = random.Random(7)
    hot = "".join(rng.choice("abcdefghij ") for _ in range(180))
    rows = [(k, "".join(rng.choice("klmnop ") for _ in range(rng.randint(0, 130))) + hot
             + "".join(rng.choice("qrstuv ") for _ in range(rng.randint(0, 130)))) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted((r.doc_id, *r.dedup) for r in prefix_free_dedup.dedup(docs).collect())
    assert got == [(i, *w) for (i, _), w in zip(rows, _brute_dedup(rows))]


def test_dedup_of_odd_rows_keeps_all_columns(odd_docs, no_docs):
    got = prefix_free_dedup.dedup(odd_docs, out="figures").collect()
    assert len(got) == odd_docs.count() and got[0].__fields__ == [*odd_docs.columns, "figures"]
    removed = {(r.doc_id, r.source): r.figures.n_removed for r in got if r.source == "b"}
    assert removed[(5, "b")] > 0 and removed[(6, "b")] == next(
        r.figures.n_bytes for r in got if r.doc_id == 6 and r.source == "b")
    assert prefix_free_dedup.dedup(no_docs).count() == 0


def test_equal_rows_are_judged_in_order(spark):
    rng = random.Random(1)
    text = "".join(rng.choice("abcdefgh") for _ in range(300))
    docs = spark.createDataFrame([(3, text), (3, text), (None, text)], "doc_id bigint, text string")
    got = sorted((r.doc_id or -1, r.dedup.n_removed) for r in prefix_free_dedup.dedup(docs).collect())
    assert got == [(-1, 0), (3, 300), (3, 300)]


# --- n-gram Jaccard join ---------------------------------------------------

def _sets(texts):
    out = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        out.append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    return out


def _brute_groups(texts, threshold=0.8):
    sets, links = _sets(texts), Counter()
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and common >= threshold * (len(sets[a]) + len(sets[b]) - common) - 1e-9:
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [(len(s), links[k], find(k)) for k, s in enumerate(sets)]


def _near_copies(seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(12):
        base = [f"w{rng.randrange(4000)}" for _ in range(rng.randint(3, 160))]
        for _ in range(rng.randint(1, 14)):
            words = list(base)
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = f"v{rng.randrange(4000)}"
            texts.append(" ".join(words))
    return texts + ["", None, " \n", "one two", "one two", "one two three four"]


def test_jaccard_join_against_brute_force(spark, monkeypatch):
    texts = _near_copies(3)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    want = [(k, *w) for k, w in enumerate(_brute_groups(texts))]
    # with whole buckets and with buckets cut into many blocks
    for block in (jaccard_join.BLOCK_TEXTS, 3):
        monkeypatch.setattr(jaccard_join, "BLOCK_TEXTS", block)
        got = sorted((r.doc_id, r.n_shingles, r.n_links, r.group_id)
                     for r in jaccard_join.jaccard_join(docs).collect())
        assert got == want


def test_pruning_keeps_pairs_at_the_threshold():
    from math import comb

    for n, m in jaccard_join.least_equal(0.8, jaccard_join.TOLERANCE).items():
        lost = sum(comb(n, k) * 0.8**k * 0.2 ** (n - k) for k in range(m))
        assert lost < 1e-5


def test_first_of_groups_and_odd_rows(odd_docs, no_docs):
    got = jaccard_join.jaccard_join(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert {(r.doc_id, r.n_links) for r in got if r.n_shingles == 0} == {(2, 0), (3, 0), (4, 0)}
    kept = jaccard_join.first_of_groups(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    # of the two equal rows one stays, of the two long copies the one with the least id
    assert ids == Counter({1: 1, 2: 1, 3: 1, 4: 1, None: 1, 5: 1, 6: 1, 7: 1})
    assert jaccard_join.jaccard_join(no_docs).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(f"a{k:03d}", f"a{k + 1:03d}") for k in range(60)] + [("hub", f"s{k}") for k in range(30)]
    random.Random(1).shuffle(edges)
    found = jaccard_join.components(spark.createDataFrame(edges, "u string, v string")).collect()
    groups = defaultdict(set)
    for r in found:
        groups[r.root].add(r.node)
    assert {(min(g), len(g)) for g in groups.values()} == {("a000", 61), ("hub", 31)}
    assert jaccard_join.components(spark.createDataFrame([], "u string, v string")).count() == 0


# --- benchmark decontamination ---------------------------------------------

def _brute_contamination(text, items):
    fold = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(
        c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    w = fold(text)
    hit, found = set(), set()
    for item, test in items:
        t = fold(test)
        n = min(13, len(t))
        wins = {tuple(t[k:k + n]) for k in range(len(t) - n + 1)} if t else set()
        for s in range(len(w) - n + 1 if t else 0):
            if tuple(w[s:s + n]) in wins:
                hit.update(range(s, s + n))
                found.add(str(item))
    return len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)


def test_contamination_against_brute_force(spark, odd_docs, no_docs):
    rng = random.Random(5)
    words = lambda n: [rng.choice(["the", "of", "Cat", "dög", "x1", f"r{rng.randrange(60)}"])
                       for _ in range(n)]
    items = [(k, " ".join(words(rng.choice([1, 3, 13, 14, 40])))) for k in range(12)]
    items += [(90, None), (91, ""), (92, "the the the the"), (93, items[3][1]), (94, items[3][1])]
    rows = []
    for k in range(60):
        parts = words(rng.randint(0, 60))
        for _ in range(rng.randint(0, 2)):
            test = (rng.choice(items)[1] or "").split()
            cut = rng.randint(0, 3)
            at = rng.randint(0, len(parts))
            parts[at:at] = test[cut:]
        rows.append((k, ", ".join(parts).upper() if k % 7 == 0 else " ".join(parts)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"], r.contaminated)
           for r in decontamination.contamination(docs, bench).collect()}
    assert got == {k: _brute_contamination(t, items) for k, t in rows}
    odd = decontamination.contamination(odd_docs, bench, carry="figures").collect()
    assert sorted((str(r.doc_id), r.figures.n_words, r.figures.n_hit) for r in odd) == sorted(
        (str(r.doc_id), *_brute_contamination(r.text, items)[:2]) for r in odd_docs.collect())
    assert decontamination.contamination(no_docs, bench).count() == 0
    clean = decontamination.contamination(docs, bench.limit(0)).collect()
    assert len(clean) == 60 and not any(r.contaminated for r in clean)


def test_contamination_with_shuffled_sides(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BROADCAST_ROWS", 0)
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "x b c d y")], "doc_id bigint, text string")
    bench = spark.createDataFrame([(7, "b c d")], "item_id bigint, text string")
    got = sorted((r.doc_id, r.n_hit, r["items"]) for r in decontamination.contamination(docs, bench).collect())
    assert got == [(1, 3, ["7"]), (2, 3, ["7"])]


def test_items_without_id_count_as_in_the_sql(spark, tmp_path):
    import duckdb

    from forecheck.llm.queries import ORACLE_SQL

    passage = " ".join(f"p{k}" for k in range(20))
    other = " ".join(f"q{k}" for k in range(15))
    docs = spark.createDataFrame([(1, f"x {passage} y"), (2, f"{other} z {passage}"), (3, "p1 p2 p3"),
                                  (4, other)], "doc_id bigint, text string")
    bench = spark.createDataFrame([(None, passage), (None, "a b c"), (7, other), (None, other)],
                                  "item_id bigint, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    want = con.execute(ORACLE_SQL["op2_decontamination"])
    columns = [c[0] for c in want.description]
    got = decontamination.op2_decontamination(spark, str(tmp_path)).select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())
    hit = {r.doc_id: (r.n_hit, r["items"]) for r in decontamination.contamination(docs, bench).collect()}
    assert hit == {1: (20, [None]), 2: (35, ["7", None]), 3: (0, []), 4: (15, ["7", None])}


def test_sides_of_many_bytes_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BROADCAST_BYTES", 1000)
    small = spark.createDataFrame([(1, ["a"])], "key bigint, words array<string>")
    large = spark.createDataFrame([(1, ["word"] * 1000)], "key bigint, words array<string>")
    hinted = lambda d: "broadcast" in decontamination._bounded(d)._jdf.queryExecution().logical().toString()
    assert hinted(small) and not hinted(large)
    assert hinted(small.limit(0))


def test_proximity_matches_allow_small_shifts(spark):
    bench = spark.createDataFrame([(1, "alpha beta gamma delta")], "item_id bigint, text string")
    docs = spark.createDataFrame(
        [(1, "alpha beta gamma delta"), (2, "alpha x y beta gamma delta"),
         (3, "alpha " + "x " * 30 + "beta gamma delta"), (4, "nothing here")], "doc_id bigint, text string")
    near = {r.doc_id for r in decontamination.proximity_matches(docs, bench, slop=3).collect()}
    assert {1, 2} <= near and not near & {3, 4}


def _near(text, item, slop, share):
    w, t = (re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (x or "").lower()) for x in (text, item))
    n = min(len(t), 13)
    least = max(1, -(-round(share * n * 100) // 100))
    for s in range(len(t) - n + 1) if n else ():
        at = [{p - j for p, x in enumerate(w) if x == t[s + j]} for j in range(n)]
        for d in set().union(*at):
            if sum(any(d <= x <= d + slop for x in places) for places in at) >= least:
                return True
    return False


def test_proximity_matches_against_brute_force(spark, odd_docs, no_docs):
    rng = random.Random(31)
    vocab = [f"v{k}" for k in range(40)]
    items = [(k, " ".join(rng.choices(vocab, k=rng.choice([1, 4, 9, 13, 20])))) for k in range(12)]
    # a word that no document holds, an item without words, one without text or id
    items += [(20, "nowhere " + " ".join(vocab[:12])), (21, " ,;"), (22, None), (None, " ".join(vocab[5:18]))]
    rows = []
    for d in range(120):
        words = rng.choices(vocab, k=rng.randint(0, 40))
        if d % 3:
            near = (rng.choice(items)[1] or "").split()
            for _ in range(rng.randint(0, 4)):
                if near:
                    k = rng.randrange(len(near))
                    near[k:k + rng.randint(0, 1)] = [rng.choice(["put", "in", *vocab])] * rng.randint(0, 2)
            words[len(words) // 2:len(words) // 2] = near
        rows.append((d, " ".join(words)))
    rows += [(200, None), (201, ""), (None, " ".join(vocab[5:18])), (3, " ".join(vocab[:12]))]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id bigint, text string, at int, item string")
    for slop, share in ((3, 0.8), (0, 1.0), (5, 0.6)):
        got = decontamination.proximity_matches(docs, bench, slop, share).collect()
        want = {(d, None if i is None else str(i)) for d, t in rows for i, x in items if _near(t, x, slop, share)}
        assert {tuple(r) for r in got} == want and len(got) == len(want)
        assert (None, None) in want and (3, "20") in want if share < 1 else want
    assert decontamination.proximity_matches(no_docs, bench).count() == 0
    assert decontamination.proximity_matches(odd_docs, bench.limit(0)).count() == 0


# --- chat formatting -------------------------------------------------------

def test_chat_round_trip_of_hostile_texts(spark):
    rng = random.Random(8)
    bits = ["<|im_start|>", "<|im_end|>", "<", "|", "\\", "\n", "assistant", "a", "<\\|", "%0A", "é", "<|x|>"]
    mess = lambda: "".join(rng.choice(bits) for _ in range(rng.randint(0, 9)))
    rows = [(c, t, rng.choice(["user", "assistant", mess(), None]), rng.choice([mess(), None]))
            for c in range(80) for t in range(rng.randint(1, 5))]
    rows += [(None, 0, "user", "hi"), (200, None, "user", "b"), (200, None, "assistant", "a"), (200, 1, "x", "c")]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    done = chat_format.format_chat(frame.withColumn("h", F.lit(1)).withColumn("out", F.lit("x")))
    read = done.select("conv_id", "formatted", chat_format.parse(F.col("formatted")).alias("turns"),
                       chat_format.loss_mask(F.col("formatted")).alias("mask"),
                       chat_format.loss_texts(F.col("formatted"), chat_format.loss_mask(F.col("formatted")))
                       .alias("under")).collect()
    source = defaultdict(list)
    for c, t, role, text in rows:
        source[c].append((t if t is not None else -1, role or "", text or ""))
    assert {r.conv_id for r in read} == set(source)
    for r in read:
        assert sorted((t.role, t.text) for t in r.turns) == sorted(x[1:] for x in source[r.conv_id])
        if r.conv_id not in (200, None):
            assert [(t.role, t.text) for t in r.turns] == [x[1:] for x in sorted(source[r.conv_id])]
        at, under = 0, []
        for run in r.mask:
            if run.loss:
                under.append(r.formatted[at:at + run.chars])
            at += run.chars
        assert at == len(r.formatted)
        plain = [re.sub(r"<\\(\\*)\|", r"<\1|", x) for x in under]
        assert plain == r.under == [t.text for t in r.turns if t.role == "assistant"]
    assert chat_format.format_chat(frame.limit(0)).count() == 0


def test_loss_is_cut_by_the_mask_from_long_conversations(spark, monkeypatch):
    monkeypatch.setattr(chat_format, "RUNS", 4)
    monkeypatch.setattr(chat_format, "BLOCK", 7)
    rng = random.Random(9)
    bits = ["<|im_end|>", "<", "\\|", "é", "\U0001F600", "\n", "plain words ", ""]
    rows = [(c, t, "assistant" if t % 2 else "user", "".join(rng.choice(bits) for _ in range(rng.randint(0, 30))))
            for c, n in ((1, 1), (2, 2), (3, 41), (4, 300)) for t in range(n)]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    done = chat_format.format_chat(frame)
    mask = chat_format.loss_mask(F.col("formatted"))
    for r in done.select("conv_id", chat_format.loss_texts(F.col("formatted"), mask).alias("under")).collect():
        assert r.under == [x[3] for x in rows if x[0] == r.conv_id and x[2] == "assistant"]
    # the texts follow the mask, not the turns that are read back
    late = F.transform(mask, lambda x: F.struct(x["chars"].alias("chars"), (~x["loss"]).alias("loss")))
    r = done.where("conv_id = 2").select(chat_format.loss_texts(F.col("formatted"), late).alias("under")).first()
    assert rows[2][3] not in r.under and "<|im_start|>assistant\n" in "".join(r.under)
    empty = spark.range(1).select(F.lit("").alias("f"))
    assert empty.select(chat_format.loss_texts(F.col("f"), chat_format.loss_mask(F.col("f"))).alias("u")).first().u == []


# --- URL rules -------------------------------------------------------------

def _brute_rule(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host):]).group()
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h) + len(p), h + p, v) for h, p, v in rules
            if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[1], best[2] if best else "allow"


def test_url_sweep_against_brute_force(spark):
    rng = random.Random(4)
    host = lambda: ".".join(rng.choice(["a", "b", "org", "com"]) for _ in range(rng.randint(1, 4)))
    path = lambda: "".join(rng.choice(["/", "x", "y", "/x/", "é"]) for _ in range(rng.randint(0, 4)))
    rules = list({(host(), "/" + path()): None for _ in range(60)})
    rules = [(h, p, rng.choice(["allow", "block"])) for h, p in rules] + [("org", "", "block")]
    urls = [f"http://{host().upper() if k % 9 == 0 else host()}/{path()}{rng.choice(['', '?q=/', '#f'])}"
            for k in range(400)]
    urls += [None, "", "no scheme", "http://", "http:///p", "x://org", "http://org?x", "http://a..b/x", urls[0], urls[0]]
    pages = spark.createDataFrame([(k, u, "x", "y") for k, u in enumerate(urls)],
                                  "page_id bigint, url string, host string, rule string")
    pages = pages.unionByName(pages.where("page_id in (3, 400)"))
    want = sorted(((k, *_brute_rule(u, rules)) for k, u in [*enumerate(urls), (3, urls[3]), (400, None)]), key=str)
    for salts in (1, 5):
        got = url_rules.judge(pages, url_rules.rule_table(spark, rules), salts=salts)
        assert sorted((tuple(r[c] for c in ("page_id", "host", "path", "rule", "verdict"))
                       for r in got.collect()), key=str) == want
    none = url_rules.judge(pages, url_rules.rule_table(spark, []), salts=2).collect()
    assert len(none) == len(want) and {r.verdict for r in none} == {"allow"}
    assert url_rules.judge(pages.limit(0), url_rules.rule_table(spark, rules)).count() == 0


def test_equal_rules_block(spark):
    pages = spark.createDataFrame([(1, "http://q.org/")], "page_id bigint, url string")
    rules = url_rules.rule_table(spark, [("org", "/", "allow"), ("ORG", "/", "block"), (None, "/", "block")])
    assert url_rules.judge(pages, rules).first().verdict == "block"


# --- WARC ------------------------------------------------------------------

def test_warc_round_trip_revisits_and_lookup(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc_seekable, "FRAME_BYTES", 2000)
    monkeypatch.setattr(warc_seekable, "BUNDLE_BYTES", 3000)
    rng = random.Random(6)
    html = lambda n: "".join(rng.choice("abc <p>é\r\n") for _ in range(n))
    rows = [(k, f"http://h/{k}\r\nX: 1", html(rng.randint(0, 900))) for k in range(60)]
    rows += [(100, None, "same"), (101, "u", "same"), (102, "u", "same"), (103, "u", None), (104, "u", ""),
             (105, "u", "WARC/1.1\r\n\r\n"), (None, "u", "no id"), (106, "u", "x" * 50_000)]
    rows += [(107, "u", "twice"), (107, "u", "twice")]
    pages = spark.createDataFrame([(*r, 1, "k") for r in rows],
                                  "page_id bigint, url string, html string, id int, sha1 string").repartition(3)
    folder = str(tmp_path / "bundles")
    index = warc_seekable.write(pages, folder)
    got = warc_seekable.read(folder, index).collect()
    assert len(got) == len(rows)
    last = {}
    for i, _, h in rows:
        last[h or ""] = max(last.get(h or "", -1), -1 if i is None else i)
    texts = {i: h or "" for i, _, h in rows}
    for r in got:
        text = texts[r.record_id]
        assert r.payload_bytes == len(text.encode()) and r.payload_digest == warc_seekable.digest(text.encode())
        if r.record_id in (None, last[text]):
            assert (r.record_type, r.refers_to, bytes(r.body).decode()) == ("response", None, text)
        else:
            assert (r.record_type, r.refers_to, bytes(r.body)) == ("revisit", last[text], b"")
    # small as the index is, its files are read by as many tasks
    every = index.unionByName(warc_seekable.write(pages.limit(5), folder)).unionByName(
        warc_seekable.write(pages.limit(7), folder))
    files = every.select("file").distinct().count()
    again = warc_seekable.read(folder, every)
    assert files > 2 and again.rdd.getNumPartitions() == files and again.count() == len(rows) + 12
    wanted = spark.createDataFrame([(100,), (5,), (999,)], "record_id bigint")
    assert {r.record_id for r in warc_seekable.lookup(folder, index, wanted).collect()} == {100, 5}
    # any Zstandard reader unpacks a whole bundle
    import zstandard

    name = index.first().file
    with open(f"{folder}/{name}", "rb") as f:
        whole = zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read()
    assert whole.startswith(b"WARC/1.1\r\n")
    small = warc_seekable.write(pages, str(tmp_path / "small"), min_bytes=5)
    kinds = Counter(r.record_type for r in warc_seekable.read(str(tmp_path / "small"), small).collect())
    assert kinds["revisit"] == 0 or kinds["revisit"] < Counter(r.record_type for r in got)["revisit"]
    nothing = warc_seekable.write(pages.limit(0), str(tmp_path / "none"))
    assert warc_seekable.read(str(tmp_path / "none"), nothing).count() == 0

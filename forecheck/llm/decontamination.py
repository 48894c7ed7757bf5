"""Benchmark decontamination with a positional inverted index. DataFrame
functions only.

* ``build_index`` writes the postings (term, document, position) of every
  training text for the terms that the test windows use, document-sharded: the
  rows stay where the text was read, so building it needs no shuffle and a hot
  term is spread like the documents that hold it.
* ``plan_windows`` counts the postings per term (summed before the shuffle) and
  picks the rarest terms of every test window; a window with a term that the
  corpus lacks cannot occur and is left out.
* ``phrase_candidates`` shifts the posting lists of those terms by their place in
  the item and intersects them: postings of one window start on the same
  diagonal (document position minus item position), so a grouping by document,
  item and diagonal is the intersection. Lists of frequent terms are only read
  where no rarer term of the window exists.
* ``contamination`` checks the remaining words of the candidates on the documents
  themselves and counts the words hit.
* ``proximity_matches`` finds near copies: from the postings of a window's rarest
  terms, a share of its words shifted against each other by up to ``slop`` words.

The test side is small (a benchmark); it is broadcast only after its rows and
bytes were measured, otherwise the joins shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from forecheck.llm.common import stored, table

WINDOW = 13
RAREST = 2                      # terms of a window whose lists are intersected
BROADCAST_ROWS = 500_000        # rows up to which a side is broadcast,
BROADCAST_BYTES = 16 << 20      # and bytes as JSON (in memory up to about four times as many)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"


def words(text: Column) -> Column:
    """ASCII-lower-cased words: runs of letters, digits and non-ASCII characters."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER),
                                F.lit(_WORD), F.lit(1))


def _bounded(df: DataFrame) -> DataFrame:
    """Hint a broadcast only after the rows and bytes were measured."""
    size = F.octet_length(F.to_json(F.struct("*"))).cast("long")
    row = df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()
    return F.broadcast(df) if row.rows <= BROADCAST_ROWS and row.bytes <= BROADCAST_BYTES else df


def test_items(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Items with words: item (as text, or NULL), words, n (words of a window)."""
    return (benchmark.select(benchmark[id_col].cast("string").alias("item"),
                             words(benchmark[text_col].cast("string")).alias("words"))
            .where("size(words) > 0").distinct()
            # equal ids with different texts are told apart
            .withColumn("key", F.xxhash64("item", F.array_join("words", " ")))
            .withColumn("n", F.least(F.size("words"), F.lit(WINDOW))))


def build_index(docs: DataFrame, items: DataFrame, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Postings (term, doc, pos) of the items' terms, stored in the shared folder."""
    terms = _bounded(items.select(F.explode("words").alias("term")).distinct())
    every = docs.select(docs[id_col].alias("doc"),
                        F.posexplode(words(docs[text_col].cast("string"))).alias("pos", "term"))
    return stored(every.join(terms, "term", "left_semi"), "postings")


def plan_windows(items: DataFrame, index: DataFrame) -> DataFrame:
    """Per item: key, item, words, n, ``wins`` (start and places of its rarest
    terms, for each window that may occur) and ``places`` (all those places)."""
    counts = index.groupBy("term").agg(F.count(F.lit(1)).alias("postings"))
    parts = (items.select("key", "n", "words", F.explode(
        F.sequence(F.lit(0), F.size("words") - F.col("n"))).alias("s"))
        .select("key", "n", "s", F.posexplode(F.slice("words", F.col("s") + 1, F.col("n")))
                .alias("j", "term")))
    ranked = parts.join(counts, "term").withColumn("place", F.row_number().over(
        W.partitionBy("key", "s").orderBy("postings", "j")))
    windows = (ranked.groupBy("key", "s", "n")
               .agg(F.count(F.lit(1)).alias("found"),
                    F.sort_array(F.collect_list(F.when(F.col("place") <= RAREST,
                                                       F.col("s") + F.col("j")))).alias("places"))
               .where("found = n").groupBy("key")
               .agg(F.collect_list(F.struct("s", "places")).alias("wins")))
    return items.join(windows, "key").withColumn(
        "places", F.array_distinct(F.flatten(F.col("wins")["places"])))


def _hits(index: DataFrame, planned: DataFrame) -> DataFrame:
    """Postings of the rarest terms, shifted: doc, key, diagonal, place."""
    anchors = planned.select("key", F.explode("places").alias("place"), "words").select(
        "key", "place", F.element_at("words", F.col("place") + 1).alias("term"))
    return index.join(_bounded(anchors), "term").select(
        "doc", "key", (F.col("pos") - F.col("place")).alias("diagonal"), "place")


def phrase_candidates(index: DataFrame, planned: DataFrame) -> DataFrame:
    """Rows (doc, key, diagonal) where a window's rarest terms line up."""
    lined = (_hits(index, planned).groupBy("doc", "key", "diagonal")
             .agg(F.collect_set("place").alias("got")))
    fits = F.exists("wins", lambda w: F.forall(w["places"], lambda p: F.array_contains("got", p)))
    return (lined.join(_bounded(planned.select("key", "wins")), "key").where(fits)
            .select("doc", "key", "diagonal"))


def near_anchors(items: DataFrame, index: DataFrame, share: float) -> DataFrame:
    """Per window of an item its rarest terms, from which a near match is looked up:
    item, window (words), least (words that a match needs), place, term.

    A match lacks at most n - least of a window's n words, so it holds one of the
    n - least + 1 rarest at least. Terms that the corpus lacks are the rarest of all;
    a window with more of them than a match may lack has no anchor and no match.
    """
    counts = index.groupBy("term").agg(F.count(F.lit(1)).alias("postings"))
    places = (items.select("key", "item", "n", "words", F.explode(
        F.sequence(F.lit(0), F.size("words") - F.col("n"))).alias("s"))
        .select("key", "item", "n", "s", F.slice("words", F.col("s") + 1, F.col("n")).alias("window"))
        .withColumn("least", F.greatest(F.lit(1), F.ceil(F.lit(share) * F.col("n") - 1e-9)).cast("int"))
        .select("*", F.posexplode("window").alias("place", "term")))
    ranked = places.join(counts, "term", "left").withColumn("rank", F.row_number().over(
        W.partitionBy("key", "s").orderBy(F.coalesce("postings", F.lit(0)), "place")))
    return (ranked.where("rank <= n - least + 1 and postings is not null")
            .select("item", "window", "least", "place", "term").distinct())


def proximity_matches(docs: DataFrame, benchmark: DataFrame, slop: int = 5, share: float = 0.8,
                      id_col: str = "doc_id", text_col: str = "text",
                      item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Pairs (document, item) where, for some window of the item, at least ``share`` of
    its words stand in the document, shifted against each other by at most ``slop``
    words. Changed, left out and put in words are passed over; one word of the document
    may stand for several equal words of a window.

    NULL and empty texts match nothing; items without an id give a NULL item; of
    repeated rows each counts, equal pairs are returned once; empty tables give no rows.
    Candidates are the postings of the windows' rarest terms, the rest is counted on the
    documents' own words.
    """
    items = test_items(benchmark, item_col, item_text_col)
    index = build_index(docs, items, id_col, text_col)
    anchors = stored(near_anchors(items, index, share), "near-anchors")
    found = (index.join(_bounded(anchors), "term")
             .groupBy("doc").agg(F.collect_set(F.struct(
                 "item", "window", "least", (F.col("pos") - F.col("place")).alias("at"))).alias("candidates")))
    base = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    every = (base.join(found, base["id"].eqNullSafe(found["doc"]))
             .select("id", words(F.col("text")).alias("w"), "candidates"))

    def near(c: Column) -> Column:
        shifts = F.sequence(F.lit(-slop), F.lit(slop))
        # per word of the window: at which shifts against the anchor it stands
        stands = F.transform(c["window"], lambda t, j: F.transform(shifts, lambda e: F.coalesce(
            F.get("w", c["at"] + j + e) == t, F.lit(False))))
        enough = lambda rows: F.exists(F.sequence(F.lit(0), F.lit(slop)), lambda x: F.size(
            F.filter(rows, lambda r: F.array_contains(F.slice(r, x + 1, slop + 1), True))) >= c["least"])
        return F.exists(F.array(stands), enough)

    matched = F.array_distinct(F.transform(F.filter("candidates", near), lambda c: c["item"]))
    return every.select(F.col("id").alias(id_col), F.explode(matched).alias(item_col)).distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", carry: str | None = None) -> DataFrame:
    """One row per input row: id, ``n_words``, ``n_hit`` (words inside an
    occurrence of a test window), ``items`` (sorted item ids with occurring
    windows) and ``contaminated`` (``n_hit`` > 0 and at least a twentieth of the
    words).

    NULL or empty texts have no words and are clean; items without words are left
    out; those without an id count as any other and are one NULL, the last, of
    ``items``; repeated rows and ids are judged each on its own text; NULL ids
    work as any other. Empty documents give no rows, an empty benchmark leaves
    every document clean. Other columns are not read, or with ``carry`` all are
    returned, followed by the figures as one struct column of that name.
    """
    items = test_items(benchmark, item_col, item_text_col)
    index = build_index(docs, items, id_col, text_col)
    planned = stored(plan_windows(items, index), "test-windows")
    found = (phrase_candidates(index, planned)
             .join(_bounded(planned.select("key", "item", "words", "n")), "key")
             .groupBy("doc").agg(F.collect_list(F.struct(
                 "item", F.col("words").alias("test"), "n", "diagonal")).alias("candidates")))
    others = [c for c in docs.columns if carry and c != id_col]
    row = F.struct(*(docs[c].alias(f"c{k}") for k, c in enumerate(others)), F.lit(0).alias("end"))
    base = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"),
                       row.alias("row"))
    every = (base.join(found, base["id"].eqNullSafe(found["doc"]), "left")
             .select("id", "row", words(F.col("text")).alias("w"), "candidates"))

    def spans(c: Column) -> Column:
        """Starts of the item's windows that really occur on the diagonal."""
        first = F.greatest(F.lit(0), -c["diagonal"])
        size = F.least(F.size(c["test"]), F.size("w") - c["diagonal"]) - first
        same = F.zip_with(F.slice("w", c["diagonal"] + first + 1, size),
                          F.slice(c["test"], first + 1, size), lambda a, b: a == b)
        starts = F.filter(F.sequence(F.lit(0), size - c["n"]),
                          lambda s: F.forall(F.slice(same, s + 1, c["n"]), lambda x: x))
        at = F.transform(starts, lambda s: c["diagonal"] + first + s)
        return F.struct(c["item"].alias("item"), c["n"].alias("n"),
                        F.when(size >= c["n"], at).otherwise(F.array().cast("array<int>")).alias("at"))

    hits = F.filter(F.transform(F.coalesce("candidates", F.array().cast(
        found.schema["candidates"].dataType)), spans), lambda x: F.size(x["at"]) > 0)
    covered = F.size(F.array_distinct(F.flatten(F.transform("hits", lambda x: F.flatten(
        F.transform(x["at"], lambda s: F.sequence(s, s + x["n"] - 1)))))))
    judged = every.select("id", "row", F.size("w").cast("long").alias("n_words"),
                          hits.alias("hits")).select(
        "id", "row", "n_words", covered.cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(F.col("hits")["item"])).alias("items"))
    bad = (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    figures = [F.col("n_words"), F.col("n_hit"), F.col("items"), bad.alias("contaminated")]
    own = F.col("id").alias(id_col)
    if not carry:
        return judged.select(own, *figures)
    columns = [own if c == id_col else F.col(f"row.c{others.index(c)}").alias(c) for c in docs.columns]
    return judged.select(*columns, F.struct(*figures).alias(carry))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` against all of ``benchmark``."""
    judged = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return judged.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                         F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")

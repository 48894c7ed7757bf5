"""From raw documents to token ids: five stages, each one operator of ``llm``.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept
and returns a DataFrame with the columns of documents (the last: token ids);
``run`` writes each result as Parquet to the shared folder and reads it again, so
a lost executor costs at most the stage at hand.

In every stage: extra columns, whatever their names, are carried along (the last
returns ids and tokens only); repeated rows are rows of their own; an empty table gives
an empty table with the same columns; whole texts count, however long.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecheck.llm import bpe_replay, decontamination, jaccard_join, prefix_free_dedup, toxicity
from forecheck.llm.common import ship, stored, table


# a column that a stage adds and drops again
FIGURES = "__stage_figures"


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go. NULL, empty and blank texts have no windows and stay
    unless the share of toxic labels alone makes them toxic; the verdict on a long text
    follows its rate of toxic windows, not its length. Labels that are NULL, not 0 or 1,
    or of unknown ids teach nothing; without labels no document goes."""
    ship(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.accepted(docs, model)


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the one with the least id stays (NULL counts as
    the least, equal ids go by the hash of their texts). Documents with fewer than one
    shingle are in no group; of rows equal in id and text one stays."""
    ship(spark)
    return jaccard_join.first_of_groups(docs)


def suffix_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of repeated 100-byte strings go, but for their first occurrence; a
    document of which nothing is left goes as well."""
    ship(spark)
    done = prefix_free_dedup.dedup(docs, out=FIGURES)
    whole = (F.col("text") != "") | (F.col(f"{FIGURES}.n_bytes") == 0)
    return done.where(whole).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated with benchmark passages go. NULL and empty texts hold none
    and stay; rows that share an id, or have none, are judged each on its own text."""
    ship(spark)
    judged = decontamination.contamination(docs, table(spark, sf_dir, "benchmark"), carry=FIGURES)
    return judged.where(~F.col(f"{FIGURES}.contaminated")).select(docs.columns)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with their digests. NULL and empty texts have no
    tokens; NULL ids stay NULL."""
    import public_tokenizers

    ship(spark)
    return bpe_replay.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("ngram_jaccard_join", jaccard_stage),
    ("suffix_array_dedup", suffix_dedup_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("byte_bpe_encoding", encoding_stage),
]

# compression distances and sampled training rows are beyond SQL; tests compare
# the stages with brute force instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

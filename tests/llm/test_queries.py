"""Registered queries: oracle twins, the pipeline, and the optional entry."""

import os
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import conftest
from forecheck.llm.common import stored, table
from forecheck.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "benchmark", "pages", "conversations", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def test_one_query_per_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE_SQL) < set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, duck, name):
    got = QUERIES[name](spark, SF)
    want = duck.execute(ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    clean = lambda rows: sorted(str(tuple(r)) for r in rows)
    assert clean(got.select(*columns).collect()) == clean(want.fetchall())


def test_toxicity_query(spark):
    import zlib

    got = QUERIES["op8_toxicity"](spark, SF).collect()
    assert len(got) == table(spark, SF, "documents").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)


def test_pipeline_stages_take_effect(spark):
    import corpus_pipeline as pipeline
    from forecheck.llm import decontamination, jaccard_join, toxicity

    docs = table(spark, SF, "documents").withColumn("id", F.lit(1)).withColumn("judged", F.lit("x"))
    model = toxicity.fit(docs, table(spark, SF, "labels"))
    bad = {r.doc_id for r in toxicity.score(docs, model).where("predicted = 1").collect()}
    left = {r.doc_id for r in docs.collect()}
    for name, stage in pipeline.STAGES:
        done = stored(stage(spark, docs, SF), "test-stage")
        ids = [r.doc_id for r in done.select("doc_id").collect()]
        assert len(ids) == len(set(ids)) and set(ids) <= left
        if name == "toxicity":
            assert set(ids) == left - bad
        elif name == "ngram_jaccard_join":
            groups = jaccard_join.jaccard_join(docs).groupBy("group_id").count().count()
            assert len(ids) == groups
        elif name == "suffix_array_dedup":
            assert not done.where("n_chars != length(text)").count()
        elif name == "benchmark_decontamination":
            judged = decontamination.contamination(done, table(spark, SF, "benchmark"))
            assert not judged.where("contaminated").count()
        if name != pipeline.STAGES[-1][0]:
            assert done.columns == docs.columns
        left, docs = set(ids), done
    assert done.where("n_tokens != size(ids)").count() == 0
    assert pipeline.ORACLE_SQL is None


def test_pipeline_of_odd_and_no_rows(spark, odd_docs, no_docs):
    import corpus_pipeline as pipeline

    for frame in (odd_docs, no_docs):
        docs = frame
        for _, stage in pipeline.STAGES:
            docs = stored(stage(spark, docs, SF), "test-odd")
        assert docs.count() <= frame.count()
    assert docs.count() == 0


def test_entry_without_the_subpackage(tmp_path):
    """The entry imports and lists the other queries when the llm folders are gone."""
    import shutil
    import subprocess
    import sys

    shutil.copytree(f"{conftest.ROOT}/forecheck", tmp_path / "forecheck", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{conftest.ROOT}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'plan_snapshot' in q and not any(n.startswith('op') and n[2].isdigit() for n in q); assert 'pipeline' not in q; assert set(e.oracle_sql()) == set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120,
                   env={**os.environ, "PYTHONPATH": str(tmp_path)})

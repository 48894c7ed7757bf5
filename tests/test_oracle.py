"""Every registered query against its DuckDB twin on the smallest driver tables."""

import os
import sys

import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "scripts"))

from check_oracle import canon, duck  # noqa: E402
from forecheck.plans.oracle_sql import oracle_queries  # noqa: E402
from forecheck.plans.registry import QUERIES  # noqa: E402

SQL = oracle_queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.sql(SQL[name])
    assert sorted(df.columns) == sorted(res.columns)
    expected = res.fetchall()
    assert len(rows) == len(expected)
    assert canon(df.columns, rows) == canon(res.columns, expected)


def test_entry_smoke(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.columns == ["l0_name", "l1_name", "explainable_count", "non_explainable_count"]
    assert df.count() > 0


def test_every_report_query_has_sql():
    from __spark_entry__ import oracle_sql, queries

    assert set(SQL) == set(QUERIES) <= set(queries()) and set(SQL) <= set(oracle_sql())


@pytest.mark.parametrize("left", ["nothing", "empty folder", "bytecode only"])
def test_entry_without_the_optional_subpackage(tmp_path, left):
    """The driver may delete the training-data folders, or leave an empty shell of them."""
    import shutil
    import subprocess

    shutil.copytree(f"{ROOT}/forecheck", tmp_path / "forecheck",
                    ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    if left != "nothing":
        (tmp_path / "forecheck/llm/__pycache__").mkdir(parents=True)
        shutil.copy(f"{ROOT}/corpus_pipeline.py", tmp_path)
    if left == "bytecode only":
        (tmp_path / "forecheck/llm/__pycache__/queries.cpython-313.pyc").write_bytes(b"old")
    code = ("import __spark_entry__ as e; q = e.queries(); assert 'plan_snapshot' in q; "
            "assert 'pipeline' not in q and set(e.oracle_sql()) == set(q)")
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120,
                   env={**os.environ, "PYTHONPATH": str(tmp_path)})


def test_entry_reports_a_broken_subpackage(tmp_path):
    """Only a missing subpackage is passed over; an error inside it is not."""
    import shutil
    import subprocess

    shutil.copytree(f"{ROOT}/forecheck", tmp_path / "forecheck",
                    ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    (tmp_path / "forecheck/llm").mkdir()
    (tmp_path / "forecheck/llm/__init__.py").write_text("")
    (tmp_path / "forecheck/llm/queries.py").write_text("import a_module_that_is_not_there")
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; e.queries()"], cwd=tmp_path,
                          timeout=120, capture_output=True, text=True,
                          env={**os.environ, "PYTHONPATH": str(tmp_path)})
    assert done.returncode and "a_module_that_is_not_there" in done.stderr

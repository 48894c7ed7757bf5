"""NOT IN / IN-flag helpers against DuckDB's SQL semantics on random key sets
(NULLs included)."""

import duckdb
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from forecheck.operators.relational import flag_in, not_in_flag

keys = st.lists(st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d"])), max_size=6)


def _duck(left, right, sql):
    con = duckdb.connect()
    con.sql("CREATE TABLE l(k VARCHAR)")
    con.sql("CREATE TABLE r(k VARCHAR)")
    if left:
        con.executemany("INSERT INTO l VALUES (?)", [(k,) for k in left])
    if right:
        con.executemany("INSERT INTO r VALUES (?)", [(k,) for k in right])
    return sorted(tuple("" if v is None else v for v in row) for row in con.sql(sql).fetchall())


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(left=keys, right=keys)
def test_not_in_matches_sql(spark, left, right):
    l = spark.createDataFrame([(k,) for k in left], "k string")
    r = spark.createDataFrame([(k,) for k in right], "k string")
    found = r.where("k is not null").distinct().select("k", F.lit(True).alias("hit"))
    joined = l.join(found, "k", "left")
    kept = joined.where(not_in_flag(F.col("k"), F.coalesce("hit", F.lit(False)), r))
    got = sorted(("" if row.k is None else row.k,) for row in kept.collect())
    assert got == _duck(left, right, "SELECT k FROM l WHERE k NOT IN (SELECT k FROM r)")


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(left=keys, right=keys)
def test_flag_in_matches_sql(spark, left, right):
    l = spark.createDataFrame([(k,) for k in left], "k string")
    r = spark.createDataFrame([(k,) for k in right], "k string").distinct()
    got = sorted(("" if row.k is None else row.k, str(row.f))
                 for row in flag_in(l, F.col("k"), r, "f").collect())
    want = _duck(left, right, "SELECT k, CAST(CASE WHEN k IN (SELECT k FROM r) THEN 1 ELSE 0 END "
                              "AS VARCHAR) FROM l")
    assert got == want

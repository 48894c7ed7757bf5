"""Heavy keys and the salted left join, against plain joins and exact counts."""

import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from forecheck.config import Sizing
from forecheck.operators import skew, supply
from forecheck.operators.relational import flag_in, flags_in, membership


@pytest.fixture(scope="module")
def right(spark):
    """A third of the rows hold one key; some keys are NULL, some rows repeat."""
    rows = [("hot", k % 3, k) for k in range(3000)] + [(f"k{k % 700}", 0, k) for k in range(5600)]
    rows += [(None, 1, k) for k in range(300)] + [("k1", 0, 1)] * 20
    return spark.createDataFrame(rows, "a string, b int, v int").repartition(8)


def test_heavy_keys_are_exact_and_sketches_merge(spark, right):
    counts = Counter((r.a, r.b) for r in right.collect() if r.a is not None)
    total = sum(counts.values())
    found = skew.heavy_keys(right, ["a", "b"])
    want = {k: n for k, n in counts.items() if n >= total * skew.HEAVY_SHARE}
    assert {(r.a, r.b) for r in found.table.collect()} == set(want) and len(want) == 3
    assert all(r.salts >= want[(r.a, r.b)] / (total * skew.HEAVY_SHARE) for r in found.table.collect())
    assert skew.heavy_keys(right.where("a != 'hot'"), ["a"]) is None
    assert skew.heavy_keys(right.limit(0), ["a"]) is None
    # the sketch of two parts equals the sketch of the whole, and never counts too low
    parts = [skew.key_sketch(right.where(F.col("v") % 2 == k), ["a", "b"]) for k in (0, 1)]
    merged = {(r.row, r.cell): r.n for r in skew.merge_sketches(*parts).collect()}
    whole = {(r.row, r.cell): r.n for r in skew.key_sketch(right, ["a", "b"]).collect()}
    assert merged == whole and len(whole) <= skew.SKETCH_ROWS * skew.SKETCH_CELLS
    stored = skew.heavy_keys(right, ["a", "b"], skew.merge_sketches(*parts))
    assert {(r.a, r.b) for r in stored.table.collect()} == set(want)


def test_salted_join_spreads_a_hot_key(spark, right):
    left = spark.createDataFrame([("hot", 0, "x"), ("hot", 9, "y"), ("k1", 0, "z"), (None, 1, "n"),
                                  ("none", 0, "m"), ("hot", 0, "x")], "a string, b int, w string")
    heavy = skew.heavy_keys(right, ["a", "b"])
    plain = left.join(right, ["a", "b"], "left")
    salted = skew.salted_left_join(left, right, ["a", "b"], heavy)
    assert salted.columns == plain.columns
    assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled",
                                          "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        def largest(df):
            tasks = df.groupBy(F.spark_partition_id()).count().collect()
            return max(r["count"] for r in tasks), len(tasks)

        joined = skew.salted_left_join(left, right, ["a", "b"], heavy)
        most, tasks = largest(joined.where("a = 'hot'"))
        assert tasks >= 6 and most < 0.4 * 2000, (most, tasks)
        assert largest(left.join(right, ["a", "b"], "left").where("a = 'hot'"))[0] >= 2000
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 2)), max_size=12),
       st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 2)), max_size=12))
def test_salted_join_equals_plain_join(spark, left, right):
    l = spark.createDataFrame(left, "k string, v int")
    r = spark.createDataFrame(right, "k string, w int")
    heavy = skew.heavy_keys(r, ["k"], share=0.3)
    got = skew.salted_left_join(l, r, ["k"], heavy)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, l.join(r, "k", "left").collect()))


def test_po_chain_with_and_without_salts(spark, small_report):
    """All keys count as tables to search; the chain stays the same."""
    from conftest import SF_SMALL
    from forecheck.plans.report import ForecastValidation
    from forecheck.sources import fixtures
    from forecheck.sources.tables import Tables

    tables = Tables.from_driver_tables(spark, SF_SMALL)
    hot = tables.packing_list.limit(1)
    many = hot.drop("quantity_shipped", "inventory_packing_list_summary_id").crossJoin(
        spark.range(4000).select(F.col("id").cast("double").alias("quantity_shipped"),
                                 F.col("id").cast("int").alias("inventory_packing_list_summary_id")))
    packing = tables.packing_list.unionByName(many.select(tables.packing_list.columns))
    tables._built["packing_list"] = packing
    tables._built["warehouse_receipt"] = tables.warehouse_receipt.unionByName(
        many.select("po_number", F.col("sku").alias("product_code"), "container_number",
                    "inventory_packing_list_summary_id", F.col("date_shipped").alias("date_received")))
    with ForecastValidation(tables, fixtures.PARAMS, Sizing(skew_min_bytes=0)) as r:
        assert r._heavy["heavy_lines"].table.count() == 1 and r._heavy["heavy_shipments"] is None
        plain = supply.po_status(tables.purchase_order, tables.packing_list, tables.warehouse_receipt,
                                 r.p.as_of, r.p.po_brands, r.p.default_brand)
        assert r.chain.exceptAll(plain).count() == 0 and plain.exceptAll(r.chain).count() == 0
        units = r.on_order
    with ForecastValidation(tables, fixtures.PARAMS) as r:
        assert r._heavy == {"heavy_lines": None, "heavy_shipments": None}
        assert units.exceptAll(r.on_order).count() == 0 and r.on_order.exceptAll(units).count() == 0


def test_po_chain_reads_each_input_once(small_report):
    plan = small_report.chain._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 2 and "LeftAnti" not in plan and "Union" not in plan
    # purchase orders are a join of two tables in the test views
    assert plan.count("Relation [") == 4


def test_membership_flags_equal_single_flags(spark):
    rng = random.Random(3)
    df = spark.createDataFrame([(rng.choice(["a", "b", "c", "d", None]),) for _ in range(40)], "k string")
    sets = {n: spark.createDataFrame([(rng.choice(["a", "b", "c", None]),) for _ in range(m)], "x string")
            for n, m in (("one", 2), ("two", 0), ("three", 6))}
    got = flags_in(df, F.col("k"), membership(sets), sets)
    want = df
    for name, keys in sets.items():
        want = flag_in(want, F.col("k"), keys.distinct(), name)
    assert got.columns == want.columns == ["k", "one", "two", "three"]
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))
    # one join for all sets
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1

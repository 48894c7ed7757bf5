"""Trap frames (FIXTURES.md section 6): semantics that are easy to get wrong."""

import datetime as dt

from pyspark.sql import functions as F

from forecheck.operators import comparable, explain, forecast, plan, supply
from forecheck.operators.relational import flag_in, not_in_flag


def test_q1_window_frame_as_written_vs_latest(spark):
    hist = spark.createDataFrame(
        [("p", 1999, 1, 199901, 10.0, 500.0, 1.0), ("p", 1999, 2, 199902, 10.0, 50.0, 1.0),
         ("p", 1998, 1, 199801, 10.0, 50.0, 1.0), ("p", 1998, 2, 199802, 10.0, 50.0, 1.0)],
        "product_code string, fiscal_year bigint, fiscal_week bigint, fiscal_year_week bigint, "
        "qty double, oh double, msrp double")
    ty = comparable.weekly_history(hist, 1999, "qty_ty")
    ly = comparable.weekly_history(hist, 1998, "qty_ly")
    pick = lambda on_hand: comparable.comparable_filter(
        comparable.comparable_candidates(ty, ly, on_hand), (0.5, 1.5), 0.3, 100.0)
    as_written, latest = pick("as_written"), pick("latest")
    assert [r[0] for r in as_written.collect()] == ["p"]
    assert latest.count() == 0
    lv = {r.fiscal_year_week: r.most_recent_oh
          for r in comparable.on_hand_last_value(ty).collect()}
    assert lv == {200001: 500.0, 200002: 50.0}


def _units(spark, rows):
    return spark.createDataFrame(rows, "l0_name string, sku string, units double")


def test_q5_on_order_join_as_written(spark):
    fct = _units(spark, [("B1", "s1", 10.0), ("B2", "s1", 10.0), ("B1", "s2", 10.0)])
    act = spark.createDataFrame([], "l0_name string, sku string, ty_units double, "
                                    "lt_units double, lf_units double")
    oh = _units(spark, [("B1", "s1", 5.0)])
    oo = _units(spark, [("B1", "s1", 1.0), ("B2", "s1", 2.0), ("B1", "s2", 3.0)])
    out = explain.explainability(fct, act, oh, oo)
    got = sorted((r.l0_name, r.sku, r.oo_units) for r in out.collect())
    assert got == [("B1", "s1", 1.0), ("B1", "s1", 2.0), ("B1", "s2", None), ("B2", "s1", None)]
    own = explain.explainability(fct, act, oh, oo, on_order_join="own_brand")
    got = sorted((r.l0_name, r.sku, r.oo_units) for r in own.collect())
    assert got == [("B1", "s1", 1.0), ("B1", "s2", 3.0), ("B2", "s1", 2.0)]


def test_q7_not_in_with_null_keeps_nothing(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")

    def kept(keys):
        found = keys.where("k is not null").select("k", F.lit(True).alias("hit"))
        flagged = df.join(found, "k", "left")
        hit = F.coalesce("hit", F.lit(False))
        return [r.k for r in flagged.where(not_in_flag(F.col("k"), hit, keys)).collect()]

    assert kept(spark.createDataFrame([("a",), (None,)], "k string")) == []
    assert kept(spark.createDataFrame([("a",)], "k string")) == ["b"]
    assert len(kept(spark.createDataFrame([], "k string"))) == 3


def test_q6_concatenated_key_collision(spark):
    df = spark.createDataFrame([("AB", "1")], "l0_name string, sku string")
    keys = spark.createDataFrame([("AB1",)], "key string")   # from ('A', 'B1')
    out = flag_in(df, F.concat("l0_name", "sku"), keys, "flag")
    assert out.first().flag == 1


def test_flag_in_does_not_multiply(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    keys = spark.createDataFrame([("a",), ("a",)], "k string").distinct()
    out = flag_in(df, F.col("k"), keys, "f")
    assert sorted((r.k or "", r.f) for r in out.collect()) == [("", 0), ("a", 1), ("b", 0)]


def test_q12_eta_rules(spark):
    as_of = dt.date(2001, 6, 30)
    d = dt.date
    po = spark.createDataFrame(
        [("BR1", "s1", 1, d(2001, 1, 1), d(2001, 3, 1), 5.0, "Online"),    # overdue, unshipped
         ("BR1", "s2", 2, d(2001, 1, 1), d(2001, 3, 1), 6.0, "Online"),    # overdue, shipped+received
         ("BR1", "s3", 3, d(2001, 1, 1), None, 7.0, "Online"),             # NULL ETA
         ("ZZ", "s4", 4, d(2001, 1, 1), d(2001, 9, 1), 8.0, "Online")],    # future, unknown brand
        "l0_name string, sku string, po_number bigint, po_date date, intial_eta date, "
        "ordered_quantity double, channel string")
    pl = spark.createDataFrame([(2, "s2", 9, 1, d(2001, 2, 1), 6.0)],
                               "po_number bigint, sku string, container_number bigint, "
                               "inventory_packing_list_summary_id int, date_shipped date, "
                               "quantity_shipped double")
    wr = spark.createDataFrame([(2, "s2", 9, 1, d(2001, 3, 5))],
                               "po_number bigint, product_code string, container_number bigint, "
                               "inventory_packing_list_summary_id int, date_received date")
    chain = supply.po_status(po, pl, wr, as_of, ("BR1",), "BR0")
    got = {r.sku: (r.l0_name, r.initial_eta) for r in chain.collect()}
    assert got == {"s1": ("BR1", d(2001, 7, 1)), "s2": ("BR1", d(2001, 3, 1)),
                   "s3": ("BR1", None), "s4": ("BR0", d(2001, 9, 1))}


def test_q20_missing_bridge_gives_null_path_and_zero_flags(spark):
    base = spark.createDataFrame([("Online", "HC9", 200001, 0.05, 1.0, 2.0)],
                                 "channel string, hierarchy_code string, fiscal_year_week bigint, "
                                 "scenario1 double, plan_units double, plan_aur double")
    bridge = spark.createDataFrame([], "l0_name string, l1_name string, l2_name string, "
                                       "l3_name string, l4_name string, l5_name string, "
                                       "product_code string, product_id bigint, hierarchy_code string")
    wp = spark.createDataFrame([], "channel string, hierarchy_code string, fiscal_year_week bigint, "
                                   "scenario1 double, wp double")
    ly = spark.createDataFrame([], "channel string, hierarchy_code string, fiscal_year_week bigint, "
                                   "scenario_ly double, qty_ly double, aur_ly double")
    lly = spark.createDataFrame([], "channel string, hierarchy_code string, fiscal_year_week bigint, "
                                    "scenario_lly double, qty_lly double, aur_lly double")
    aligned = plan.align_plan_years(base, bridge, wp, ly, lly)
    fc = spark.createDataFrame([], "product_code string, fiscal_year bigint, fiscal_week bigint, "
                                   "fiscal_year_week bigint, scenario1 double, qty double")
    codes = spark.createDataFrame([("x",)], "product_code string")
    assert aligned.first().product_code is None
    out = plan.validation_flags(base, bridge, wp, ly, lly, fc, codes, codes, codes, codes,
                                "Online", 200043).first()
    assert out.product_code is None and out.l0_name is None
    assert (out.comp_flag_30, out.comp_flag_50, out.product_with_sales, out.new_prod_flag) == (0, 0, 0, 0)


def test_default_branch_needs_never_validated_code(spark):
    cand = spark.createDataFrame(
        [("B", "s", "HC1", "Online", "Online", 200001, 0.05, 1.0),   # validated code: neither branch
         ("B", "s", "HC2", "Online", "Online", 200001, 0.05, 2.0),   # never validated, default pct
         ("B", "s", "HC2", "Online", "Online", 200001, 0.02, 3.0),   # never validated, other pct
         ("B", "s", "HC1", "Online", "Online", 200002, 0.03, 4.0)],  # validated triple
        "brand string, sku string, hierarchy_code string, channel string, sub_channel string, "
        "fiscal_year_week bigint, percent_off double, w_sls_u double")
    disc = spark.createDataFrame([("HC1", 200002, 0.03)],
                                 "hierarchy_code string, fiscal_year_week bigint, percent_off double")
    codes = disc.select("hierarchy_code").distinct()
    comp = spark.createDataFrame([("Bs",)], "key string")
    out = forecast.select_forecast(cand, disc, codes, comp, 0.05)
    got = sorted((r.hierarchy_code, r.percent_off, r.w_sls_u, r.comp_flag) for r in out.collect())
    assert got == [("HC1", 0.03, 4.0, 1), ("HC2", 0.05, 2.0, 1)]


def _orders(spark, lines, shipped, received):
    day = dt.date.fromisoformat
    po = spark.createDataFrame(
        [(n, s, "B0", day("2001-05-01"), 10.0, "Online", eta) for n, s, eta in lines],
        "po_number string, sku string, l0_name string, po_date date, ordered_quantity double, "
        "channel string, intial_eta date")
    packing = spark.createDataFrame(
        [(n, s, "c", 1, day("2001-06-01"), q) for n, s, q in shipped],
        "po_number string, sku string, container_number string, "
        "inventory_packing_list_summary_id int, date_shipped date, quantity_shipped double")
    receipt = spark.createDataFrame(
        [(n, s, "c", 1, day("2001-06-20")) for n, s in received],
        "po_number string, product_code string, container_number string, "
        "inventory_packing_list_summary_id int, date_received date")
    return po, packing, receipt


def test_overdue_line_arrives_tomorrow_within_the_week(spark):
    """As of a Friday, tomorrow opens the on-order week: an overdue line counts there."""
    day = dt.date.fromisoformat
    friday = day("2001-06-29")
    frames = _orders(spark, [("1", "s", day("2001-01-05")), ("2", "s", day("2001-07-02")),
                             ("3", "s", day("2001-01-05")), ("4", "s", day("2001-08-20"))],
                     [("3", "s", 4.0), ("2", "s", 7.0)], [("3", "s")])
    calendar = spark.createDataFrame(
        [(d, 200127 if day("2001-06-30") <= d <= day("2001-07-06") else 200100)
         for d in (day("2001-01-01") + dt.timedelta(k) for k in range(300))],
        "date date, fy_week_id bigint")
    span = supply.week_span(calendar, 200127)
    cut = supply.po_status(*frames, friday, ("B0",), "B0", span)
    whole = supply.po_status(*frames, friday, ("B0",), "B0")
    units = lambda c: [tuple(r) for r in supply.on_order_units(
        supply.open_by_arrival(c, calendar, friday), "Online", 200127).collect()]
    # line 1 is overdue and open (10), line 2 is on its way (7), line 3 was received
    assert units(cut) == units(whole) == [("B0", "s", "Online", 17.0)]


def test_eta_bound_is_below_the_first_exchange(spark):
    day = dt.date.fromisoformat
    frames = _orders(spark, [("1", "s", day("2001-01-05"))], [], [])
    span = (F.lit(day("2001-06-30")), F.lit(day("2001-07-06")))
    plan_ = supply.po_status(*frames, day("2001-06-29"), ("B0",), "B0", span)
    text = plan_._jdf.queryExecution().optimizedPlan().toString()
    lines_ = text.splitlines()
    # the deepest operators that mention the ETA sit on the purchase orders, under their DISTINCT
    scans = [k for k, t in enumerate(lines_) if "LogicalRDD" in t and "intial_eta" in t]
    assert scans and all("intial_eta" in lines_[k - 1] and "Filter" in lines_[k - 1] for k in scans[:1])


def test_one_hot_order_line_keeps_all_pairs(spark):
    day = dt.date.fromisoformat
    lines = [("hot", "s", day("2001-07-02"))] + [(str(k), "s", day("2001-07-02")) for k in range(20)]
    shipped = [("hot", "s", float(q)) for q in range(500)]
    chain = supply.po_status(*_orders(spark, lines, shipped, []), day("2001-06-29"), ("B0",), "B0")
    # 500 different shipments of the hot line, the other lines collapse to one
    assert chain.count() == 501

"""Supply operators: purchase-order chain, on-order units, on-hand snapshot."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecheck.functions import fiscal
from forecheck.operators.relational import bounded_broadcast
from forecheck.operators.skew import HeavyKeys, salted_left_join

CHAIN_COLUMNS = ("l0_name", "sku", "po_date", "date_shipped", "quantity_shipped",
                 "warehouse_date", "ordered_quantity", "channel", "initial_eta")


LINE_KEY = ["po_number", "sku"]
SHIPMENT_KEY = [*LINE_KEY, "container_number", "inventory_packing_list_summary_id"]


def receipts(receipt: DataFrame) -> DataFrame:
    """Receipt lines by the packing list's key. Output: ``SHIPMENT_KEY``, warehouse_date."""
    return receipt.select(
        "po_number", F.col("product_code").alias("sku"), "container_number",
        "inventory_packing_list_summary_id", F.to_date("date_received").alias("warehouse_date"))


def po_status(po: DataFrame, packing: DataFrame, receipt: DataFrame, as_of: dt.date,
              brands: tuple[str, ...], default_brand: str,
              arriving: tuple[Column, Column] | None = None,
              heavy_lines: HeavyKeys | None = None,
              heavy_shipments: HeavyKeys | None = None,
              tasks: int | None = None) -> DataFrame:
    """Purchase-order lines with their shipments and receipts, distinct.

    * brand outside ``brands`` (or NULL) becomes ``default_brand``;
    * receipts attach through the packing list's keys, so a PO line without a
      packing row never gets a receipt;
    * an ETA on or before tomorrow whose line is not shipped or not received
      moves to tomorrow (tomorrow = ``as_of`` + 1).

    ``arriving`` (first and last day) keeps the lines whose final ETA lies in
    between. What that implies for the stored ETA is tested on the purchase
    orders, before any shuffle; the few remaining keys then cut packing list and
    receipts with semi joins.

    The result drops ``po_number``, so identical lines of different orders
    collapse. Both sides are de-duplicated on (join key + kept columns) before
    the join: that cannot change a DISTINCT result and keeps the join from
    pairing up duplicate rows of one order line. Each input is read once, each
    step is one left join. A hot key on the left is split by adaptive execution;
    ``heavy_lines`` (of the packing list, by ``LINE_KEY``) and ``heavy_shipments`` (of
    ``receipts``, by ``SHIPMENT_KEY``) salt the keys that are hot on the right.
    ``tasks`` deals both joins out over that many tasks where no heavy keys were found;
    None leaves their number to adaptive execution.
    Output columns: ``CHAIN_COLUMNS``.
    """
    key = LINE_KEY
    tomorrow = F.date_add(F.lit(as_of), 1)
    if arriving is not None:
        first, last = arriving
        po = po.where(F.col("intial_eta").between(first, last)
                      | ((F.col("intial_eta") <= tomorrow) & tomorrow.between(first, last)))
    lines = (po.select(
        F.when(F.col("l0_name").isin(list(brands)), F.col("l0_name"))
         .otherwise(F.lit(default_brand)).alias("l0_name"),
        "sku", "po_number", F.to_date("po_date").alias("po_date"),
        "ordered_quantity", "channel", "intial_eta").distinct())
    wr = receipts(receipt)
    if arriving is not None:
        wanted = po.select(*key).distinct()
        packing, wr = packing.join(wanted, key, "left_semi"), wr.join(wanted, key, "left_semi")
    if tasks is not None and heavy_lines is None:
        lines = lines.repartition(tasks, *key)
        if heavy_shipments is None:
            packing = packing.repartition(tasks, *SHIPMENT_KEY)
    shipped = (salted_left_join(packing, wr, SHIPMENT_KEY, heavy_shipments)
               .select(*key, "date_shipped", "quantity_shipped", "warehouse_date")
               .distinct())
    eta = (F.when((F.col("intial_eta") <= tomorrow)
                  & (F.col("date_shipped").isNull() | F.col("warehouse_date").isNull()), tomorrow)
           .otherwise(F.col("intial_eta")))
    chain = (salted_left_join(lines, shipped, key, heavy_lines)
             .select("l0_name", "sku", "po_date", "date_shipped", "quantity_shipped",
                     "warehouse_date", "ordered_quantity", "channel", eta.alias("initial_eta")))
    if arriving is not None:
        chain = chain.where(F.col("initial_eta").between(first, last))
    return chain.distinct()


def open_by_arrival(chain: DataFrame, calendar: DataFrame, as_of: dt.date) -> DataFrame:
    """Open units per brand, arrival date, arrival week, SKU and channel.

    Only lines whose order date is a calendar date and whose ETA is a calendar
    date after ``as_of``. ``oo_temp``: ordered units not shipped and not
    received; ``oo_temp_it``: shipped units not yet received.
    """
    cal = calendar.select("date", "fy_week_id")
    order_day = cal.select(F.col("date").alias("__po_day"))
    arrival = cal.where(F.col("date") > F.lit(as_of))
    rows = (chain.where(F.col("l0_name").isNotNull() & F.col("sku").isNotNull()
                        & (F.col("initial_eta") > F.lit(as_of)))
            .join(order_day, F.col("po_date") == F.col("__po_day"))
            .join(arrival, F.col("initial_eta") == F.col("date"))
            .where(F.col("fy_week_id").isNotNull()))
    open_units = F.when(F.col("po_date").isNotNull() & F.col("date_shipped").isNull()
                        & F.col("warehouse_date").isNull(), F.col("ordered_quantity")).otherwise(0.0)
    in_transit = F.when(F.col("po_date").isNotNull() & F.col("date_shipped").isNotNull()
                        & F.col("warehouse_date").isNull(), F.col("quantity_shipped")).otherwise(0.0)
    return (rows.groupBy("l0_name", "date", "fy_week_id", "sku", "channel")
            .agg(F.sum(open_units).alias("oo_temp"), F.sum(in_transit).alias("oo_temp_it")))


def week_span(calendar: DataFrame, week: int) -> tuple[Column, Column]:
    """First and last calendar date of a fiscal week, as scalar subqueries."""
    days = calendar.where(F.col("fy_week_id") == week)
    return days.agg(F.min("date")).scalar(), days.agg(F.max("date")).scalar()


def on_order_units(arrivals: DataFrame, channel: str, week: int) -> DataFrame:
    """Open plus in-transit units arriving in one week, per brand, SKU, channel.

    A row where either part is NULL adds nothing. Output: l0_name, sku, channel, units.
    """
    return (arrivals.where((F.col("channel") == channel) & (F.col("fy_week_id") == week))
            .groupBy("l0_name", "sku", "channel")
            .agg(F.sum(F.col("oo_temp") + F.col("oo_temp_it")).alias("units")))


def on_hand_snapshot(inventory: DataFrame, dates: DataFrame, platform: str,
                     as_of: dt.date) -> DataFrame:
    """Stock rows dated on the Saturday starting ``as_of``'s week, for one
    platform, only if that Saturday is listed in ``dates``. Not aggregated.

    Output: l0_name, sku, platform, units.
    """
    week_start = fiscal.saturday_on_or_before_py(as_of)
    # one constant date, distinct: at most one row, safe to broadcast
    day = bounded_broadcast(dates.where(F.col("date") == F.lit(week_start))
                            .select(F.col("date").alias("__day")).distinct())
    return (inventory.where(F.col("platform") == platform)
            .join(day, F.to_date("inventorydate") == F.col("__day"))
            .select("l0_name", "sku", "platform", F.col("oh").alias("units")))

"""Voucher, promotion and delivery operators."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.functions.dates import add_months_oracle, lit_date
from martlake.functions.money import cents, round_ratio
from martlake.functions.ranking import global_rank

MONEY = "decimal(18,2)"


def _amount():
    return F.col("quantity") * F.col("unit_price")


def voucher_redemption(t, as_of: _dt.date, months: int = 24, min_redemptions: int = 10) -> DataFrame:
    """Q23: per voucher over the last ``months`` months: redemptions, orders, sales.

    The reference joins redemptions to order lines, so an order's sales count once per
    redemption row of the voucher on it, and redemptions of orders without lines drop out.
    The same numbers come from per-order sales times redemptions per (voucher, order),
    without building the repeated rows.
    """
    since = add_months_oracle(as_of, -months)
    o = t["orders"].filter(F.col("order_date") >= F.lit(since)).select("order_id")
    sales = t["order_item"].join(o, "order_id").groupBy("order_id").agg(F.sum(_amount()).alias("_s"))
    red = (t["redemption"].groupBy("voucher_id", "order_id").agg(F.count("redemption_id").alias("_k"))
           .join(sales, "order_id"))
    agg = red.groupBy("voucher_id").agg(
        F.sum("_k").alias("redemption_count"), F.count("order_id").alias("order_count"),
        F.sum(F.col("_s") * F.col("_k")).cast(MONEY).alias("total_sales"))
    return agg.filter(F.col("redemption_count") >= min_redemptions)


def voucher_effectiveness_top(t, as_of: _dt.date, k: int = 10, months: int = 24, min_redemptions: int = 10) -> DataFrame:
    """Q24: top ``k`` vouchers by redemptions then sales, with sales per order (2 dp), ranked."""
    v = (voucher_redemption(t, as_of, months, min_redemptions)
         .join(t["voucher"].select("voucher_id", "voucher_type", "voucher_value"), "voucher_id"))
    order = [F.col("redemption_count").desc(), F.col("total_sales").desc(), F.col("voucher_id")]
    top = v.orderBy(*order).limit(k)
    top = global_rank(top, order, name="rank", kind="row_number", bounded=True)
    return top.select("rank", "voucher_id", "voucher_type", "voucher_value", "redemption_count", "total_sales",
                      round_ratio(cents("total_sales"), F.col("order_count")).alias("avg_order_value"))


def voucher_label(vtype, value):
    """'RM x' for Amount vouchers, 'x%' for Percentage ones (x with 2 decimals)."""
    txt = F.format_number(value, 2)
    return F.when(vtype == "Amount", F.concat(F.lit("RM "), txt)).when(vtype == "Percentage", F.concat(txt, F.lit("%")))


def member_voucher_redemptions(t, member_id=None) -> DataFrame:
    """A member's (or every member's) orders with each redeemed voucher and its value label."""
    o = t["orders"].filter(F.col("member_id").isNotNull())
    if member_id is not None:
        o = o.filter(F.col("member_id") == member_id)
    r = t["redemption"].join(t["voucher"], "voucher_id")
    j = o.select("member_id", "order_id", "order_date", "order_type").join(r, "order_id")
    return j.select("member_id", "order_id", "order_date", "order_type", "redemption_id", "voucher_id", "voucher_type",
                    "voucher_value", voucher_label(F.col("voucher_type"), F.col("voucher_value")).alias("voucher_label"),
                    "redeemed_date")


def promotion_lines(t, promotion_id=None) -> DataFrame:
    """Q38: promotion header joined with its detail lines."""
    p = t["promotion"]
    if promotion_id is not None:
        p = p.filter(F.col("promotion_id") == promotion_id)
    return p.join(t["promotion_details"], "promotion_id").select(
        "promotion_id", "promotion_name", "status", "start_date", "end_date", "item_id", "discount_type", "discount_value")


def active_promotions(t, as_of, items=None) -> DataFrame:
    """Q39: promotion lines whose promotion covers ``as_of`` (start <= as_of <= end)."""
    ts = F.lit(as_of).cast("timestamp_ntz")
    p = t["promotion"].filter((F.col("start_date").cast("timestamp_ntz") <= ts) & (ts <= F.col("end_date").cast("timestamp_ntz")))
    d = t["promotion_details"]
    if items is not None:
        d = d.filter(F.col("item_id").isin(list(items)))
    return d.join(p.select("promotion_id", "promotion_name", "start_date", "end_date"), "promotion_id").select(
        "promotion_id", "promotion_name", "start_date", "end_date", "item_id", "discount_type", "discount_value")


def order_line_totals(t, order_id=None) -> DataFrame:
    """Q40: quantity x price per line of an order (or of every order)."""
    oi = t["order_item"]
    if order_id is not None:
        oi = oi.filter(F.col("order_id") == order_id)
    return oi.select("order_id", "item_id", "quantity", "unit_price", _amount().cast(MONEY).alias("line_total"))


def order_member_points(t, order_id=None) -> DataFrame:
    """Q41: point rows of the member(s) who placed the order(s).

    With one order this is the reference's lookup. For all orders, each point row of a
    member who placed any order is returned once (a semi-join on member), instead of
    pairing every order of a member with every point row of that member.
    """
    o = t["orders"].filter(F.col("member_id").isNotNull())
    if order_id is not None:
        o = o.filter(F.col("order_id") == order_id)
    return (t["point_history"].join(o.select("member_id"), "member_id", "left_semi")
            .select("member_id", "point_redemption_id", "amount", "transaction_type", "redemption_date"))


def delivery_company_performance(t, start, end) -> DataFrame:
    """Per courier for orders between ``start`` and ``end`` (inclusive days): total,
    delivered, out for delivery, pending, preparing (cancelled only in the total), and the
    completion percentage rounded to 2."""
    end_excl = lit_date(end) + F.expr("INTERVAL 1 DAY")
    o = (t["orders"].filter((F.col("order_date") >= lit_date(start)) & (F.col("order_date") < end_excl))
         .select("order_id"))
    d = t["delivery"].join(o, "order_id", "left_semi")
    st = F.col("delivery_status")
    c = lambda v: F.sum(F.when(st == v, 1).otherwise(0)).cast("bigint")
    agg = d.groupBy("company_id").agg(
        F.count("delivery_id").alias("total_deliveries"), c("Delivered").alias("delivered"),
        c("Out for Delivery").alias("out_for_delivery"), c("Pending").alias("pending"), c("Preparing").alias("preparing"))
    return (agg.join(t["delivery_company"].select("company_id", "company_name"), "company_id")
               .select("company_id", "company_name", "total_deliveries", "delivered", "out_for_delivery", "pending",
                       "preparing",
                       round_ratio(F.col("delivered") * 10000, F.col("total_deliveries")).alias("completion_rate")))


def delivery_management_summary(t, start, end) -> DataFrame:
    """Overall deliveries, delivered and rate; best courier (highest rate, then most
    deliveries) and lowest courier (lowest rate; among equal rates the first in the
    report order, i.e. most deliveries). Company id breaks remaining ties."""
    perf = delivery_company_performance(t, start, end)
    key = F.struct(F.col("completion_rate"), F.col("total_deliveries"), (-F.col("company_id")).alias("c"))
    low = F.struct((-F.col("completion_rate")).alias("r"), F.col("total_deliveries"), (-F.col("company_id")).alias("c"))
    agg = perf.agg(
        F.sum("total_deliveries").cast("bigint").alias("total_deliveries"),
        F.sum("delivered").cast("bigint").alias("delivered"),
        F.max_by("company_name", key).alias("best_company"),
        F.max_by("completion_rate", key).alias("best_rate"),
        F.max_by("company_name", low).alias("lowest_company"),
        F.max_by("completion_rate", low).alias("lowest_rate"))
    return agg.select("total_deliveries", "delivered",
                      round_ratio(F.col("delivered") * 10000, F.col("total_deliveries")).alias("overall_rate"),
                      "best_company", "best_rate", "lowest_company", "lowest_rate")

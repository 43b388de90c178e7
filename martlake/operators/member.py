"""Member operators."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlake.functions.dates import lit_date, month_start
from martlake.functions.ranking import global_rank

MONEY = "decimal(18,2)"

# Segment thresholds of the member purchase view.
SEGMENTS = ((5000, "VIP CUSTOMER"), (2000, "HIGH VALUE"), (500, "REGULAR"))
DEFAULT_SEGMENT = "LOW ACTIVITY"


def _amount():
    return F.col("quantity") * F.col("unit_price")


def _member_lines(t) -> DataFrame:
    """Order lines with the ordering member (guest orders dropped)."""
    o = t["orders"].filter(F.col("member_id").isNotNull()).select("order_id", "member_id", "order_date", "branch_id")
    return t["order_item"].join(o, "order_id")


def member_purchase_behavior(t) -> DataFrame:
    """Q03: per member with at least one order: orders, distinct items, units, spend, average line spend.

    Orders are counted from ``orders`` (an order without lines still counts); lines are
    first reduced to one row per (member, item), which makes the distinct-item count a
    plain count and shrinks the data before the member-level aggregate.
    """
    per_mi = _member_lines(t).groupBy("member_id", "item_id").agg(
        F.sum("quantity").alias("_q"), F.sum(_amount()).alias("_a"), F.count(F.lit(1)).alias("_l"))
    per_m = per_mi.groupBy("member_id").agg(
        F.count("item_id").alias("different_items_purchased"), F.sum("_q").alias("_q"),
        F.sum("_a").alias("_a"), F.sum("_l").alias("_l"))
    orders = (t["orders"].filter(F.col("member_id").isNotNull())
              .groupBy("member_id").agg(F.count("order_id").alias("total_orders")))
    j = (t["member"].select("member_id", "name", "email", "points_balance")
         .join(orders, "member_id").join(per_m, "member_id", "left"))
    return j.select(
        "member_id", "name", "email", "points_balance", "total_orders",
        F.coalesce("different_items_purchased", F.lit(0)).cast("bigint").alias("different_items_purchased"),
        F.coalesce("_q", F.lit(0)).cast("bigint").alias("total_units_purchased"),
        F.coalesce("_a", F.lit(0)).cast(MONEY).alias("total_spending"),
        F.coalesce(F.col("_a").cast("double") / F.col("_l"), F.lit(0.0)).alias("average_line_spending"))


def member_segments(t, thresholds=SEGMENTS, default: str = DEFAULT_SEGMENT) -> DataFrame:
    """Q04: Q03 plus a spending segment (first threshold reached, highest first)."""
    seg = None
    for limit, label in thresholds:
        cond = F.col("total_spending") >= limit
        seg = F.when(cond, label) if seg is None else seg.when(cond, label)
    seg = seg.otherwise(default) if seg is not None else F.lit(default)
    return member_purchase_behavior(t).withColumn("customer_segment", seg)


def member_total_spending(t) -> DataFrame:
    """Q05: lifetime spend of every member, 0 when none (the stored function, as a join)."""
    spend = _member_lines(t).groupBy("member_id").agg(F.sum(_amount()).alias("_a"))
    return (t["member"].select("member_id", "name").join(spend, "member_id", "left")
            .select("member_id", "name", F.coalesce("_a", F.lit(0)).cast(MONEY).alias("total_spending")))


def _score(c, hi, mid, higher_is_better=True):
    if higher_is_better:
        return F.when(c >= hi, 3).when(c >= mid, 2).otherwise(1)
    return F.when(c <= hi, 3).when(c <= mid, 2).otherwise(1)


def customer_rfm(t, as_of: _dt.date, branch_id=None, last_order_after=None, recency=None,
                 frequency=None, monetary=None, min_score=None) -> DataFrame:
    """Recency / frequency / monetary per (branch, member), scored 1-3 each.

    Recency in days from ``as_of`` to the last order; frequency = orders; monetary = spend.
    Scores: recency <=30 / <=90, orders >=10 / >=5, spend >=500 / >=200. Cut-offs filter
    before ranking; ``min_score`` hides rows after ranking and ``customers_total`` keeps the
    count of all ranked customers of the branch (D9). Rank per branch by score desc,
    recency asc, frequency desc, monetary desc, member id.
    """
    o = t["orders"].filter(F.col("member_id").isNotNull())
    if branch_id is not None:
        o = o.filter(F.col("branch_id") == branch_id)
    if last_order_after is not None:
        o = o.filter(F.col("order_date") > F.lit(last_order_after))
    o = o.join(t["member"].select("member_id"), "member_id", "left_semi")
    spend = (t["order_item"].join(o.select("order_id"), "order_id", "left_semi")
             .groupBy("order_id").agg(F.sum(_amount()).alias("_a")))
    per = (o.select("order_id", "member_id", "branch_id", "order_date").join(spend, "order_id", "left")
           .groupBy("branch_id", "member_id").agg(
               F.count("order_id").alias("frequency"),
               F.coalesce(F.sum("_a"), F.lit(0)).cast(MONEY).alias("monetary"),
               F.max("order_date").alias("_last")))
    per = per.withColumn("recency", F.datediff(lit_date(as_of), F.to_date("_last"))).drop("_last")
    per = per.withColumn("rfm_score", _score(F.col("recency"), 30, 90, False)
                         + _score(F.col("frequency"), 10, 5) + _score(F.col("monetary"), 500, 200))
    if recency is not None:
        per = per.filter(F.col("recency") <= recency)
    if frequency is not None:
        per = per.filter(F.col("frequency") >= frequency)
    if monetary is not None:
        per = per.filter(F.col("monetary") >= monetary)
    per = per.join(t["member"].select("member_id", F.col("name").alias("member_name")), "member_id")
    ranked = global_rank(per, [F.col("rfm_score").desc(), F.col("recency").asc(), F.col("frequency").desc(),
                               F.col("monetary").desc(), F.col("member_id").asc()],
                         name="rank", kind="row_number", partition_by=["branch_id"])
    totals = per.groupBy("branch_id").agg(F.count(F.lit(1)).alias("customers_total"))
    out = ranked.join(totals, "branch_id")
    if min_score is not None:
        out = out.filter(F.col("rfm_score") >= min_score)
    return out.select("branch_id", "rank", "member_id", "member_name", "recency", "frequency", "monetary",
                      "rfm_score", "customers_total")


def top_members_with_items(t, m: int = 5, n: int = 3) -> DataFrame:
    """Top ``m`` spenders, each with their top ``n`` items by units (grouped by item name)."""
    lines = _member_lines(t)
    spent = lines.groupBy("member_id").agg(F.sum(_amount()).cast(MONEY).alias("spent"))
    top = (spent.join(t["member"].select("member_id", "name", "points_balance"), "member_id")
           .orderBy(F.col("spent").desc(), F.col("member_id")).limit(m))
    top = global_rank(top, [F.col("spent").desc(), F.col("member_id")], name="member_rank",
                      kind="row_number", bounded=True)
    items = (lines.join(top.select("member_id"), "member_id", "left_semi")
             .join(t["item"].select("item_id", "item_name"), "item_id")
             .groupBy("member_id", "item_name").agg(F.sum("quantity").cast("bigint").alias("units")))
    w = Window.partitionBy("member_id").orderBy(F.col("units").desc(), F.col("item_name"))
    items = items.withColumn("item_rank", F.row_number().over(w)).filter(F.col("item_rank") <= n)
    return (top.join(items, "member_id", "left")
               .select("member_rank", "member_id", "name", "points_balance", "spent", "item_rank", "item_name", "units"))


def monthly_member_spending(t, as_of: _dt.date, n: int = 10, products: int = 5, soon_days: int = 30) -> DataFrame:
    """Previous calendar month; top ``n`` members by spend with orders, most visited
    branch and visits, top ``products`` products (quantity, value), membership status and
    the number of distinct members who ordered in the month.

    One row per (member, product); member columns repeat. Ties: member id, branch name,
    item name.
    """
    start, end_excl = month_start(as_of, 1), month_start(as_of, 0)
    o = (t["orders"].filter((F.col("order_date") >= F.lit(start)) & (F.col("order_date") < F.lit(end_excl)))
         .select("order_id", "member_id", "branch_id"))
    active = o.filter(F.col("member_id").isNotNull()).agg(F.countDistinct("member_id").alias("active_members"))
    lines = t["order_item"].join(o.filter(F.col("member_id").isNotNull()), "order_id")
    mem = t["member"].select("member_id", "name", "email", "points_balance", "expiry_date")
    per = (lines.groupBy("member_id").agg(F.countDistinct("order_id").alias("order_count"),
                                          F.sum(_amount()).cast(MONEY).alias("total_spent"))
           .join(mem, "member_id"))
    top = per.orderBy(F.col("total_spent").desc(), F.col("member_id")).limit(n)
    top = global_rank(top, [F.col("total_spent").desc(), F.col("member_id")], name="member_rank",
                      kind="row_number", bounded=True)
    visits = (o.join(top.select("member_id"), "member_id", "left_semi")
              .join(t["branch"].select("branch_id", "branch_name"), "branch_id")
              .groupBy("member_id", "branch_name").agg(F.count("order_id").alias("visit_count")))
    wv = Window.partitionBy("member_id").orderBy(F.col("visit_count").desc(), F.col("branch_name"))
    fav = (visits.withColumn("_r", F.row_number().over(wv)).filter(F.col("_r") == 1)
           .select("member_id", F.col("branch_name").alias("fav_branch"), F.col("visit_count").alias("fav_visits")))
    prods = (lines.join(top.select("member_id"), "member_id", "left_semi")
             .join(t["item"].select("item_id", "item_name", "category"), "item_id")
             .groupBy("member_id", "item_name", "category")
             .agg(F.sum("quantity").cast("bigint").alias("total_qty"), F.sum(_amount()).cast(MONEY).alias("total_value")))
    wp = Window.partitionBy("member_id").orderBy(F.col("total_qty").desc(), F.col("item_name"), F.col("category"))
    prods = prods.withColumn("product_rank", F.row_number().over(wp)).filter(F.col("product_rank") <= products)
    status = (F.when(F.col("expiry_date") < lit_date(as_of), "EXPIRED")
               .when(F.col("expiry_date") < F.date_add(lit_date(as_of), soon_days), "EXPIRING SOON").otherwise("ACTIVE"))
    return (top.join(fav, "member_id", "left").join(prods, "member_id", "left")
               .withColumn("active_members", active.scalar())  # one global count: a scalar subquery
               .select("member_rank", "member_id", "name", "email", "points_balance", "order_count", "total_spent",
                       status.alias("member_status"), F.coalesce("fav_branch", F.lit("N/A")).alias("fav_branch"),
                       F.coalesce("fav_visits", F.lit(0)).cast("bigint").alias("fav_visits"),
                       "product_rank", "item_name", "category", "total_qty", "total_value", "active_members"))


def member_order_history(t, member_id=None) -> DataFrame:
    """A member's (or every member's) order lines with subtotal."""
    o = t["orders"].filter(F.col("member_id").isNotNull())
    if member_id is not None:
        o = o.filter(F.col("member_id") == member_id)
    j = (o.select("order_id", "member_id", "order_date", "order_type").join(t["order_item"], "order_id")
         .join(t["item"].select("item_id", "item_name"), "item_id"))
    return j.select("member_id", "order_id", "order_date", "order_type", "item_id", "item_name", "quantity",
                    "unit_price", _amount().cast(MONEY).alias("subtotal"))


def member_point_activity(t, start, end) -> DataFrame:
    """Point rows between ``start`` and ``end`` (inclusive days) at three levels.

    DETAIL: each point row. MEMBER: earned, used, net and count per member. TOTAL: the same
    over everyone plus the number of members. One rollup pass.
    """
    end_excl = lit_date(end) + F.expr("INTERVAL 1 DAY")
    ph = t["point_history"].filter((F.col("redemption_date") >= lit_date(start)) & (F.col("redemption_date") < end_excl))
    d = ph.join(t["member"].select("member_id", "name", "points_balance"), "member_id")
    earned = F.when(F.col("transaction_type") == "Earned", F.col("amount")).otherwise(0)
    used = F.when(F.col("transaction_type") == "Used", F.col("amount")).otherwise(0)
    r = d.rollup("member_id", "point_redemption_id").agg(
        F.grouping_id().alias("_g"), F.max("name").alias("name"), F.max("points_balance").alias("points_balance"),
        F.max("redemption_date").alias("redemption_date"), F.max("transaction_type").alias("transaction_type"),
        F.sum(earned).cast("bigint").alias("earned"), F.sum(used).cast("bigint").alias("used"),
        F.count(F.lit(1)).alias("transactions"), F.countDistinct("member_id").alias("members"))
    det = F.col("_g") == 0
    return r.select(
        F.when(det, "DETAIL").when(F.col("_g") == 1, "MEMBER").otherwise("TOTAL").alias("level"),
        "member_id", F.when(F.col("_g") <= 1, F.col("name")).alias("name"),
        F.when(F.col("_g") <= 1, F.col("points_balance")).alias("points_balance"),
        "point_redemption_id", F.when(det, F.col("redemption_date")).alias("redemption_date"),
        F.when(det, F.col("transaction_type")).alias("transaction_type"),
        "earned", "used", (F.col("earned") - F.col("used")).alias("net"), "transactions",
        F.when(F.col("_g") == 3, F.col("members")).alias("members"))

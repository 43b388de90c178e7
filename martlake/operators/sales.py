"""Sales, item and channel operators."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.functions.dates import add_months_oracle, lit_date
from martlake.functions.money import cents, round_ratio
from martlake.functions.ranking import global_rank

MONEY = "decimal(18,2)"


def _line_amount():
    return F.col("quantity") * F.col("unit_price")


def item_sales_totals(t) -> DataFrame:
    """Q19: every item with units, revenue and number of orders; 0 when never sold.

    (order_id, item_id) is the order_item key, so orders per item is a plain count.
    Lines are aggregated per item before the join to the item table.
    """
    per_item = t["order_item"].groupBy("item_id").agg(
        F.sum("quantity").cast("bigint").alias("_u"), F.sum(_line_amount()).alias("_r"),
        F.count("order_id").alias("_n"))
    j = t["item"].select("item_id", "item_name", "category").join(per_item, "item_id", "left")
    return j.select("item_id", "item_name", "category",
                    F.coalesce("_u", F.lit(0)).cast("bigint").alias("total_units_sold"),
                    F.coalesce("_r", F.lit(0)).cast(MONEY).alias("total_revenue"),
                    F.coalesce("_n", F.lit(0)).cast("bigint").alias("times_ordered"))


def top_selling_items(t, k: int = 10) -> DataFrame:
    """Q20: the ``k`` items with most units sold, with their current price (top-k, then join)."""
    top = item_sales_totals(t).orderBy(F.col("total_units_sold").desc(), F.col("item_id")).limit(k)
    return top.join(t["item"].select("item_id", F.col("unit_price").alias("current_price")), "item_id")


def _lines_with_orders(t) -> DataFrame:
    return t["order_item"].join(t["orders"].select("order_id", "order_date", "order_type", "branch_id"), "order_id")


def order_channel_trend(t) -> DataFrame:
    """Q21: by (year, order type): orders, revenue, revenue per order (2 dp), branches served.

    Orders and branches are counted from per-order partial sums, so the two distinct
    counts run on one row per order instead of one per line.
    """
    per_order = (_lines_with_orders(t)
                 .groupBy("order_id", "order_date", "order_type", "branch_id")
                 .agg(F.sum(_line_amount()).alias("_amt")))
    agg = per_order.groupBy(F.year("order_date").alias("sales_year"), "order_type").agg(
        F.count("order_id").alias("total_orders"),
        F.sum("_amt").cast(MONEY).alias("revenue"),
        F.countDistinct("branch_id").alias("branches_served"))
    return agg.select("sales_year", "order_type", "total_orders", "revenue",
                      round_ratio(cents("revenue"), F.col("total_orders")).alias("avg_order_value"),
                      "branches_served")


def order_channel_trend_latest(t) -> DataFrame:
    """Q22: Q21 plus the last order date of that year and type (orders without lines count)."""
    last = (t["orders"].groupBy(F.year("order_date").alias("sales_year"), "order_type")
            .agg(F.max("order_date").alias("_last")))
    return (order_channel_trend(t).join(last, ["sales_year", "order_type"])
            .withColumn("latest_order", F.date_format("_last", "dd-MM-yyyy")).drop("_last"))


def item_sales_window(t, as_of: _dt.date, months: int = 24) -> DataFrame:
    """Q25: per item over the last ``months`` months: quantity, sales, average selling price (2 dp)."""
    since = add_months_oracle(as_of, -months)
    o = t["orders"].filter(F.col("order_date") >= F.lit(since)).select("order_id")
    agg = t["order_item"].join(o, "order_id").groupBy("item_id").agg(
        F.sum("quantity").cast("bigint").alias("total_quantity"),
        F.sum(_line_amount()).cast(MONEY).alias("total_sales"),
        F.sum(cents("unit_price")).alias("_pc"), F.count("unit_price").alias("_pn"))
    return (agg.filter(F.col("total_quantity") > 0)
               .select("item_id", "total_quantity", "total_sales",
                       round_ratio(F.col("_pc"), F.col("_pn")).alias("avg_unit_price")))


def item_price_sales_top(t, as_of: _dt.date, k: int = 10, months: int = 24) -> DataFrame:
    """Q26: top ``k`` items by sales then quantity, ranked 1..k (item id breaks ties)."""
    v = item_sales_window(t, as_of, months).join(t["item"].select("item_id", "item_name", "category"), "item_id")
    top = v.orderBy(F.col("total_sales").desc(), F.col("total_quantity").desc(), F.col("item_id")).limit(k)
    return global_rank(top, [F.col("total_sales").desc(), F.col("total_quantity").desc(), F.col("item_id")],
                       name="rank", kind="row_number", bounded=True)


def item_pair_frequency(t, min_support: int = 2) -> DataFrame:
    """Q14: unordered item pairs bought in at least ``min_support`` common orders.

    A pair's support is at most the support of each of its items (a-priori), so lines of
    items sold in fewer than ``min_support`` orders are dropped before the self-join. The
    self-join is keyed by order; AQE splits a skewed (very large) order across tasks.
    """
    lines = t["order_item"].select("order_id", "item_id")
    frequent = lines.groupBy("item_id").agg(F.count(F.lit(1)).alias("_s")).filter(F.col("_s") >= min_support)
    fl = lines.join(frequent.select("item_id"), "item_id", "left_semi")
    a = fl.select("order_id", F.col("item_id").alias("item_a"))
    b = fl.select("order_id", F.col("item_id").alias("item_b"))
    pairs = (a.join(b, "order_id").filter(F.col("item_a") < F.col("item_b"))
              .groupBy("item_a", "item_b").agg(F.count("order_id").alias("times_together"))
              .filter(F.col("times_together") >= min_support))
    names = t["item"].select("item_id", "item_name")
    return (pairs.join(names.select(F.col("item_id").alias("item_a"), F.col("item_name").alias("item_a_name")), "item_a")
                 .join(names.select(F.col("item_id").alias("item_b"), F.col("item_name").alias("item_b_name")), "item_b")
                 .select("item_a", "item_a_name", "item_b", "item_b_name", "times_together"))


def top_item_pairs_with_stock(t, min_support: int = 5, k: int = 20) -> DataFrame:
    """Q17: pairs with support >= ``min_support``, chain stock of both items, top ``k``.

    Pairs whose items have no stock row drop out (inner joins, as in the reference).
    """
    stock = t["branch_stock"].groupBy("item_id").agg(F.sum("stock_quantity").cast("bigint").alias("_q"))
    p = item_pair_frequency(t, min_support)
    j = (p.join(stock.select(F.col("item_id").alias("item_a"), F.col("_q").alias("item_a_stock")), "item_a")
          .join(stock.select(F.col("item_id").alias("item_b"), F.col("_q").alias("item_b_stock")), "item_b"))
    return (j.orderBy(F.col("times_together").desc(), F.col("item_a"), F.col("item_b")).limit(k)
             .select("item_a", "item_a_name", "item_b", "item_b_name", "times_together", "item_a_stock", "item_b_stock"))


def category_sales_summary(t, category=None) -> DataFrame:
    """Per item of a category (or all categories) units and revenue incl. unsold items,
    plus a CATEGORY row per category with total revenue and item count (one rollup pass)."""
    items = t["item"].select("item_id", "item_name", "category")
    if category is not None:
        items = items.filter(F.col("category") == category)
    per_item = t["order_item"].groupBy("item_id").agg(F.sum("quantity").alias("_u"), F.sum(_line_amount()).alias("_r"))
    d = (items.join(per_item, "item_id", "left")
         .select("category", "item_id", "item_name",
                 F.coalesce("_u", F.lit(0)).cast("bigint").alias("units"),
                 F.coalesce("_r", F.lit(0)).cast(MONEY).alias("revenue")))
    r = d.rollup("category", "item_id").agg(
        F.grouping_id().alias("_g"), F.max("item_name").alias("item_name"),
        F.sum("units").cast("bigint").alias("units"), F.sum("revenue").cast(MONEY).alias("revenue"),
        F.count(F.lit(1)).alias("item_count"))
    return (r.filter(F.col("_g") < 3)
             .select(F.when(F.col("_g") == 0, "ITEM").otherwise("CATEGORY").alias("level"),
                     "category", "item_id", F.when(F.col("_g") == 0, F.col("item_name")).alias("item_name"),
                     "units", "revenue", "item_count"))


def promotion_performance(t, start, end, promotion_id=None) -> DataFrame:
    """Per promotion x item, quantity, revenue and order lines of all sales of the item
    between ``start`` and ``end`` (inclusive days; not the promotion's own dates, D8), with
    zero rows kept; PROMOTION rows carry the promotion totals.

    Sales are aggregated once per item and then joined to the promotion lines, so an item
    in several promotions does not re-scan its sales.
    """
    end_excl = lit_date(end) + F.expr("INTERVAL 1 DAY")
    o = (t["orders"].filter((F.col("order_date") >= lit_date(start)) & (F.col("order_date") < end_excl))
         .select("order_id"))
    per_item = t["order_item"].join(o, "order_id").groupBy("item_id").agg(
        F.sum("quantity").alias("_q"), F.sum(_line_amount()).alias("_r"), F.count(F.lit(1)).alias("_n"))
    promo = t["promotion"].select("promotion_id", "promotion_name", "status", "start_date", "end_date")
    if promotion_id is not None:
        promo = promo.filter(F.col("promotion_id") == promotion_id)
    det = (t["promotion_details"].join(promo.select("promotion_id"), "promotion_id", "left_semi")
           .join(t["item"].select("item_id", "item_name"), "item_id")
           .join(per_item, "item_id", "left")
           .select("promotion_id", "item_id", "item_name", "discount_type", "discount_value",
                   F.coalesce("_q", F.lit(0)).cast("bigint").alias("quantity_sold"),
                   F.coalesce("_r", F.lit(0)).cast(MONEY).alias("sales_revenue"),
                   F.coalesce("_n", F.lit(0)).cast("bigint").alias("order_lines")))
    r = det.rollup("promotion_id", "item_id").agg(
        F.grouping_id().alias("_g"), F.max("item_name").alias("item_name"),
        F.max("discount_type").alias("discount_type"), F.max("discount_value").alias("discount_value"),
        F.sum("quantity_sold").cast("bigint").alias("quantity_sold"),
        F.sum("sales_revenue").cast(MONEY).alias("sales_revenue"),
        F.sum("order_lines").cast("bigint").alias("order_lines"))
    r = r.filter(F.col("_g") < 3)
    # promotions without detail lines still get their (zero) totals row
    empty = (promo.join(det.select("promotion_id"), "promotion_id", "left_anti")
             .select("promotion_id", F.lit(1).alias("_g"), F.lit(None).cast(r.schema["item_id"].dataType).alias("item_id"),
                     F.lit(None).cast("string").alias("item_name"), F.lit(None).cast("string").alias("discount_type"),
                     F.lit(None).cast(r.schema["discount_value"].dataType).alias("discount_value"),
                     F.lit(0).cast("bigint").alias("quantity_sold"), F.lit(0).cast(MONEY).alias("sales_revenue"),
                     F.lit(0).cast("bigint").alias("order_lines")))
    r = r.unionByName(empty.select(*r.columns))
    item = F.col("_g") == 0
    out = r.join(promo, "promotion_id")
    return out.select(
        F.when(item, "ITEM").otherwise("PROMOTION").alias("level"),
        "promotion_id", "promotion_name", "status", "start_date", "end_date", "item_id",
        F.when(item, F.col("item_name")).alias("item_name"),
        F.when(item, F.col("discount_type")).alias("discount_type"),
        F.when(item, F.col("discount_value")).alias("discount_value"),
        "quantity_sold", "sales_revenue", "order_lines")

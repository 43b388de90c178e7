"""Branch operators."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.functions.dates import add_months_oracle, month_start
from martlake.functions.money import cents, round_ratio
from martlake.functions.ranking import global_rank
from martlake.operators.supplier import avg_item_cost

MONEY = "decimal(18,2)"

# The chain name that branch reports strip from branch names is a parameter (``prefix``);
# the test data's branches are named "Mart <nation>".
CHAIN_PREFIX = None


def _lines(t) -> DataFrame:
    return t["order_item"].join(t["orders"].select("order_id", "branch_id", "order_date"), "order_id")


def _amount():
    return F.col("quantity") * F.col("unit_price")


def branch_staff_count(t) -> DataFrame:
    """Q27: staff headcount per branch."""
    return t["staff"].groupBy("branch_id").agg(F.count("staff_id").alias("staff_count"))


def monthly_branch_sales(t) -> DataFrame:
    """Q28: per (branch, YYYY-MM): sales and distinct orders.

    Lines are summed per order first, so the distinct order count is a count of rows.
    """
    per_order = (_lines(t).groupBy("order_id", "branch_id", "order_date").agg(F.sum(_amount()).alias("_a")))
    agg = per_order.groupBy("branch_id", F.date_format("order_date", "yyyy-MM").alias("month")).agg(
        F.sum("_a").cast(MONEY).alias("monthly_sales"), F.count("order_id").alias("monthly_orders"))
    return agg.join(t["branch"].select("branch_id", "branch_name"), "branch_id") \
              .select("branch_id", "branch_name", "month", "monthly_sales", "monthly_orders")


def _strip_prefix(c, prefix: str | None):
    import re
    if not prefix:
        return F.trim(c)
    return F.trim(F.regexp_replace(c, "(?i)" + re.escape(prefix), ""))


def branch_efficiency(t, as_of: _dt.date, months: int = 24, prefix: str | None = CHAIN_PREFIX,
                      min_sales: float = 1000, min_orders: int = 10) -> DataFrame:
    """Q29: last ``months`` months: orders, sales, sales per staff member; names without the
    chain prefix; HAVING sales > ``min_sales`` and orders >= ``min_orders``.

    The month cut is a month start, so filtering orders by date before grouping keeps the
    same rows as the reference's month-string filter and lets the filter reach the scan.
    Grouped by branch id as well as name (D2).
    """
    since = month_start(add_months_oracle(month_start(as_of), -months))
    o = t["orders"].filter(F.col("order_date") >= F.lit(since))
    per_order = (t["order_item"].join(o.select("order_id", "branch_id"), "order_id")
                 .groupBy("order_id", "branch_id").agg(F.sum(_amount()).alias("_a")))
    agg = per_order.groupBy("branch_id").agg(F.count("order_id").alias("total_orders"),
                                             F.sum("_a").cast(MONEY).alias("total_sales"))
    j = (agg.join(branch_staff_count(t), "branch_id").join(t["branch"].select("branch_id", "branch_name"), "branch_id")
            .filter((F.col("total_sales") > min_sales) & (F.col("total_orders") >= min_orders)))
    return j.select("branch_id", _strip_prefix(F.col("branch_name"), prefix).alias("branch_location"),
                    F.col("staff_count").alias("headcount"), "total_orders", "total_sales",
                    (F.col("total_sales").cast("double") / F.col("staff_count")).alias("sales_per_staff"))


def branch_revenue(t, as_of: _dt.date, years: int = 2) -> DataFrame:
    """Q30: revenue per branch over the last ``years`` years."""
    since = add_months_oracle(as_of, -12 * years)
    o = t["orders"].filter(F.col("order_date") >= F.lit(since)).select("order_id", "branch_id")
    return (t["order_item"].join(o, "order_id").groupBy("branch_id")
            .agg(F.sum(_amount()).cast(MONEY).alias("total_revenue")))


def branch_cost(t, as_of: _dt.date, years: int = 2) -> DataFrame:
    """Q32: per branch, units sold x the item's average procurement cost (Q31).

    Items never procured in the window drop out (inner join), as in the reference. Units
    are summed per (branch, item) first, so each item's average cost multiplies once.
    The cost is rounded to cents.
    """
    since = add_months_oracle(as_of, -12 * years)
    o = t["orders"].filter(F.col("order_date") >= F.lit(since)).select("order_id", "branch_id")
    units = t["order_item"].join(o, "order_id").groupBy("branch_id", "item_id").agg(F.sum("quantity").alias("_u"))
    j = units.join(avg_item_cost(t, as_of, years), "item_id")
    return j.groupBy("branch_id").agg(F.round(F.sum(F.col("_u") * F.col("avg_unit_cost")), 2).alias("total_cost"))


def branch_profitability(t, as_of: _dt.date, years: int = 2, prefix: str | None = CHAIN_PREFIX) -> DataFrame:
    """Q33: revenue, cost, profit, orders and revenue per order; HAVING profit > 0.

    Orders are counted from ``orders`` alone (orders without lines count), and three
    per-branch aggregates are joined -- the orders table is not re-joined to the lines.
    """
    since = add_months_oracle(as_of, -12 * years)
    n_orders = (t["orders"].filter(F.col("order_date") >= F.lit(since))
                .groupBy("branch_id").agg(F.count("order_id").alias("total_orders")))
    j = (t["branch"].select("branch_id", "branch_name")
         .join(n_orders, "branch_id").join(branch_revenue(t, as_of, years), "branch_id")
         .join(branch_cost(t, as_of, years), "branch_id"))
    profit = F.round(F.col("total_revenue").cast("double") - F.col("total_cost"), 2)
    return (j.withColumn("net_profit", profit).filter(F.col("net_profit") > 0)
             .select("branch_id", _strip_prefix(F.col("branch_name"), prefix).alias("branch_loc"),
                     "total_orders", "total_revenue", "total_cost", "net_profit",
                     round_ratio(cents("total_revenue"), F.col("total_orders")).alias("avg_order_val")))


def branch_profit_ranked(t, as_of: _dt.date, years: int = 2, prefix: str | None = CHAIN_PREFIX) -> DataFrame:
    """Q34: Q33 by profit, highest first, numbered 1..n (branch id breaks ties)."""
    return global_rank(branch_profitability(t, as_of, years, prefix),
                       [F.col("net_profit").desc(), F.col("branch_id")], name="rank", kind="row_number", bounded=True)


def company_summary(t) -> DataFrame:
    """By (branch, category): orders, units, sales > 0; BRANCH totals; a TOTAL row;
    branches without sales kept with zeros.

    ``category_orders_sum`` adds the per-category order counts (the reference's total,
    where an order spanning three categories counts three times, D7); ``distinct_orders``
    is the true number of orders.
    """
    lines = _lines(t).join(t["item"].select("item_id", "category"), "item_id")
    cat = (lines.groupBy("branch_id", "category")
           .agg(F.countDistinct("order_id").alias("order_count"), F.sum("quantity").cast("bigint").alias("total_qty"),
                F.sum(_amount()).cast(MONEY).alias("total_sales"))
           .filter(F.col("total_sales") > 0))
    per_branch_orders = (lines.join(cat.select("branch_id", "category"), ["branch_id", "category"], "left_semi")
                         .groupBy("branch_id").agg(F.countDistinct("order_id").alias("distinct_orders")))
    br = t["branch"].select("branch_id", "branch_name")
    bt = (cat.groupBy("branch_id").agg(F.sum("order_count").alias("category_orders_sum"),
                                       F.sum("total_qty").alias("total_qty"),
                                       F.sum("total_sales").alias("total_sales")))
    branch_rows = (br.join(bt, "branch_id", "left").join(per_branch_orders, "branch_id", "left")
                   .select(F.lit("BRANCH").alias("level"), "branch_id", "branch_name", F.lit(None).cast("string").alias("category"),
                           F.coalesce("category_orders_sum", F.lit(0)).cast("bigint").alias("order_count"),
                           F.coalesce("distinct_orders", F.lit(0)).cast("bigint").alias("distinct_orders"),
                           F.coalesce("total_qty", F.lit(0)).cast("bigint").alias("total_qty"),
                           F.coalesce("total_sales", F.lit(0)).cast(MONEY).alias("total_sales")))
    cat_rows = (cat.join(br, "branch_id")
                .select(F.lit("CATEGORY").alias("level"), "branch_id", "branch_name", "category", "order_count",
                        F.lit(None).cast("bigint").alias("distinct_orders"), "total_qty", "total_sales"))
    total = (branch_rows.agg(F.sum("order_count").cast("bigint").alias("order_count"),
                             F.sum("distinct_orders").cast("bigint").alias("distinct_orders"),
                             F.sum("total_qty").cast("bigint").alias("total_qty"),
                             F.sum("total_sales").cast(MONEY).alias("total_sales"))
             .select(F.lit("TOTAL").alias("level"), F.lit(None).cast("bigint").alias("branch_id"),
                     F.lit(None).cast("string").alias("branch_name"), F.lit(None).cast("string").alias("category"),
                     "order_count", "distinct_orders", "total_qty", "total_sales"))
    return cat_rows.unionByName(branch_rows).unionByName(total)


def table_row_counts(t) -> DataFrame:
    """Q35: name and row count of the 17 tables (one union of counts)."""
    from martlake.sources.retail import TABLES
    parts = [t[n].select(F.lit(n).alias("table_name")).groupBy("table_name").agg(F.count(F.lit(1)).alias("row_count"))
             for n in TABLES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

"""Inventory operators."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.functions.dates import month_start
from martlake.functions.money import cents, round_ratio
from martlake.operators.supplier import weighted_avg_cost

MONEY = "decimal(18,2)"


def oracle_day(c) -> F.Column:
    """TO_CHAR(date, 'DD-MON-YYYY') with the upper-case month abbreviation."""
    return F.upper(F.date_format(c, "dd-MMM-yyyy"))


def previous_month_item_sales(t, as_of: _dt.date) -> DataFrame:
    """Q06: units sold per item in the calendar month before ``as_of`` (half-open range)."""
    start, end = month_start(as_of, 1), month_start(as_of, 0)
    o = t["orders"].filter((F.col("order_date") >= F.lit(start)) & (F.col("order_date") < F.lit(end))).select("order_id")
    return (t["order_item"].join(o, "order_id")
            .groupBy("item_id").agg(F.sum("quantity").cast("bigint").alias("quantity_sold")))


def current_stock(t) -> DataFrame:
    """Q08: stock per item summed over branches."""
    return t["branch_stock"].groupBy("item_id").agg(F.sum("stock_quantity").cast("bigint").alias("current_stock"))


def inventory_turnover_by_item(t, as_of: _dt.date) -> DataFrame:
    """Q09: COGS, inventory value and turnover ratio for every item (all items kept).

    COGS = units sold last month x weighted average cost; value = stock x the same cost;
    ratio 0 when stock or cost is 0.
    """
    s = previous_month_item_sales(t, as_of)
    w = weighted_avg_cost(t)
    c = current_stock(t)
    j = (t["item"].select("item_id", "item_name", "category")
         .join(s, "item_id", "left").join(w, "item_id", "left").join(c, "item_id", "left"))
    qs = F.coalesce(F.col("quantity_sold"), F.lit(0)).cast("bigint")
    cs = F.coalesce(F.col("current_stock"), F.lit(0)).cast("bigint")
    wac = F.coalesce(F.col("weighted_avg_cost"), F.lit(0.0))
    cogs = qs * wac
    inv = cs * wac
    return j.select(
        "item_id", "item_name", "category",
        qs.alias("quantity_sold"), cogs.alias("total_cogs"), cs.alias("current_stock"), inv.alias("inventory_value"),
        F.when((cs == 0) | (wac == 0), F.lit(0.0)).otherwise(cogs / inv).alias("turnover_ratio"))


def inventory_turnover_by_category(t, as_of: _dt.date, categories=None, min_qty: int = 200) -> DataFrame:
    """Q10: category sums of Q09, ratio of the sums, HAVING units sold > ``min_qty``.

    Money sums are rounded to cents and the ratio to 4 places (the report's precision),
    so the result does not depend on the order doubles are added in.
    """
    v = inventory_turnover_by_item(t, as_of)
    if categories is not None:
        v = v.filter(F.col("category").isin(list(categories)))
    agg = v.groupBy("category").agg(
        F.sum("quantity_sold").cast("bigint").alias("quantity_sold"),
        F.sum("total_cogs").alias("_cogs"),
        F.sum("current_stock").cast("bigint").alias("current_stock"),
        F.sum("inventory_value").alias("_inv"))
    return (agg.filter(F.col("quantity_sold") > min_qty)
               .select("category", "quantity_sold", F.round("_cogs", 2).alias("total_cogs"), "current_stock",
                       F.round("_inv", 2).alias("inventory_value"),
                       F.when(F.col("_inv") == 0, F.lit(0.0)).otherwise(F.round(F.col("_cogs") / F.col("_inv"), 4))
                       .alias("turnover_ratio")))


def branch_stock_total(t) -> DataFrame:
    """Q13: stock per branch, HAVING total > 0."""
    return (t["branch_stock"].groupBy("branch_id").agg(F.sum("stock_quantity").cast("bigint").alias("total_stock"))
            .filter(F.col("total_stock") > 0))


def branch_stock_status(t, branch_id=None, threshold: int = 50) -> DataFrame:
    """Q15: a branch's items with LOW STOCK below ``threshold``, else OK; lowest first, then by
    item (and branch, where all are asked for)."""
    bs = t["branch_stock"]
    if branch_id is not None:
        bs = bs.filter(F.col("branch_id") == branch_id)
    j = bs.join(t["item"].select("item_id", "item_name", "category"), "item_id")
    return j.select(
        "branch_id", "item_id", "item_name", "category", "stock_quantity",
        oracle_day(F.col("last_restock_date")).alias("last_restock_date"),
        F.when(F.col("stock_quantity") < threshold, "LOW STOCK").otherwise("OK").alias("stock_status")) \
        .orderBy(F.col("stock_quantity").asc_nulls_last(), "item_id", "branch_id")


def branch_stock_by_category(t, branch_id=None) -> DataFrame:
    """Q16: per (branch, category): items, total units, average rounded to 2; HAVING total > 0."""
    bs = t["branch_stock"]
    if branch_id is not None:
        bs = bs.filter(F.col("branch_id") == branch_id)
    j = bs.join(t["item"].select("item_id", "category"), "item_id")
    agg = j.groupBy("branch_id", "category").agg(
        F.count("item_id").alias("item_count"),
        F.sum("stock_quantity").cast("bigint").alias("total_qty"),
        F.round(F.sum("stock_quantity").cast("double") / F.count("stock_quantity"), 2).alias("avg_qty"))
    return agg.filter(F.col("total_qty") > 0)


def branch_stock_summary(t, min_total: int = 50000) -> DataFrame:
    """Q18: branch name with its stock total, totals >= ``min_total``."""
    return (t["branch"].join(branch_stock_total(t), "branch_id")
            .filter(F.col("total_stock") >= min_total)
            .select("branch_id", "branch_name", "total_stock"))


def item_stock_distribution(t, item_id=None) -> DataFrame:
    """Q36: stock of an item (or every item) per branch."""
    bs = t["branch_stock"]
    if item_id is not None:
        bs = bs.filter(F.col("item_id") == item_id)
    agg = bs.groupBy("item_id", "branch_id").agg(F.sum("stock_quantity").cast("bigint").alias("branch_total"))
    return (agg.filter(F.col("branch_total") >= 0)
               .join(t["branch"].select("branch_id", "branch_name"), "branch_id")
               .select("item_id", "branch_id", "branch_name", "branch_total"))


def branch_stock_in_out(t, branch_id=None) -> DataFrame:
    """Per stocked (branch, item): units procured, units sold at the branch, on hand, last restock.

    Two aggregates keyed by (branch, item) and left-joined to the stock rows; a missing
    aggregate (or a negative sum, which the reference's HAVING drops) counts as 0.
    """
    bs = t["branch_stock"]
    p = t["procurement"]
    o = t["orders"]
    if branch_id is not None:
        bs = bs.filter(F.col("branch_id") == branch_id)
        p = p.filter(F.col("branch_id") == branch_id)
        o = o.filter(F.col("branch_id") == branch_id)
    stock_in = p.groupBy("branch_id", "item_id").agg(F.sum("quantity").cast("bigint").alias("_in"))
    stock_out = (t["order_item"].join(o.select("order_id", "branch_id"), "order_id")
                 .groupBy("branch_id", "item_id").agg(F.sum("quantity").cast("bigint").alias("_out")))
    j = (bs.join(t["item"].select("item_id", "item_name"), "item_id")
           .join(stock_in, ["branch_id", "item_id"], "left")
           .join(stock_out, ["branch_id", "item_id"], "left"))
    nz = lambda c: F.when(F.col(c) >= 0, F.col(c)).otherwise(F.lit(0)).cast("bigint")
    return j.select("branch_id", "item_id", "item_name", nz("_in").alias("total_in"), nz("_out").alias("total_out"),
                    "stock_quantity", oracle_day(F.col("last_restock_date")).alias("last_restock_date"))


def stock_reorder(t, threshold: int = 10) -> DataFrame:
    """Items under ``threshold`` per branch with urgency and estimated reorder cost.

    Rows: ``level`` ITEM (one per low-stock row), BRANCH (subtotal of the branch) and
    TOTAL (whole chain, with the alert count) -- one rollup pass over the detail.
    The estimated unit price is the item's average procurement cost, 0 if never procured
    (the reference's correlated subquery, here a left join to a per-item aggregate).
    """
    low = t["branch_stock"].filter(F.col("stock_quantity") < threshold)
    avgc = t["procurement"].groupBy("item_id").agg(
        F.sum(cents("unit_cost")).alias("_sc"), F.count("unit_cost").alias("_n"))
    d = (low.join(t["branch"].select("branch_id", "branch_name"), "branch_id")
            .join(t["item"].select("item_id", "item_name", "category"), "item_id")
            .join(avgc, "item_id", "left")
            .withColumn("est_unit_price", F.coalesce(F.col("_sc").cast("double") / F.col("_n"), F.lit(0.0)))
            .withColumn("est_cost", (F.lit(threshold) - F.col("stock_quantity")) * F.col("est_unit_price"))
            .withColumn("_row_cost", F.coalesce(
                round_ratio((F.lit(threshold) - F.col("stock_quantity")) * F.col("_sc"), F.col("_n")),
                F.lit(0).cast("decimal(18,2)")))
            .withColumn("_row_price", F.coalesce(round_ratio(F.col("_sc"), F.col("_n")),
                                                 F.lit(0).cast("decimal(18,2)")))
            .withColumn("urgency", F.when(F.col("stock_quantity") == 0, "CRITICAL")
                        .when(F.col("stock_quantity") <= F.lit(threshold) / 2, "HIGH").otherwise("MEDIUM")))
    r = d.rollup("branch_id", "item_id").agg(
        F.grouping_id().alias("_g"),
        F.max("branch_name").alias("branch_name"), F.max("item_name").alias("item_name"),
        F.max("category").alias("category"), F.max("stock_quantity").alias("stock_quantity"),
        F.max("last_restock_date").alias("_lr"), F.max("_row_price").alias("_row_price"),
        F.max("_row_cost").alias("_row_cost"),
        F.max("urgency").alias("urgency"), F.sum("est_cost").alias("_cost"),
        F.count(F.lit(1)).alias("alert_count"))
    lvl = F.when(F.col("_g") == 0, "ITEM").when(F.col("_g") == 1, "BRANCH").otherwise("TOTAL")
    item = F.col("_g") == 0
    return r.select(
        lvl.alias("level"), "branch_id", F.when(F.col("_g") <= 1, F.col("branch_name")).alias("branch_name"),
        "item_id", F.when(item, F.col("item_name")).alias("item_name"), F.when(item, F.col("category")).alias("category"),
        F.when(item, F.col("stock_quantity")).alias("stock_quantity"),
        F.when(item, oracle_day(F.col("_lr"))).alias("last_restock_date"),
        F.when(item, F.col("_row_price")).alias("est_unit_price"),
        F.when(item, F.col("urgency")).alias("urgency"),
        F.when(item, F.col("_row_cost")).otherwise(F.round("_cost", 2).cast("decimal(18,2)")).alias("est_cost"),
        "alert_count")


def branch_stock_listing(t, branch_id=None) -> DataFrame:
    """A branch's items with category, price and stock.

    ``status`` tells the cases apart: OK (a stock row), NO STOCK (known branch without
    stock rows; one row with NULL item) and UNKNOWN BRANCH (requested id not in branch).
    """
    br = t["branch"].select("branch_id", "branch_name")
    if branch_id is not None:
        req = t["branch"].sparkSession.range(1).select(F.lit(branch_id).cast("bigint").alias("branch_id"))
        br = req.join(br, "branch_id", "left")
    stock = (t["branch_stock"].join(t["item"].select("item_id", "item_name", "category", "unit_price"), "item_id")
             .select("branch_id", "item_id", "item_name", "category", "unit_price", "stock_quantity"))
    # not one outer join: it would deal all stock rows out by branch, or broadcast them
    stocked = t["branch_stock"].join(t["item"].select("item_id"), "item_id", "left_semi").select("branch_id").distinct()
    j = stock.join(F.broadcast(br), "branch_id").unionByName(br.join(stocked, "branch_id", "left_anti"), allowMissingColumns=True)
    status = (F.when(F.col("branch_name").isNull(), "UNKNOWN BRANCH")
               .when(F.col("item_id").isNull(), "NO STOCK").otherwise("OK"))
    return j.select("branch_id", "branch_name", status.alias("status"), "item_id", "item_name", "category",
                    "unit_price", "stock_quantity")

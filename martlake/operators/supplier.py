"""Supplier and procurement operators.

Conventions for every operator module
-------------------------------------
* ``t`` is a dict of retail DataFrames (``sources.retail.load_retail``).
* Money totals are exact decimals, returned as ``decimal(18,2)``.
* Averages and ratios are ``double``: an exact decimal sum divided by a count, so the
  value does not depend on summation order.
* Optional arguments that name one branch / item / member default to ``None`` = all of
  them in one distributed pass; a value only adds a filter.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from martlake.functions.dates import add_months_oracle, month_start
from martlake.functions.ranking import global_rank
from martlake.session import stored

MONEY = "decimal(18,2)"


def _avg(col: str):
    return F.sum(col).cast("double") / F.count(col)


def supplier_performance(t) -> DataFrame:
    """Q01: per supplier, distinct items and branches, quantity, cost, average unit cost.

    Only procurements whose item and branch exist count (inner joins of the view); the
    existence checks are semi-joins, and the aggregate runs before the supplier join.
    """
    p = (t["procurement"].filter(F.col("quantity") > 0)
         .join(t["item"].select("item_id"), "item_id", "left_semi")
         .join(t["branch"].select("branch_id"), "branch_id", "left_semi"))
    agg = p.groupBy("supplier_id").agg(
        F.countDistinct("item_id").alias("total_items_supplied"),
        F.countDistinct("branch_id").alias("branches_supplied"),
        F.sum("quantity").cast("bigint").alias("total_quantity_supplied"),
        F.sum(F.col("quantity") * F.col("unit_cost")).cast(MONEY).alias("total_procurement_cost"),
        _avg("unit_cost").alias("average_unit_cost"))
    return (agg.filter(F.col("total_procurement_cost") > 0)
               .join(t["supplier"].select("supplier_id", "supplier_name"), "supplier_id")
               .select("supplier_id", "supplier_name", "total_items_supplied", "branches_supplied",
                       "total_quantity_supplied", "total_procurement_cost", "average_unit_cost"))


def supplier_performance_ranked(t) -> DataFrame:
    """Q02: Q01 with RANK() by procurement cost, highest first; ties share a rank."""
    return global_rank(supplier_performance(t), [F.col("total_procurement_cost").desc()],
                       name="procurement_rank", kind="rank")


def supplier_procurement_summary(t) -> DataFrame:
    """Q01 in cost order with a counter rank 1..n, plus a grand-total row.

    The counter is a row number (ties broken by supplier id). The total row has
    ``row_type = 'TOTAL'`` and NULL supplier columns.
    """
    perf = supplier_performance(t)
    ranked = global_rank(perf, [F.col("total_procurement_cost").desc(), F.col("supplier_id").asc()],
                         name="rank", kind="row_number")
    detail = ranked.select(F.lit("SUPPLIER").alias("row_type"), "rank", "supplier_id", "supplier_name",
                           "total_items_supplied", "branches_supplied", "total_quantity_supplied",
                           "total_procurement_cost")
    total = perf.agg(F.sum("total_procurement_cost").cast(MONEY).alias("total_procurement_cost")).select(
        F.lit("TOTAL").alias("row_type"), F.lit(None).cast("int").alias("rank"),
        F.lit(None).cast("bigint").alias("supplier_id"), F.lit(None).cast("string").alias("supplier_name"),
        F.lit(None).cast("bigint").alias("total_items_supplied"), F.lit(None).cast("bigint").alias("branches_supplied"),
        F.lit(None).cast("bigint").alias("total_quantity_supplied"), "total_procurement_cost")
    return detail.unionByName(total)


def weighted_avg_cost(t) -> DataFrame:
    """Q07: per item sum(quantity*cost) / nullif(sum(quantity), 0)."""
    return (t["procurement"].groupBy("item_id")
            .agg(F.sum(F.col("quantity") * F.col("unit_cost")).alias("_c"), F.sum("quantity").alias("_q"))
            .select("item_id", (F.col("_c").cast("double") / F.nullif(F.col("_q"), F.lit(0)).cast("double"))
                    .alias("weighted_avg_cost")))


def avg_item_cost(t, as_of: _dt.date, years: int = 2) -> DataFrame:
    """Q31: per item average procurement cost over the last ``years`` years."""
    since = add_months_oracle(as_of, -12 * years)
    return (t["procurement"].filter(F.col("procurement_date") >= F.lit(since))
            .groupBy("item_id").agg(_avg("unit_cost").alias("avg_unit_cost")))


def supplier_comparison(t, item_id=None) -> DataFrame:
    """Q37: per (item, supplier): procurements, quantity, average cost rounded to cents."""
    p = t["procurement"]
    if item_id is not None:
        p = p.filter(F.col("item_id") == item_id)
    agg = p.groupBy("item_id", "supplier_id").agg(
        F.count("procurement_id").alias("times_ordered"),
        F.sum("quantity").cast("bigint").alias("total_quantity"),
        F.round(_avg("unit_cost"), 2).alias("avg_unit_cost"))
    return (agg.join(t["supplier"].select("supplier_id", "supplier_name"), "supplier_id")
               .select("item_id", "supplier_id", "supplier_name", "times_ordered", "total_quantity", "avg_unit_cost"))


def procurement_comparison(t) -> DataFrame:
    """For every procured item, its suppliers ranked by average cost (cheapest first).

    One pass: aggregate by (item, supplier), then a row number per item. The per-item
    window is bounded by the item's supplier count, not by its procurement rows.
    """
    items = t["item"].select("item_id", "item_name").join(t["procurement"].select("item_id"), "item_id", "left_semi")
    p = t["procurement"].join(t["supplier"].select("supplier_id", "supplier_name"), "supplier_id")
    agg = p.groupBy("item_id", "supplier_id", "supplier_name").agg(
        F.count("procurement_id").alias("times_ordered"),
        F.sum("quantity").cast("bigint").alias("total_quantity_supplied"),
        F.round(_avg("unit_cost"), 2).alias("avg_unit_cost"),
        F.sum(F.col("quantity") * F.col("unit_cost")).cast(MONEY).alias("total_spent"))
    w = Window.partitionBy("item_id").orderBy(F.col("avg_unit_cost").asc_nulls_last(), F.col("supplier_id"))
    return (agg.join(items, "item_id")
               .withColumn("supplier_rank", F.row_number().over(w))
               .select("item_id", "item_name", "supplier_rank", "supplier_id", "supplier_name", "times_ordered",
                       "total_quantity_supplied", "avg_unit_cost", "total_spent"))


def _procurement_multiplicity(t) -> DataFrame:
    """Procurement rows per (supplier, item) -- the fan-out factor of the supplier-sales view.

    The reference joins procurement to order lines on item alone, so every sale line is
    repeated once per procurement row of each supplier of the item. Instead of emitting
    those repeated rows, the repeat count is carried as a weight.
    """
    p = (t["procurement"].join(t["supplier"].select("supplier_id"), "supplier_id", "left_semi")
         .join(t["item"].select("item_id"), "item_id", "left_semi"))
    return p.groupBy("supplier_id", "item_id").agg(F.count(F.lit(1)).alias("procurement_rows"))


def supplier_item_sales_monthly(t) -> DataFrame:
    """Q11: the supplier x item x sale view, aggregated per (supplier, item, month).

    Quantities and sales carry the view's fan-out (each sale counted once per procurement
    row of the supplier for that item, D1); the repeated rows themselves are never built:
    sales are first summed per (item, month) and stored, then multiplied by the repeat count.
    Names are joined to the repeat counts: the view's rows, many for each of both, aren't dealt
    out once they are built.
    """
    sales = (t["order_item"].join(t["orders"].select("order_id", "order_date"), "order_id")
             .groupBy("item_id", F.trunc("order_date", "MM").alias("_month"))
             .agg(F.sum("quantity").alias("_q"),
                  F.sum(F.col("quantity") * F.col("unit_price")).alias("_s"),
                  F.count(F.lit(1)).alias("_lines")))
    sales = stored(sales.select("item_id", F.date_format("_month", "yyyy-MM").alias("month"), "_q", "_s", "_lines"))
    items = t["item"].select("item_id", "item_name", "category")
    sup = t["supplier"].select("supplier_id", "supplier_name")
    m = _procurement_multiplicity(t).join(sup, "supplier_id").join(items, "item_id")
    return (m.join(sales, "item_id")
             .select("supplier_id", "supplier_name", "item_id", "item_name", "category", "month",
                     "procurement_rows",
                     (F.col("_lines") * F.col("procurement_rows")).alias("view_rows"),
                     (F.col("_q") * F.col("procurement_rows")).cast("bigint").alias("quantity"),
                     (F.col("_s") * F.col("procurement_rows")).cast(MONEY).alias("sales")))


def supplier_item_sales(t, as_of: _dt.date, min_qty: int = 200, dedupe: bool = False) -> DataFrame:
    """Q12: previous calendar month quantity and sales by (supplier, category), HAVING qty > min_qty.

    ``dedupe=True`` counts each sale once per supplier of the item instead of once per
    procurement row (D1).
    """
    start, end = month_start(as_of, 1), month_start(as_of, 0)
    lines = (t["order_item"]
             .join(t["orders"].filter((F.col("order_date") >= F.lit(start)) & (F.col("order_date") < F.lit(end)))
                   .select("order_id"), "order_id"))
    per_item = lines.groupBy("item_id").agg(
        F.sum("quantity").alias("_q"), F.sum(F.col("quantity") * F.col("unit_price")).alias("_s"))
    m = _procurement_multiplicity(t)
    if dedupe:
        m = m.withColumn("procurement_rows", F.lit(1))
    j = (m.join(per_item, "item_id").join(t["item"].select("item_id", "category"), "item_id")
          .groupBy("supplier_id", "category")
          .agg(F.sum(F.col("_q") * F.col("procurement_rows")).cast("bigint").alias("quantity_sold"),
               F.sum(F.col("_s") * F.col("procurement_rows")).cast(MONEY).alias("total_sales")))
    return (j.filter(F.col("quantity_sold") > min_qty)
             .join(t["supplier"].select("supplier_id", "supplier_name"), "supplier_id")
             .select("supplier_id", "supplier_name", "category", "quantity_sold", "total_sales"))

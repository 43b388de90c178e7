"""Properties from the survey's test strategy, on the smallest data set."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from martlake.catalog import retail
from martlake.sources import requests as rq

Q = E.queries()


def _sum(df, col):
    return df.agg(F.sum(col)).first()[0] or 0


def test_rollup_detail_equals_totals(spark, small_dir):
    c = Q["category_sales_summary"](spark, small_dir)
    assert _sum(c.filter("level = 'ITEM'"), "revenue") == _sum(c.filter("level = 'CATEGORY'"), "revenue")
    p = Q["promotion_performance"](spark, small_dir)
    assert _sum(p.filter("level = 'ITEM'"), "sales_revenue") == _sum(p.filter("level = 'PROMOTION'"), "sales_revenue")
    cs = Q["company_summary"](spark, small_dir)
    assert _sum(cs.filter("level = 'BRANCH'"), "total_sales") == _sum(cs.filter("level = 'TOTAL'"), "total_sales")
    assert _sum(cs.filter("level = 'CATEGORY'"), "total_sales") == _sum(cs.filter("level = 'TOTAL'"), "total_sales")
    r = Q["stock_reorder"](spark, small_dir)
    assert r.filter("level = 'ITEM'").count() == r.filter("level = 'TOTAL'").first()["alert_count"]


def test_every_request_decided_once(spark, small_dir):
    reqs = {"update_item_prices": rq.price_changes(spark, small_dir), "transfer_stock": rq.transfers(spark, small_dir),
            "redeem_vouchers": rq.redemptions(spark, small_dir), "apply_pickup_updates": rq.pickup_events(spark, small_dir)}
    for name, req in reqs.items():
        d = Q[name](spark, small_dir)
        assert d.count() == req.count() == d.select("req_id").distinct().count(), name
    t = retail(spark, small_dir)
    po = Q["place_orders"](spark, small_dir)
    assert po.count() == t["orders"].count() == po.select("req_id").distinct().count()


def test_balances_never_negative(spark, small_dir):
    sf = "/root/testdata/sf0.01"
    t = retail(spark, sf)
    from martlake.operators import validations as V
    assert V.points_ledger(t).filter("balance_after < 0").count() == 0
    assert V.stock_ledger(t).filter("stock_after < 0").count() == 0
    b = Q["member_points_balances"](spark, sf)
    assert b.filter("closing < 0").count() == 0


def test_transfers_conserve_stock(spark, small_dir):
    t = retail(spark, small_dir)
    snap = Q["transfer_stock_snapshot"](spark, small_dir)
    before = {r.item_id: r.s for r in t["branch_stock"].groupBy("item_id").agg(F.sum("stock_quantity").alias("s")).collect()}
    after = {r.item_id: r.s for r in snap.groupBy("item_id").agg(F.sum("stock_quantity").alias("s")).collect()}
    assert before == after
    assert snap.filter("stock_quantity < 0").count() == 0


def test_orders_deduct_exactly_accepted_lines(spark, small_dir):
    t = retail(spark, small_dir)
    snap = Q["place_orders_snapshot"](spark, small_dir)
    dec = Q["place_orders"](spark, small_dir).filter("accepted")
    taken = (t["order_item"].join(dec.select(F.col("req_id").alias("order_id")), "order_id")
             .agg(F.sum("quantity")).first()[0] or 0)
    assert _sum(t["branch_stock"], "stock_quantity") - taken == _sum(snap, "stock_quantity")
    assert snap.filter("stock_quantity < 0").count() == 0

"""Batch jobs: brute-force loops for the order-dependent ones, literal fixtures for the rest."""

import datetime as dt
from decimal import Decimal


from martlake.catalog import retail
from martlake.plans import jobs
from martlake.sources import requests as rq
from martlake.sources.retail import EVENTS_AS_OF, from_frames

D = Decimal


def _t(spark, **frames):
    return from_frames(spark, {k: spark.createDataFrame(*v) for k, v in frames.items()})


def _transfer_loop(stock, items, branches, reqs):
    stock = dict(stock)
    out = {}
    for r in sorted(reqs, key=lambda r: (r["req_ts"], r["req_id"])):
        src, dst, it, q = r["from_branch"], r["to_branch"], r["item_id"], r["quantity"]
        if src == dst:
            out[r["req_id"]] = "-20010"
        elif q <= 0:
            out[r["req_id"]] = "-20011"
        elif it not in items or src not in branches or dst not in branches:
            out[r["req_id"]] = "NOT_FOUND"
        elif (src, it) not in stock:
            out[r["req_id"]] = "-20012"
        elif stock[(src, it)] < q:
            out[r["req_id"]] = "-20013"
        else:
            stock[(src, it)] -= q
            stock[(dst, it)] = stock.get((dst, it), 0) + q
            out[r["req_id"]] = None
    return out, stock


def test_transfer_stock_equals_loop(spark, small_dir):
    for sf in (small_dir, "/root/testdata/sf0.01"):
        t = retail(spark, sf)
        req = rq.transfers(spark, sf)
        res = jobs.transfer_stock(t, req, EVENTS_AS_OF)
        got = {r.req_id: r.code for r in res["decisions"].collect()}
        stock = {(r.branch_id, r.item_id): r.stock_quantity for r in t["branch_stock"].collect()}
        items = {r.item_id for r in t["item"].select("item_id").collect()}
        branches = {r.branch_id for r in t["branch"].select("branch_id").collect()}
        exp, exp_stock = _transfer_loop(stock, items, branches, [r.asDict() for r in req.collect()])
        assert got == exp
        snap = {(r.branch_id, r.item_id): r.stock_quantity for r in res["snapshot"].collect()}
        assert snap == exp_stock
        assert any(c == "-20013" for c in got.values())


def test_register_members_fixture(spark):
    member = ([(1, "Old", "900101-14-0001", "old@x.com", dt.date(1990, 1, 1), dt.date(2029, 1, 1), 0)],
              "member_id long, name string, ic string, email string, date_of_birth date, expiry_date date, points_balance long")
    t = _t(spark, member=member)
    req = spark.createDataFrame([
        (1, dt.datetime(2026, 7, 20, 9), "Test Member", "010101-10-1234", None, dt.date(2001, 1, 1), None),
        (2, dt.datetime(2026, 7, 20, 10), "Again", "010101-10-1234", None, dt.date(2001, 1, 1), None),
        (3, dt.datetime(2026, 7, 20, 11), "Dup email", "020202-10-1234", "old@x.com", dt.date(2002, 2, 2), None),
        (4, dt.datetime(2026, 7, 20, 12), "Future", "030303-10-1234", None, dt.date(2030, 1, 1), None)],
        "req_id long, req_ts timestamp_ntz, name string, ic string, email string, date_of_birth date, address string")
    res = jobs.register_members(t, req, dt.date(2026, 7, 20))
    assert {r.req_id: r.code for r in res["decisions"].collect()} == {1: None, 2: "-20001", 3: "-20002", 4: "-20003"}
    (m,) = res["new_members"].collect()
    assert m.expiry_date == dt.date(2027, 7, 20) and m.points_balance == 0


def test_pickup_fixtures(spark):
    now = dt.datetime(2026, 7, 20, 12)
    orders = ([(1, "Self Pickup"), (2, "Self Pickup"), (3, "Self Pickup"), (5, "In Store")], "order_id long, order_type string")
    sp = ([(11, 1, None, "Preparing", None), (12, 2, None, "Ready", now + dt.timedelta(days=3)),
           (13, 3, None, "Ready", now - dt.timedelta(days=1))],
          "pickup_id long, order_id long, pickup_datetime timestamp_ntz, pickup_status string, pickup_exp_date timestamp_ntz")
    t = _t(spark, orders=orders, self_pickup=sp)
    req = spark.createDataFrame([
        (1, now, 1, "Ready", None), (2, now + dt.timedelta(minutes=1), 1, "Rescheduled", now + dt.timedelta(days=5)),
        (3, now, 2, "Completed", None), (4, now, 3, "Completed", None), (5, now, 2, "Shipped", None),
        (6, now, 5, "Ready", None), (7, now, 99999, "Ready", None)],
        "req_id long, req_ts timestamp_ntz, order_id long, new_status string, reschedule_date timestamp_ntz")
    res = jobs.apply_pickup_updates(t, req)
    assert {r.req_id: r.code for r in res["decisions"].collect()} == {
        1: None, 2: None, 3: None, 4: "-20640", 5: "-20638", 6: "-20639", 7: "-20641"}
    snap = {r.order_id: (r.pickup_status, r.pickup_exp_date, r.pickup_datetime) for r in res["snapshot"].collect()}
    assert snap[1] == ("Rescheduled", now + dt.timedelta(days=5), None)
    assert snap[2][0] == "Completed" and snap[2][2] == now
    assert snap[3][0] == "Expired"


def test_delivery_updates(spark):
    now = dt.datetime(2026, 7, 20, 12)
    orders = ([(1, "Delivery"), (2, "Delivery"), (3, "Delivery")], "order_id long, order_type string")
    comp = ([(2001, "C")], "company_id long, company_name string")
    dl = ([(50001, 1, 2001, "addr", None, "Pending")],
          "delivery_id long, order_id long, company_id long, delivery_address string, delivery_date timestamp_ntz, delivery_status string")
    t = _t(spark, orders=orders, delivery_company=comp, delivery=dl)
    req = spark.createDataFrame([
        (1, now, "update", 50001, None, None, None, "Delivered"),
        (2, now + dt.timedelta(hours=1), "update", 50001, None, None, None, "Cancelled"),
        (3, now, "create", 50002, 2, 2001, "  ", "Pending"),
        (4, now, "create", 50003, 3, 2001, "road 1", "Preparing"),
        (5, now, "create", 50004, 1, 2001, "road 2", "Pending"),
        (6, now, "update", 59999, None, None, None, "Pending"),
        (7, now, "update", 50001, None, None, None, "Lost")],
        "req_id long, req_ts timestamp_ntz, action string, delivery_id long, order_id long, company_id long, address string, status string")
    res = jobs.apply_delivery_updates(t, req)
    assert {r.req_id: r.code for r in res["decisions"].collect()} == {
        1: None, 2: "-20051", 3: "-20056", 4: None, 5: "-20054", 6: "-20052", 7: "-20050"}
    snap = {r.delivery_id: (r.delivery_status, r.delivery_date) for r in res["snapshot"].collect()}
    assert snap[50001] == ("Delivered", now) and snap[50003] == ("Preparing", None)


def test_create_promotions_fixture(spark):
    item = ([(1, "BA001", D("10.00")), (2, "COF001", D("8.00"))], "item_id long, item_name string, unit_price decimal(8,2)")
    t = _t(spark, item=item)
    det = "array<struct<item_id:long,discount_type:string,discount_value:decimal(8,2)>>"
    req = spark.createDataFrame([
        (1, dt.datetime(2026, 7, 20), 9001, "Summer Sale", None, dt.date(2026, 7, 21), dt.date(2026, 10, 31),
         [(1, "Percentage", D("10")), (2, "Amount", D("5"))]),
        (2, dt.datetime(2026, 7, 20), 9002, "Bad", None, dt.date(2026, 7, 21), dt.date(2026, 10, 31),
         [(1, "Percentage", D("120")), (9, "Amount", D("5"))]),
        (3, dt.datetime(2026, 7, 20), 9003, "Dup", None, dt.date(2026, 7, 21), dt.date(2026, 7, 1), [(1, "Amount", D("1"))])],
        f"req_id long, req_ts timestamp_ntz, promotion_id long, name string, description string, start_date date, end_date date, details {det}")
    res = jobs.create_promotions(t, req)
    assert {r.req_id: r.code for r in res["decisions"].collect()} == {1: None, 2: "-20007", 3: "-20003"}
    assert res["promotions"].count() == 1 and res["promotion_details"].count() == 2


def test_price_and_points_fixture(spark):
    item = ([(1, "BA001", D("10.00")), (2, "COF001", D("8.00"))], "item_id long, item_name string, unit_price decimal(8,2)")
    promo = ([(5033, "Summer Sale", "Active", dt.date(2026, 7, 1), dt.date(2026, 10, 31))],
             "promotion_id long, promotion_name string, status string, start_date date, end_date date")
    pd_ = ([(5033, 1, "Percentage", D("10")), (5033, 2, "Amount", D("5"))],
           "promotion_id long, item_id long, discount_type string, discount_value decimal(8,2)")
    t = _t(spark, item=item, promotion=promo, promotion_details=pd_)
    when = dt.datetime(2026, 7, 20, 10)
    lines = spark.createDataFrame([(100402, 1, 2, when), (100402, 2, 3, when), (100402, 7, 1, when)],
                                  "order_id long, item_id long, quantity int, priced_at timestamp_ntz")
    res = jobs.price_order_lines(t, lines)
    assert {r.item_id: r.unit_price for r in res["lines"].collect()} == {1: D("9.00"), 2: D("3.00")}
    assert {r.item_id: r.code for r in res["decisions"].collect()}[7] == "-20003"
    orders = spark.createDataFrame([(100402, 9001, when)], "order_id long, member_id long, order_date timestamp_ntz")
    pts = jobs.award_points(t, res["lines"], orders, spark.createDataFrame([], "order_id long")).collect()
    assert [(p.member_id, p.amount) for p in pts] == [(9001, 27)]


def test_write_snapshot_new_version(spark, small_dir, tmp_path):
    from martlake.sources.snapshot import write_snapshot
    t = retail(spark, small_dir)
    res = jobs.transfer_stock(t, rq.transfers(spark, small_dir), EVENTS_AS_OF)
    p1 = write_snapshot(res["snapshot"], str(tmp_path), partition_by=["branch_id"], cluster_by=["item_id"])
    p2 = write_snapshot(res["snapshot"], str(tmp_path))
    assert p1 != p2
    assert spark.read.parquet(p1).count() == spark.read.parquet(p2).count() == res["snapshot"].count()


def test_insert_rules_of_redemption_and_pickup(spark):
    """The redemption table's own rules: one voucher once an order, guests included, and no order
    dated after the voucher's expiry; a pickup isn't moved into the past."""
    at = lambda d, h=0: dt.datetime(2026, 7, d, h)
    voucher = ([("V1", dt.date(2026, 7, 20)), ("V2", dt.date(2026, 7, 20))], "voucher_id string, exp_date date")
    member = ([(7, None), (8, None)], "member_id long, expiry_date date")
    orders = ([(1, None, at(10)), (2, None, at(20)), (3, None, at(20, 1)), (4, 7, at(25)), (5, 7, at(11)), (6, 8, at(12)), (9, None, at(9)), (10, 7, at(12))],
              "order_id long, member_id long, order_date timestamp_ntz")
    redemption = ([(1, "V2", 9, at(9))], "redemption_id long, voucher_id string, order_id long, redeemed_date timestamp_ntz")
    t = _t(spark, voucher=voucher, member=member, orders=orders, redemption=redemption)
    req = spark.createDataFrame([
        (1, at(15, 1), "V1", 1, 7), (2, at(15, 2), "V1", 1, 8),  # the guest order's voucher again
        (3, at(15, 3), "V1", 2, 7),  # dated at the expiry's midnight: still valid
        (4, at(15, 4), "V1", 3, 7),  # an hour later
        (5, at(15, 5), "V1", 4, 7),  # a member's order dated after the expiry ...
        (6, at(15, 6), "V1", 5, 7),  # ... doesn't use up the voucher
        (7, at(15, 7), "V1", 4, 7), (8, at(15, 8), "V1", 10, 7),  # once a member, before the other rule
        (9, at(15, 9), "V2", 9, 7),  # in the history
        (10, at(15, 10), "V1", 6, 8)],
        "req_id long, req_ts timestamp_ntz, voucher_id string, order_id long, member_id long")
    res = jobs.redeem_vouchers(t, req, dt.date(2026, 7, 15))
    assert {r.req_id: r.code for r in res["decisions"].collect()} == {
        1: None, 2: "-20031", 3: None, 4: "-20032", 5: "-20032", 6: None, 7: "-20044", 8: "-20044", 9: "-20031", 10: None}
    assert {r.redemption_id for r in res["redemptions"].collect()} == {1, 3, 6, 10}

    t = _t(spark, orders=([(1, "Self Pickup")], "order_id long, order_type string"),
           self_pickup=([(11, 1, None, "Preparing", at(30))], "pickup_id long, order_id long, pickup_datetime timestamp_ntz, pickup_status string, pickup_exp_date timestamp_ntz"))
    req = spark.createDataFrame([(1, at(15), 1, "Rescheduled", at(14)), (2, at(15), 1, "Rescheduled", at(15)), (3, at(16), 1, "Rescheduled", at(1))],
                                "req_id long, req_ts timestamp_ntz, order_id long, new_status string, reschedule_date timestamp_ntz")
    res = jobs.apply_pickup_updates(t, req)
    assert {r.req_id: r.code for r in res["decisions"].collect()} == {1: "-20003", 2: None, 3: "-20003"}
    assert [(r.pickup_status, r.pickup_exp_date) for r in res["snapshot"].collect()] == [("Rescheduled", at(15))]

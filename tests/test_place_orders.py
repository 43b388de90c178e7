"""W11 place_orders: the reference's order-placement cases and a sequential loop."""

import datetime as dt
import random
from decimal import Decimal

from martlake.catalog import retail
from martlake.plans.orders import place_orders, replay_orders, settle
from martlake.sources.retail import RETAIL_AS_OF, from_frames

D = Decimal
NOW = dt.datetime(2026, 7, 20, 10, 0)
HDR = "req_id long, req_ts timestamp_ntz, member_id long, staff_id long, branch_id long, order_type string, voucher_id string, address string"
LIN = "req_id long, line_no int, item_id long, quantity int"


def base(spark, promo=False, voucher_exp=NOW.date() + dt.timedelta(days=30), used=False):
    f = {
        "branch": ([(9001, "Test Branch")], "branch_id long, branch_name string"),
        "member": ([(9001, "T", "900101-14-0001", None, None, dt.date(1990, 1, 1), dt.date(2029, 1, 1), 0)],
                   "member_id long, name string, ic string, email string, address string, date_of_birth date, expiry_date date, points_balance long"),
        "item": ([(1, "PT001", D("10.00"), "Groceries"), (2, "PT002", D("20.00"), "Groceries"), (3, "PT003", D("30.00"), "Groceries")],
                 "item_id long, item_name string, unit_price decimal(8,2), category string"),
        "branch_stock": ([(9001, 1, 50, None), (9001, 2, 10, None)],
                         "branch_id long, item_id long, stock_quantity int, last_restock_date date"),
        "voucher": ([("V9001", "Amount", D("5"), voucher_exp)], "voucher_id string, voucher_type string, voucher_value decimal(8,2), exp_date date"),
        "orders": ([(9001, 9001, 9001, 9001, NOW - dt.timedelta(days=5), "In Store")],
                   "order_id long, member_id long, staff_id long, branch_id long, order_date timestamp_ntz, order_type string"),
        "redemption": ([(1, "V9001", 9001, NOW - dt.timedelta(days=5))] if used else [],
                       "redemption_id long, voucher_id string, order_id long, redeemed_date timestamp_ntz"),
        "promotion": ([(9001, "P", "Active", (NOW - dt.timedelta(days=1)).date(), (NOW + dt.timedelta(days=7)).date())] if promo else [],
                      "promotion_id long, promotion_name string, status string, start_date date, end_date date"),
        "promotion_details": ([(9001, 1, "Percentage", D("10"))] if promo else [],
                              "promotion_id long, item_id long, discount_type string, discount_value decimal(8,2)"),
        "delivery_company": ([(2001, "C")], "company_id long, company_name string"),
    }
    return from_frames(spark, {k: spark.createDataFrame(*v) for k, v in f.items()})


def run(spark, t, member, otype, lines, voucher=None):
    h = spark.createDataFrame([(100, NOW, member, 9001, 9001, otype, voucher, None)], HDR)
    ln = spark.createDataFrame([(100, i, it, q) for i, (it, q) in enumerate(lines)], LIN)
    return place_orders(t, h, ln, NOW.date())


def code(res):
    (r,) = res["decisions"].collect()
    return r.code


def test_case_1_and_11(spark):
    res = run(spark, base(spark, promo=True), 9001, "In Store", [(1, 3), (2, 2)], "V9001")
    assert code(res) is None
    assert {r.item_id: r.unit_price for r in res["order_lines"].collect()} == {1: D("9.00"), 2: D("20.00")}
    assert res["points"].count() == 0 and res["redemptions"].count() == 1
    assert {r.item_id: r.stock_quantity for r in res["snapshot"].collect()} == {1: 47, 2: 8}
    assert [(r.item_id, r.stock_after) for r in res["low_stock_alerts"].collect()] == [(2, 8)]
    res = run(spark, base(spark, promo=True), 9001, "In Store", [(1, 3), (2, 2)])
    assert [(p.member_id, p.amount) for p in res["points"].collect()] == [(9001, 67)]


def test_rejections(spark):
    t = base(spark)
    res = run(spark, t, None, "In Store", [(1, 1)])
    assert code(res) is None and [r.unit_price for r in res["order_lines"].collect()] == [D("10.00")]
    assert res["points"].count() == 0
    assert code(run(spark, t, 9001, "In Store", [(3, 5)])) == "-20002"
    assert code(run(spark, t, 9001, "In Store", [(2, 11)])) == "-20001"
    assert code(run(spark, t, 9001, "In Store", [])) == "-20006"
    assert code(run(spark, t, 9001, "Delivery", [(77, 1)])) == "-20002"
    assert code(run(spark, t, None, "In Store", [(1, 1)], "V9001")) == "-20009"
    assert code(run(spark, base(spark, voucher_exp=NOW.date() - dt.timedelta(days=1)), 9001, "In Store", [(1, 1)], "V9001")) == "-20040"
    assert code(run(spark, base(spark, used=True), 9001, "In Store", [(1, 1)], "V9001")) == "-20044"
    assert code(run(spark, t, None, "Delivery", [(1, 1)])) == "-20008"
    assert code(run(spark, t, None, "Self Pickup", [(1, 1)])) == "-20008"
    assert code(run(spark, t, 9001, "Delivery", [(1, 1)])) == "-20010"


def _loop(t, headers, lines):
    stock = {(r.branch_id, r.item_id): r.stock_quantity for r in t["branch_stock"].collect()}
    by_req = {}
    for l in sorted(lines, key=lambda l: (l.req_id, l.line_no)):
        by_req.setdefault(l.req_id, []).append(l)
    out = {}
    for h in sorted(headers, key=lambda h: (h.req_ts, h.req_id)):
        ls = by_req.get(h.req_id, [])
        c = None if ls else "-20006"
        for l in ls:
            if (h.branch_id, l.item_id) not in stock:
                c = "-20002"
                break
            if stock[(h.branch_id, l.item_id)] < l.quantity:
                c = "-20001"
                break
        out[h.req_id] = c
        if c is None:
            for l in ls:  # accepted: deduct every line
                stock[(h.branch_id, l.item_id)] -= l.quantity
    return out, stock


def test_replay_equals_loop(spark, small_dir):
    t = retail(spark, small_dir)
    h, ln = replay_orders(t)
    # keep the stock-only part comparable: In Store orders without vouchers
    h = h.filter("order_type = 'In Store' and voucher_id is null and member_id is not null")
    ln = ln.join(h.select("req_id"), "req_id", "left_semi")
    res = place_orders(t, h, ln, RETAIL_AS_OF)
    got = {r.req_id: r.code for r in res["decisions"].collect()}
    exp, stock = _loop(t, h.collect(), ln.collect())
    assert got == exp
    assert any(c == "-20001" for c in got.values()) and any(c is None for c in got.values())
    snap = {(r.branch_id, r.item_id): r.stock_quantity for r in res["snapshot"].collect()}
    assert snap == stock


def test_delivery_with_given_address(spark):
    t = base(spark)
    h = spark.createDataFrame([(100, NOW, 9001, 9001, 9001, "Delivery", None, "1 Jalan Test")], HDR)
    ln = spark.createDataFrame([(100, 0, 1, 2)], LIN)
    res = place_orders(t, h, ln, NOW.date())
    assert code(res) is None
    (d,) = res["deliveries"].collect()
    assert (d.order_id, d.company_id, d.delivery_address, d.delivery_status) == (100, 2001, "1 Jalan Test", "Preparing")
    assert res["pickups"].count() == 0


def test_settle_in_rounds(spark):
    """Requests for several scarce resources equal the loop in a few rounds, each with fewer
    entries; one resource holds a third of all entries."""
    rnd = random.Random(9)
    opening = {f"r{k}": rnd.randint(5, 60) for k in range(60)} | {"hot": 900}
    rows = []
    for i in range(1500):
        names = set(rnd.sample(sorted(opening), rnd.randint(1, 4))) | ({"hot"} if rnd.random() < 0.6 else set())
        rows += [(i, NOW + dt.timedelta(seconds=i * 7919 % 1013), n, rnd.randint(1, 4), opening[n]) for n in sorted(names)]
    entries = spark.createDataFrame(rows, "req_id long, req_ts timestamp_ntz, resource string, q long, opening long")
    out, rounds = settle(entries)
    left, exp = dict(opening), {}
    by_req = {}
    for i, ts, n, q, _ in rows:
        by_req.setdefault((ts, i), []).append((n, q))
    for (_, i), wants in sorted(by_req.items()):
        exp[i] = all(left[n] >= q for n, q in wants)
        if exp[i]:
            for n, q in wants:
                left[n] -= q
    assert {r.req_id: r.accepted for r in out.collect()} == exp and 0 < sum(exp.values()) < len(exp)
    assert len(rounds) <= 25 and all(a > b for a, b in zip(rounds, rounds[1:]))


def test_long_chain_of_voucher_rivals(spark):
    """Forty orders of one member with one voucher, each short of stock but the last: the voucher
    goes to the last, and the rounds don't follow the chain."""
    t = base(spark)
    n = 40
    h = spark.createDataFrame([(100 + i, NOW + dt.timedelta(minutes=i), 9001, 9001, 9001, "In Store", "V9001", None) for i in range(n)]
                              + [(900, NOW + dt.timedelta(hours=5), 9001, 9001, 9001, "In Store", "V9001", None)], HDR)
    ln = spark.createDataFrame([(100 + i, 0, 2, 11 + i if i < n - 1 else 3) for i in range(n)] + [(900, 0, 1, 1)], LIN)
    res = place_orders(t, h, ln, NOW.date())
    codes = {r.req_id: r.code for r in res["decisions"].collect()}
    assert codes == {100 + i: "-20001" for i in range(n - 1)} | {100 + n - 1: None, 900: "-20044"}
    assert len(res["rounds"]) <= 3

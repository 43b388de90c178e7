"""Literal fixtures of the reference's trigger tests (FIXTURES.md 2.3)."""

import datetime as dt
from decimal import Decimal

from martlake.operators import constraints as C
from martlake.operators import validations as V
from martlake.sources.retail import from_frames

D = Decimal


def _t(spark, **frames):
    return from_frames(spark, {k: spark.createDataFrame(*v) for k, v in frames.items()})


MEMBER = "member_id long, name string, ic string, email string, date_of_birth date, expiry_date date, points_balance long"


def test_ic_dob_rule(spark):
    rows = [(1, "A", "010520-01-1234", None, dt.date(2001, 5, 20), None, 0),
            (2, "B", "010520-01-5678", None, dt.date(2001, 5, 21), None, 0),
            (3, "C", "500101-01-0001", None, dt.date(1950, 1, 1), None, 0),
            (4, "D", "490101-01-0001", None, dt.date(2049, 1, 1), None, 0),
            (5, "E", "990230-01-0001", None, None, None, 0),
            (6, "F", "020620-01-1234", None, dt.date(2001, 5, 20), None, 0)]
    t = _t(spark, member=(rows, MEMBER))
    got = {(r.row_key, r.code) for r in V.ic_dob_mismatch(t).collect()}
    assert got == {("2", -20012), ("5", -20011), ("6", -20012)}


def test_member_age_and_patterns(spark):
    as_of = dt.date(2026, 7, 20)
    rows = [(1, "A", "010520011234", None, dt.date(2020, 1, 1), None, -10),
            (2, "B", "010520-01-1234", "a@b.com", dt.date(2027, 1, 1), None, 0),
            (3, "C", "010520-01-1234", "a@b.com", dt.date(2000, 1, 1), None, 5)]
    t = _t(spark, member=(rows, MEMBER))
    age = {(r.row_key, r.code) for r in V.member_age(t, as_of).collect()}
    assert age == {("1", -20032), ("2", -20031)}
    cons = {(r.check_id, r.constraint_name, r.row_key) for r in C.constraint_violations(t, ("C03", "C05", "C07")).collect()}
    assert ("C05", "chk_member_ic", "1") in cons
    assert ("C07", "chk_member_points", "1") in cons
    assert ("C03", "uq_member_ic", "010520-01-1234") in cons


def test_discount_above_price(spark):
    item = ([(1, "BA001", D("8.00"))], "item_id long, item_name string, unit_price decimal(8,2)")
    pd = ([(1, 1, "Amount", D("5.00")), (2, 1, "Amount", D("10.00")), (3, 1, "Percentage", D("50.00")),
           (4, 9, "Amount", D("1.00"))],
          "promotion_id long, item_id long, discount_type string, discount_value decimal(8,2)")
    t = _t(spark, item=item, promotion_details=pd)
    got = {(r.row_key, r.code) for r in V.discount_above_price(t).collect()}
    assert got == {("2|1", -20020), ("4|9", -20021)}


def test_redemption_rules(spark):
    orders = ([(100001, None, 1, dt.datetime(2026, 7, 1)), (100005, None, 1, dt.datetime(2026, 7, 2))],
              "order_id long, member_id long, branch_id long, order_date timestamp_ntz")
    voucher = ([("V001", "Amount", D("5"), dt.date(2026, 6, 30)), ("V002", "Amount", D("5"), None)],
               "voucher_id string, voucher_type string, voucher_value decimal(8,2), exp_date date")
    red = ([(1, "V002", 100001, dt.datetime(2026, 7, 1, 10)), (2, "V002", 100001, dt.datetime(2026, 7, 1, 11)),
            (3, "V001", 100005, dt.datetime(2026, 7, 2)), (4, "V002", 999, None)],
           "redemption_id long, voucher_id string, order_id long, redeemed_date timestamp_ntz")
    t = _t(spark, orders=orders, voucher=voucher, redemption=red)
    assert {(r.row_key, r.code) for r in V.duplicate_redemption(t).collect()} == {("2", -20031), ("4", -20030)}
    assert {(r.row_key, r.code) for r in V.expired_redemption(t).collect()} == {("3", -20032), ("4", -20030)}


def test_ledger_fixtures(spark):
    orders = ([(1, 9001, dt.datetime(2026, 7, 1))], "order_id long, branch_id long, order_date timestamp_ntz")
    item = ([(1, "PT001", D("10.00"))], "item_id long, item_name string, unit_price decimal(8,2)")
    stock = ([(9001, 1, 50, None)], "branch_id long, item_id long, stock_quantity int, last_restock_date date")
    lines = ([(1, 1, 999999, D("10.00"))], "order_id long, item_id long, quantity int, unit_price decimal(8,2)")
    t = _t(spark, orders=orders, item=item, branch_stock=stock, order_item=lines)
    assert [(r.row_key, r.code) for r in V.stock_ledger_rule(t).collect()] == [("1|1", -20013)]
    member = ([(9001, "M", None, None, None, None, 10)], MEMBER)
    ph = ([(1, 9001, 999999, "Used", dt.datetime(2026, 7, 1)), (2, 9001, 5, "Earned", dt.datetime(2026, 7, 2)),
           (3, 9001, 15, "Used", dt.datetime(2026, 7, 3)), (4, 9001, 0, "Used", dt.datetime(2026, 7, 4))],
          "point_redemption_id long, member_id long, amount long, transaction_type string, redemption_date timestamp_ntz")
    t2 = _t(spark, member=member, point_history=ph)
    assert {(r.row_key, r.code) for r in V.points_ledger_rule(t2).collect()} == {("1", -20023), ("4", -20020)}
    assert [tuple(r) for r in V.member_balances(t2).collect()] == [(9001, 10, 0)]


def test_price_below_cost(spark):
    item = ([(1, "BA001", D("0.00")), (2, "X", D("9.00"))], "item_id long, item_name string, unit_price decimal(8,2)")
    proc = ([(1, 1, D("3.00"), dt.date(2026, 1, 1)), (2, 1, D("2.00"), dt.date(2026, 2, 1))],
            "procurement_id long, item_id long, unit_cost decimal(8,2), procurement_date date")
    t = _t(spark, item=item, procurement=proc)
    assert [(r.row_key, r.code) for r in V.price_below_cost(t).collect()] == [("1", -20020)]


def test_pickup_expiry_past(spark):
    sp = ([(1, 10, "Ready", dt.datetime(2026, 7, 19, 9)), (2, 11, "Ready", dt.datetime(2026, 7, 21)), (3, 12, "Preparing", None)],
          "pickup_id long, order_id long, pickup_status string, pickup_exp_date timestamp_ntz")
    t = _t(spark, self_pickup=sp)
    assert [(r.row_key, r.code) for r in V.pickup_expiry_past(t, dt.datetime(2026, 7, 20)).collect()] == [("1", -20003)]

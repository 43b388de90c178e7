"""Literal cases and random batches against one-call-at-a-time loops: registration, transfers,
deliveries, promotions, order placement."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martlake.plans import jobs
from martlake.plans.orders import place_orders
from martlake.session import checkpoint_dir
from martlake.sources.retail import from_frames
from tests.test_place_orders import HDR, LIN, NOW, base

D = Decimal
DAY = dt.date(2024, 1, 31)
T0 = dt.datetime(2024, 1, 1)
REG = "req_id long, req_ts timestamp_ntz, name string, ic string, email string, date_of_birth date, address string"


def members(spark, rows=()):
    return {"member": spark.createDataFrame(list(rows), "member_id long, ic string, email string")}


def register(spark, rows, known=()):
    res = jobs.register_members(members(spark, known), spark.createDataFrame(rows, REG), DAY)
    codes = {r.req_id: r.code for r in res["decisions"].collect()}
    assert {r.member_id for r in res["new_members"].collect()} == {i for i, c in codes.items() if c is None}
    return codes


def registration_loop(rows, known=()):
    ics, mails, out = {k[1] for k in known}, {k[2] for k in known if k[2]}, {}
    for rid, ts, _, ic, mail, dob, _ in sorted(rows, key=lambda r: (r[1], r[0])):
        code = None
        try:
            year = int(ic[:2]) + (1900 if int(ic[:2]) >= 50 else 2000)
            day = dt.date(year, int(ic[2:4]), int(ic[4:6]))
        except ValueError:
            day = None
        if dob > DAY:
            code = "-20003"
        elif ic in ics:
            code = "-20001"
        elif mail is not None and mail in mails:
            code = "-20002"
        elif day is None:
            code = "-20011"
        elif day != dob:
            code = "-20012"
        elif dob > dt.date(DAY.year - 12, DAY.month, DAY.day):
            code = "-20032"
        if code is None:
            ics.add(ic)
            if mail:
                mails.add(mail)
        out[rid] = code
    return out


def test_a_rejected_request_claims_nothing(spark):
    dob = dt.date(1990, 1, 1)
    rows = [(1, T0, "c", "900101-C", "x", dob, None), (2, T0 + dt.timedelta(1), "a", "900101-A", "x", dob, None),
            (3, T0 + dt.timedelta(2), "a", "900101-A", "y", dob, None)]
    assert register(spark, rows) == {1: None, 2: "-20002", 3: None}


def test_registrations_equal_the_loop(spark):
    rng = random.Random(8)
    days = [dt.date(1990, 1, 1), dt.date(2001, 5, 20), dt.date(2022, 3, 3), dt.date(2030, 1, 1)]
    rows = []
    for i in range(150):
        dob = rng.choices(days, [6, 6, 1, 1])[0]
        ic = rng.choices([f"{dob:%y%m%d}-{rng.randrange(30)}", "999999-1", f"900102-{rng.randrange(9)}"], [10, 1, 1])[0]
        rows.append((i, T0 + dt.timedelta(hours=rng.randrange(100)), "n", ic, rng.choice([None, *[f"m{k}" for k in range(40)]]), dob, None))
    known = [(1, "900101-3", "m1"), (2, "010520-4", None)]
    got = register(spark, rows, known)
    assert got == registration_loop(rows, known)
    assert len({c for c in got.values()}) >= 6


def test_transfer_sets_the_destinations_restock_date(spark):
    old = dt.date(2020, 1, 1)
    t = {"branch_stock": spark.createDataFrame([(1, 7, 10, old), (2, 7, 5, old), (1, 8, 2, old), (2, 8, 2, old)],
                                               "branch_id long, item_id long, stock_quantity int, last_restock_date date"),
         "item": spark.createDataFrame([(7,), (8,)], "item_id long"), "branch": spark.createDataFrame([(1,), (2,), (3,)], "branch_id long")}
    req = spark.createDataFrame([(1, T0, 1, 2, 7, 3), (2, T0, 1, 3, 7, 1), (3, T0, 1, 2, 8, 2), (4, T0 + dt.timedelta(1), 1, 2, 8, 2)],
                                "req_id long, req_ts timestamp_ntz, from_branch long, to_branch long, item_id long, quantity int")
    res = jobs.transfer_stock(t, req, DAY)
    assert {r.req_id: r.code for r in res["decisions"].collect()} == {1: None, 2: None, 3: None, 4: "-20013"}
    got = {(r.branch_id, r.item_id): (r.stock_quantity, r.last_restock_date) for r in res["snapshot"].collect()}
    assert got == {(1, 7): (6, old), (2, 7): (8, DAY), (3, 7): (1, DAY), (1, 8): (0, old), (2, 8): (4, DAY)}


def test_delivery_address_is_trimmed_and_null_status_passes(spark):
    t = {"delivery": spark.createDataFrame([(50, 5, 1, "Pending")], "delivery_id long, order_id long, company_id long, delivery_status string"),
         "orders": spark.createDataFrame([(5,), (6,), (7,)], "order_id long"), "delivery_company": spark.createDataFrame([(1,)], "company_id long")}
    req = spark.createDataFrame([(1, T0, "create", 90, 6, 1, "  12 Jalan  ", "Pending"), (2, T0, "create", 91, 7, 1, "x", None),
                                 (3, T0, "update", 50, 5, 1, None, "Lost"), (4, T0, "update", 50, 5, 1, None, None)],
                                "req_id long, req_ts timestamp_ntz, action string, delivery_id long, order_id long, company_id long, address string, status string")
    res = jobs.apply_delivery_updates(t, req)
    assert {r.req_id: r.code for r in res["decisions"].collect()} == {1: None, 2: None, 3: "-20050", 4: None}
    got = {r.delivery_id: (r.delivery_address, r.delivery_status) for r in res["snapshot"].collect()}
    assert got == {90: ("12 Jalan", "Pending"), 91: ("x", None), 50: (None, None)}


def test_promotion_name_type_and_price(spark):
    t = {"item": spark.createDataFrame([(1, D("5.00"))], "item_id long, unit_price decimal(8,2)")}
    hdr = spark.createDataFrame([(i, T0, 100 + i, name, None, DAY, DAY) for i, name in enumerate(["  ", "", None, "ok", "ok", "ok"])],
                                "req_id long, req_ts timestamp_ntz, promotion_id long, name string, description string, start_date date, end_date date")
    lines = spark.createDataFrame([(0, 0, 1, "Amount", D("5")), (1, 0, 1, "Amount", D("1")), (2, 0, 1, "Amount", D("1")), (3, 0, 1, None, D("9")),
                                   (4, 0, 1, "Amount", D("5.01")), (5, 0, 1, "Percentage", D("6")), (5, 1, 1, "Amount", D("9"))],
                                  "req_id long, pos int, item_id long, discount_type string, discount_value decimal(8,2)")
    got = {r.req_id: r.code for r in jobs.create_promotions(t, hdr, lines)["decisions"].collect()}
    assert got == {0: None, 1: "-20001", 2: "-20001", 3: None, 4: "-20020", 5: "-20020"}


def place(spark, t, heads, lines):
    res = place_orders(t, spark.createDataFrame(heads, HDR), spark.createDataFrame(lines, LIN), NOW.date())
    stock = {(r.branch_id, r.item_id): r.stock_quantity for r in res["snapshot"].collect()}
    return {r.req_id: r.code for r in res["decisions"].collect()}, stock


def test_line_rules(spark):
    """An item twice, a quantity of no items, an expired member."""
    t = base(spark)
    m = t["member"]
    t["member"] = m.union(m.withColumn("member_id", F.lit(9002).cast("long")).withColumn("expiry_date", F.lit(dt.date(2020, 1, 1))))
    heads = [(i, NOW, member, 9001, 9001, "In Store", None, None) for i, member in ((1, 9001), (2, 9001), (3, 9001), (4, 9002), (5, None))]
    lines = [(1, 0, 2, 6), (1, 1, 2, 6), (2, 0, 1, -5), (3, 0, 1, 1), (3, 1, 1, 1), (4, 0, 1, 1), (5, 0, 1, 2)]
    codes, stock = place(spark, t, heads, lines)
    assert codes == {1: "-20013", 2: "-20014", 3: "-1", 4: "-20030", 5: None}
    assert stock == {(9001, 1): 48, (9001, 2): 10}


def test_a_failed_order_leaves_its_voucher(spark):
    t = base(spark)
    heads = [(i, NOW + dt.timedelta(minutes=i), 9001, 9001, 9001, "In Store", "V9001", None) for i in (1, 2, 3)]
    codes, _ = place(spark, t, heads, [(1, 0, 2, 11), (2, 0, 2, 4), (3, 0, 1, 1)])
    assert codes == {1: "-20001", 2: None, 3: "-20044"}


def placement_loop(stock, heads, lines):
    by, used, out = {}, set(), {}
    for req, no, item, q in sorted(lines):
        by.setdefault(req, []).append((item, q))
    for req, ts, member, _, branch, _, voucher, _ in sorted(heads, key=lambda h: (h[1], h[0])):
        ls, code = by.get(req, []), None
        if not ls:
            code = "-20006"
        elif member is None and voucher:
            code = "-20009"
        for item, q in ls if code is None else ():
            if (branch, item) not in stock:
                code = "-20002"
            elif stock[branch, item] < q:
                code = "-20001"
            if code:
                break
        if code is None and voucher and (voucher, member) in used:
            code = "-20044"
        taken = {}
        for item, q in ls if code is None else ():
            if q <= 0:
                code = "-20014"
            elif item in taken:
                code = "-20013" if stock[branch, item] - taken[item] < q else "-1"
            if code:
                break
            taken[item] = q
        if code is None:
            for item, q in taken.items():
                stock[branch, item] -= q
            if voucher:
                used.add((voucher, member))
        out[req] = code
    return out, stock


def test_random_batches_equal_the_loop(spark):
    rng = random.Random(17)
    t = base(spark)
    n = 12
    t["branch"] = spark.createDataFrame([(1, "a"), (2, "b")], "branch_id long, branch_name string")
    t["member"] = spark.createDataFrame([(i, dt.date(2030, 1, 1)) for i in range(4)], "member_id long, expiry_date date")
    stock = {(b, i): rng.randrange(3, 25) for b in (1, 2) for i in range(n) if rng.random() < 0.9}
    t["item"] = spark.createDataFrame([(i, str(i), D("1.00"), "c") for i in range(n)], "item_id long, item_name string, unit_price decimal(8,2), category string")
    t["branch_stock"] = spark.createDataFrame([(b, i, q, None) for (b, i), q in stock.items()],
                                              "branch_id long, item_id long, stock_quantity int, last_restock_date date")
    heads, lines = [], []
    for r in range(120):
        heads.append((r, NOW + dt.timedelta(minutes=rng.randrange(60)), rng.choice([None, 0, 1, 2, 3]), 9001, rng.choice([1, 2]), "In Store",
                      rng.choice([None, None, "V9001"]), None))
        for k in range(rng.randrange(4)):
            lines.append((r, k, rng.randrange(n), rng.choice([1, 1, 2, 3, 5, 0])))
    want, left = placement_loop(dict(stock), heads, lines)
    codes, got = place(spark, t, heads, lines)
    assert codes == want and got == left
    assert {"-20044", "-20001", "-1", "-20014", None} <= set(want.values())


def test_a_cluster_must_name_its_shared_folder():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        applicationId, master = "app-1", "spark://host:7077"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        checkpoint_dir(Session())

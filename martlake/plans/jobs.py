"""Batch jobs re-aimed from the write procedures.

Each job takes a request DataFrame (many requests, each with ``req_id`` and ``req_ts``)
plus the current snapshot and returns a dict of DataFrames:

* ``decisions``: one row per request -- ``req_id``, ``accepted`` and ``code`` (the
  reference's error number as text, or ``NOT_FOUND`` for its uncaught lookups; NULL when
  accepted). When several checks fail, the first in the procedure's order is reported.
* ``snapshot`` (where state changes): the new table, never mutated in place.
* job-specific outputs (created rows, points rows, ...).

Requests are applied in (req_ts, req_id) order wherever order matters.
"""

from __future__ import annotations

import datetime as _dt

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlake.functions.dates import add_months_oracle, ic_birth_date, lit_date
from martlake.session import checkpoint_dir


def _first(*checks) -> Column:
    out = None
    for cond, code in checks:
        out = F.when(cond, F.lit(str(code))) if out is None else out.when(cond, F.lit(str(code)))
    return out


def _decisions(df: DataFrame, code: Column = None) -> DataFrame:
    c = F.col("code") if code is None else code
    return df.select("req_id", c.isNull().alias("accepted"), c.cast("string").alias("code"))


def _materialize(df: DataFrame) -> DataFrame:
    """Write an intermediate once (reliable checkpoint in the shared folder); later branches
    of the job read it instead of re-deriving it, and its lineage is cut."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _exists(df: DataFrame, col: str, alias: str) -> DataFrame:
    return df.select(F.col(col), F.lit(True).alias(alias)).dropDuplicates([col])


# ------------------------------------------------------------------ W01 register members

def register_members(t, requests: DataFrame, as_of: _dt.date) -> dict:
    """Requests (req_id, req_ts, name, ic, email, date_of_birth, address).

    Checks in order: birth date in the future (-20003); IC already registered (-20001);
    email already registered, NULL allowed (-20002); then the member row's rules: IC not a
    date (-20011) or not the birth date (-20012), younger than 12 years (-20032). Accepted
    members get 0 points and expiry ``as_of`` + 12 months.

    Only a registered request claims its IC and email, so inside the batch a request is
    accepted iff no earlier accepted one shares either. Requests that share neither with
    anyone are settled at once; of the others each round accepts those that are first in
    both their groups and settles whoever collides with them, until none is left.
    """
    m = t["member"]
    if "ic" not in m.columns:  # a member table without IC numbers knows none
        m = m.withColumn("ic", F.lit(None).cast("string"))
    known_ic = _exists(m.filter(F.col("ic").isNotNull()), "ic", "_ic")
    known_em = _exists(m.filter(F.col("email").isNotNull()), "email", "_em")
    dob, today = F.col("date_of_birth"), lit_date(as_of)
    ic_date = ic_birth_date(F.col("ic"))
    r = requests.join(known_ic, "ic", "left").join(known_em, "email", "left")
    r = r.withColumn("code", _first((dob > today, -20003), (F.col("_ic").isNotNull(), -20001), (F.col("_em").isNotNull(), -20002)))
    r = r.withColumn("_row", _first((F.col("ic").isNotNull() & ic_date.isNull(), -20011), (ic_date != dob, -20012),
                                    (F.months_between(today, dob) / 12 < 12, -20032)))
    r = _materialize(r.drop("_ic", "_em"))
    # rows that a rule keeps out claim nothing; they are judged against the registered ones
    slim = r.filter(F.col("code").isNull() & F.col("_row").isNull()) \
        .select("req_id", "ic", "email", F.struct("req_ts", "req_id").alias("_o"))

    def firsts(u: DataFrame, key: str) -> DataFrame:
        return u.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min("_o").alias(f"_first_{key}"))

    taken, left = None, slim
    while True:
        u = left.join(firsts(left, "ic"), "ic", "left").join(firsts(left, "email"), "email", "left")
        leads = lambda k: F.col(f"_first_{k}").isNull() | (F.col(f"_first_{k}") == F.col("_o"))
        u = _materialize(u.withColumn("_in", leads("ic") & leads("email")).select("req_id", "ic", "email", "_o", "_in"))
        won = u.filter("_in").select("req_id", "ic", "email", "_o")
        taken = won if taken is None else taken.unionByName(won)
        rest = u.filter("NOT _in").drop("_in")
        for k in ("ic", "email"):
            rest = rest.join(won.select(k), k, "left_anti")
        left = _materialize(rest)
        if left.isEmpty():
            break
    order = F.struct("req_ts", "req_id")
    judged = r.filter(F.col("code").isNull()).join(taken.select("req_id", F.lit(True).alias("_in")), "req_id", "left") \
        .join(taken.select("ic", F.col("_o").alias("_by_ic")), "ic", "left") \
        .join(taken.select("email", F.col("_o").alias("_by_em")), "email", "left")
    judged = judged.withColumn("code", F.when(F.col("_in").isNull(), F.coalesce(
        _first((F.col("_by_ic") < order, -20001), (F.col("_by_em") < order, -20002)), F.col("_row"))))
    dec = r.filter(F.col("code").isNotNull()).select("req_id", "code").unionByName(judged.select("req_id", "code"))
    acc = judged.filter("_in")
    expiry = add_months_oracle(as_of, 12)
    new_members = acc.select(
        F.col("req_id").alias("member_id"), "name", "ic", "email", "address", "date_of_birth",
        F.lit(expiry).alias("expiry_date"), F.lit(0).cast("bigint").alias("points_balance"))
    return {"decisions": _decisions(dec), "new_members": new_members}


# ------------------------------------------------------------------ W02 update item prices

def latest_cost(t) -> DataFrame:
    return (t["procurement"].groupBy("item_id")
            .agg(F.max_by("unit_cost", F.struct("procurement_date", "procurement_id")).alias("latest_cost")))


def update_item_prices(t, requests: DataFrame) -> dict:
    """Requests (req_id, req_ts, item_id, new_price).

    Unknown item (-20012); negative (-20010); below the latest procurement cost (-20011;
    items never procured pass). The last accepted request per item sets the new price.
    """
    items = t["item"].select("item_id", F.lit(True).alias("_i"))
    r = requests.join(items, "item_id", "left").join(latest_cost(t), "item_id", "left")
    r = r.withColumn("code", _first((F.col("_i").isNull(), -20012), (F.col("new_price") < 0, -20010),
                                    (F.col("latest_cost").isNotNull() & (F.col("new_price") < F.col("latest_cost")), -20011)))
    acc = r.filter(F.col("code").isNull())
    last = acc.groupBy("item_id").agg(F.max_by("new_price", F.struct("req_ts", "req_id")).alias("_new"))
    snap = (t["item"].join(last, "item_id", "left")
            .withColumn("unit_price", F.coalesce(F.col("_new"), F.col("unit_price")).cast("decimal(8,2)")).drop("_new"))
    return {"decisions": _decisions(r), "snapshot": snap}


# ------------------------------------------------------------------ W03 transfer stock

_TRANSFER_OUT = T.StructType([
    T.StructField("rec", T.StringType()), T.StructField("req_id", T.LongType()), T.StructField("code", T.StringType()),
    T.StructField("item_id", T.LongType()), T.StructField("branch_id", T.LongType()),
    T.StructField("stock_quantity", T.LongType()), T.StructField("received", T.BooleanType())])


def _transfer_fold(batches):
    """Per item, in order: opening rows (kind 0) then requests (kind 1). State: stock per branch.

    Streams Arrow batches; keeps only the current item's branch stock in memory.
    """
    cur = None
    stock: dict = {}
    received: set = set()
    touched: set = set()

    def flush(item):
        for b in sorted(touched):
            yield ("S", None, None, item, b, stock[b], b in received)

    for pdf in batches:
        out = []
        for row in pdf.itertuples(index=False):
            if row.item_id != cur:
                if cur is not None:
                    out.extend(flush(cur))
                cur, stock, received, touched = row.item_id, {}, set(), set()
            if row.kind == 0:
                stock[row.from_branch] = int(row.quantity)
                continue
            q = int(row.quantity)
            src, dst = row.from_branch, row.to_branch
            if src not in stock:
                out.append(("D", row.req_id, "-20012", cur, None, None, None))
            elif stock[src] < q:
                out.append(("D", row.req_id, "-20013", cur, None, None, None))
            else:
                stock[src] -= q
                stock[dst] = stock.get(dst, 0) + q
                received.add(dst)
                touched.update((src, dst))
                out.append(("D", row.req_id, None, cur, None, None, None))
        if out:
            yield pd.DataFrame(out, columns=[f.name for f in _TRANSFER_OUT.fields])
    if cur is not None:
        rest = list(flush(cur))
        if rest:
            yield pd.DataFrame(rest, columns=[f.name for f in _TRANSFER_OUT.fields])


def transfer_stock(t, requests: DataFrame, as_of: _dt.date) -> dict:
    """Requests (req_id, req_ts, from_branch, to_branch, item_id, quantity).

    Same branch (-20010); quantity <= 0 (-20011); unknown item or branch (NOT_FOUND); item
    not stocked at the source (-20012); insufficient stock (-20013). The destination's restock
    date becomes ``as_of``; its row is created when absent.

    Transfers of one item depend on each other (a transfer in can create or refill the
    source of a later one), so the order-dependent part runs per item. Fast path: an item
    whose every source row exists at the start and whose total out of each source never
    exceeds that source's opening stock cannot reject; its transfers are applied set-wise.
    Only the other items stream through an ordered fold partitioned by item.
    """
    bs = t["branch_stock"]
    br = t["branch"].select("branch_id")
    r = (requests
         .join(_exists(t["item"], "item_id", "_i"), "item_id", "left")
         .join(_exists(br, "branch_id", "_f").withColumnRenamed("branch_id", "from_branch"), "from_branch", "left")
         .join(_exists(br, "branch_id", "_t").withColumnRenamed("branch_id", "to_branch"), "to_branch", "left"))
    r = r.withColumn("code", _first((F.col("from_branch") == F.col("to_branch"), -20010),
                                    (F.col("quantity") <= 0, -20011),
                                    (F.col("_i").isNull() | F.col("_f").isNull() | F.col("_t").isNull(), "NOT_FOUND")))
    static_bad = r.filter(F.col("code").isNotNull()).select("req_id", "code")
    ok = r.filter(F.col("code").isNull()).select("req_id", "req_ts", "from_branch", "to_branch", "item_id", "quantity")

    src_open = bs.select(F.col("branch_id").alias("from_branch"), "item_id", F.col("stock_quantity").alias("_open"))
    demand = ok.groupBy("item_id", "from_branch").agg(F.sum("quantity").alias("_out")).join(src_open, ["item_id", "from_branch"], "left")
    contended = (demand.filter(F.col("_open").isNull() | (F.col("_out") > F.col("_open")))
                 .select("item_id").distinct())
    easy = ok.join(contended, "item_id", "left_anti")
    hard = ok.join(contended, "item_id", "left_semi")

    # fast path: all accepted; deltas per (branch, item)
    easy_delta = (easy.select(F.col("from_branch").alias("branch_id"), "item_id", (-F.col("quantity")).alias("d"), F.lit(False).alias("r"))
                  .unionByName(easy.select(F.col("to_branch").alias("branch_id"), "item_id", F.col("quantity").alias("d"), F.lit(True).alias("r")))
                  .groupBy("branch_id", "item_id").agg(F.sum("d").cast("bigint").alias("_d"), F.max("r").alias("_r")))

    # contended items: ordered fold
    opening_rows = (bs.join(contended, "item_id", "left_semi")
                    .select(F.lit(0).alias("kind"), F.lit(None).cast("long").alias("req_id"),
                            F.lit(None).cast("timestamp_ntz").alias("req_ts"), "item_id",
                            F.col("branch_id").alias("from_branch"), F.lit(None).cast("long").alias("to_branch"),
                            F.col("stock_quantity").cast("long").alias("quantity")))
    req_rows = hard.select(F.lit(1).alias("kind"), "req_id", F.col("req_ts").cast("timestamp_ntz").alias("req_ts"),
                           F.col("item_id").cast("long"), F.col("from_branch").cast("long"),
                           F.col("to_branch").cast("long"), F.col("quantity").cast("long"))
    stream = (opening_rows.withColumn("item_id", F.col("item_id").cast("long"))
              .withColumn("from_branch", F.col("from_branch").cast("long"))
              .unionByName(req_rows)
              # Shuffle on a derived key: both union inputs are already hash-partitioned on
              # item_id, and the planner would then keep their partitions as they are, which
              # a union concatenates instead of aligning -- an item's rows would be split.
              .repartition(F.xxhash64("item_id"))
              .sortWithinPartitions("item_id", "kind", "req_ts", "req_id"))
    folded = stream.mapInPandas(_transfer_fold, _TRANSFER_OUT)

    dec = (static_bad.unionByName(easy.select("req_id", F.lit(None).cast("string").alias("code")))
           .unionByName(folded.filter(F.col("rec") == "D").select("req_id", "code")))
    hard_stock = folded.filter(F.col("rec") == "S").select("branch_id", "item_id", "stock_quantity", "received")

    base = bs.select("branch_id", "item_id", F.col("stock_quantity").cast("bigint").alias("stock_quantity"),
                     "last_restock_date")
    # an item is decided set-wise or by the fold, never by both
    moved = easy_delta.join(hard_stock.select("branch_id", "item_id", F.col("stock_quantity").alias("_h"), F.col("received").alias("_hr")),
                            ["branch_id", "item_id"], "full_outer")
    snap = base.join(moved, ["branch_id", "item_id"], "full_outer").select(
        "branch_id", "item_id",
        F.coalesce(F.col("_h"), F.coalesce(F.col("stock_quantity"), F.lit(0)) + F.coalesce(F.col("_d"), F.lit(0)))
         .cast("bigint").alias("stock_quantity"),
        F.when(F.coalesce("_hr", "_r", F.lit(False)), lit_date(as_of)).otherwise(F.col("last_restock_date")).alias("last_restock_date"))
    return {"decisions": _decisions(dec), "snapshot": snap}


# ------------------------------------------------------------------ W04 receive procurements

def receive_procurements(t, requests: DataFrame, as_of: _dt.date) -> dict:
    """Requests (req_id, req_ts, branch_id, item_id, supplier_id, quantity, unit_cost).

    Quantity <= 0 (-20020); cost < 0 (-20021); unknown item, supplier or branch (NOT_FOUND).
    Receipts never conflict, so accepted quantities are summed per (branch, item) and
    merged into the stock snapshot with a full outer join: stock += quantity, restock date
    = ``as_of``, row created when absent. Accepted requests also become procurement rows.
    """
    r = (requests.join(_exists(t["item"], "item_id", "_i"), "item_id", "left")
         .join(_exists(t["supplier"], "supplier_id", "_s"), "supplier_id", "left")
         .join(_exists(t["branch"], "branch_id", "_b"), "branch_id", "left"))
    r = r.withColumn("code", _first((F.col("quantity") <= 0, -20020), (F.col("unit_cost") < 0, -20021),
                                    (F.col("_i").isNull() | F.col("_s").isNull() | F.col("_b").isNull(), "NOT_FOUND")))
    acc = r.filter(F.col("code").isNull())
    delta = acc.groupBy("branch_id", "item_id").agg(F.sum("quantity").cast("bigint").alias("_d"))
    bs = t["branch_stock"]
    j = bs.join(delta, ["branch_id", "item_id"], "full_outer")
    snap = j.select("branch_id", "item_id",
                    (F.coalesce(F.col("stock_quantity").cast("bigint"), F.lit(0)) + F.coalesce("_d", F.lit(0)))
                    .cast("bigint").alias("stock_quantity"),
                    F.when(F.col("_d").isNotNull(), lit_date(as_of)).otherwise(F.col("last_restock_date"))
                    .alias("last_restock_date"))
    new_proc = acc.select(F.col("req_id").alias("procurement_id"), "item_id", "supplier_id", "branch_id",
                          "quantity", "unit_cost", lit_date(as_of).alias("procurement_date"))
    return {"decisions": _decisions(r), "snapshot": snap, "procurements": new_proc}


# ------------------------------------------------------------------ W05 delivery updates

DELIVERY_STATUSES = ("Delivered", "Out for Delivery", "Pending", "Preparing", "Cancelled")


def apply_delivery_updates(t, requests: DataFrame) -> dict:
    """Requests (req_id, req_ts, action 'create'|'update', delivery_id, order_id,
    company_id, address, status).

    Bad status (-20050; NULL passes, as in the reference's NOT IN). The address is stored trimmed. Create: order missing (-20053); order already has a delivery
    (-20054, also an earlier accepted create in the batch); company missing (-20055);
    empty or NULL address (-20056). Update: delivery not found (-20052); already
    Delivered (-20051, terminal). Delivery date is set to req_ts on Delivered, cleared on
    Cancelled, else kept.

    Per delivery the only order-dependent check is "already Delivered": an update is
    rejected iff an earlier accepted state of the delivery is Delivered. Statuses other
    than Delivered never block, so the first Delivered in the sequence (from the opening
    row or an accepted request) blocks every later update -- a running "seen Delivered"
    flag per delivery, computed with a window over that delivery's requests.
    """
    d = t["delivery"]
    for c, typ in (("delivery_address", "string"), ("delivery_date", "timestamp_ntz")):
        if c not in d.columns:
            d = d.withColumn(c, F.lit(None).cast(typ))
    st_bad = F.coalesce(~F.col("status").isin(*DELIVERY_STATUSES), F.lit(False))  # NOT IN lets NULL pass
    creates = requests.filter(F.col("action") == "create")
    updates = requests.filter(F.col("action") != "create")
    order = [F.col("req_ts"), F.col("req_id")]

    c = (creates.join(_exists(t["orders"], "order_id", "_o"), "order_id", "left")
         .join(_exists(d, "order_id", "_has"), "order_id", "left")
         .join(_exists(t["delivery_company"], "company_id", "_c"), "company_id", "left"))
    c = c.withColumn("code", _first((st_bad, -20050), (F.col("_o").isNull(), -20053),
                                    (F.col("_has").isNotNull(), -20054), (F.col("_c").isNull(), -20055),
                                    (F.coalesce(F.trim("address"), F.lit("")) == "", -20056)))
    c_ok = c.filter(F.col("code").isNull()).withColumn(
        "_n", F.row_number().over(Window.partitionBy("order_id").orderBy(*order)))
    c_ok = c_ok.withColumn("code", F.when(F.col("_n") > 1, F.lit("-20054")))
    created = c_ok.filter(F.col("code").isNull()).select(
        "delivery_id", "order_id", "company_id", F.trim("address").alias("delivery_address"),
        F.when(F.col("status") == "Delivered", F.col("req_ts")).alias("delivery_date"),
        F.col("status").alias("delivery_status"), F.col("req_ts").alias("_created_ts"), F.col("req_id").alias("_created_id"))

    known = (d.select("delivery_id", "delivery_status", "delivery_date", F.lit(None).cast("timestamp_ntz").alias("_cts"),
                      F.lit(None).cast("long").alias("_cid"))
             .unionByName(created.select("delivery_id", "delivery_status", "delivery_date",
                                         F.col("_created_ts").alias("_cts"), F.col("_created_id").alias("_cid"))))
    u = updates.join(known.select("delivery_id", F.col("delivery_status").alias("_s0"), "_cts", "_cid",
                                       F.lit(True).alias("_known")), "delivery_id", "left")
    # an update before the delivery's creation in the batch does not find it
    not_yet = F.col("_cts").isNotNull() & (F.struct(F.col("req_ts"), F.col("req_id")) < F.struct(F.col("_cts"), F.col("_cid")))
    u = u.withColumn("code", _first((st_bad, -20050),
                                    (F.col("_known").isNull() | not_yet, -20052)))
    u_ok = u.filter(F.col("code").isNull())
    w = Window.partitionBy("delivery_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    u_ok = u_ok.withColumn("_seen", F.coalesce(F.max((F.col("status") == "Delivered").cast("int")).over(w), F.lit(0)))
    u_ok = u_ok.withColumn("code", F.when(F.coalesce(F.col("_s0") == "Delivered", F.lit(False)) | (F.col("_seen") == 1), F.lit("-20051")))
    dec = (c.filter(F.col("code").isNotNull()).select("req_id", "code")
           .unionByName(c_ok.select("req_id", "code"))
           .unionByName(u.filter(F.col("code").isNotNull()).select("req_id", "code"))
           .unionByName(u_ok.select("req_id", "code")))
    acc_u = u_ok.filter(F.col("code").isNull())
    last = acc_u.groupBy("delivery_id").agg(F.max_by(F.struct("status", "req_ts"), F.struct("req_ts", "req_id")).alias("_l"))
    base = d.select("delivery_id", "order_id", "company_id", "delivery_address", "delivery_date", "delivery_status") \
            .unionByName(created.drop("_created_ts", "_created_id"))
    snap = base.join(last, "delivery_id", "left").select(
        "delivery_id", "order_id", "company_id", "delivery_address",
        F.when(F.col("_l").isNull(), F.col("delivery_date"))
         .when(F.col("_l.status") == "Delivered", F.col("_l.req_ts"))
         .when(F.col("_l.status") == "Cancelled", F.lit(None).cast("timestamp_ntz"))
         .otherwise(F.col("delivery_date")).alias("delivery_date"),
        F.when(F.col("_l").isNull(), F.col("delivery_status")).otherwise(F.col("_l.status")).alias("delivery_status"))
    return {"decisions": _decisions(dec), "snapshot": snap}


# ------------------------------------------------------------------ W06 redeem vouchers

def redeem_vouchers(t, requests: DataFrame, as_of) -> dict:
    """Requests (req_id, req_ts, voucher_id, order_id, member_id).

    Voucher missing (-20043); expired before ``as_of`` (-20040); member missing (-20041);
    order missing (-20043); order of another member (-20042; guest orders pass); member
    already redeemed the voucher (-20044). History is matched on the order's member, so
    redemptions on guest orders never count. Then the insert's own rules: the voucher already
    redeemed on the order (-20031), the order dated after the voucher's expiry (-20032).

    Inside the batch the first request per (voucher, order owner), on guest orders per
    (voucher, order), that no rule rejects wins; those after it get -20044 or -20031.
    """
    v = t["voucher"].select("voucher_id", "exp_date", F.lit(True).alias("_v"))
    o = t["orders"].select("order_id", F.col("member_id").alias("_owner"), "order_date", F.lit(True).alias("_o"))
    hist = (t["redemption"].join(t["orders"].select("order_id", "member_id"), "order_id")
            .filter(F.col("member_id").isNotNull()).select("voucher_id", "member_id").distinct()
            .withColumn("_used", F.lit(True)))
    on_order = t["redemption"].select("voucher_id", "order_id").distinct().withColumn("_again", F.lit(True))
    r = (requests.join(v, "voucher_id", "left")
         .join(_exists(t["member"], "member_id", "_m"), "member_id", "left")
         .join(o, "order_id", "left")
         .join(hist, ["voucher_id", "member_id"], "left")
         .join(on_order, ["voucher_id", "order_id"], "left"))
    r = r.withColumn("code", _first((F.col("_v").isNull(), -20043), (F.col("exp_date") < lit_date(as_of), -20040),
                                    (F.col("_m").isNull(), -20041), (F.col("_o").isNull(), -20043),
                                    (F.col("_owner").isNotNull() & (F.col("_owner") != F.col("member_id")), -20042),
                                    (F.col("_used").isNotNull(), -20044), (F.col("_again").isNotNull(), -20031)))
    r = r.withColumn("_late", F.coalesce(F.col("order_date") > F.col("exp_date").cast("timestamp_ntz"), F.lit(False)))
    # the first request of a group that the insert takes; a group is a member's or an order's
    # requests for one voucher, so it is small
    ok = r.filter(F.col("code").isNull()).withColumn("_place", F.when(F.col("_owner").isNull(), F.col("order_id")))
    at = F.struct("req_ts", "req_id")
    w = Window.partitionBy("voucher_id", "_owner", "_place")
    ok = ok.withColumn("_won", F.min(F.when(~F.col("_late"), at)).over(w)).withColumn("code", F.when(
        F.col("_won") < at, F.when(F.col("_owner").isNull(), F.lit("-20031")).otherwise(F.lit("-20044")))
        .when(F.col("_late"), F.lit("-20032")))
    dec = r.filter(F.col("code").isNotNull()).select("req_id", "code").unionByName(ok.select("req_id", "code"))
    new_red = ok.filter(F.col("code").isNull()).select(F.col("req_id").alias("redemption_id"), "voucher_id", "order_id",
                                                       F.col("req_ts").alias("redeemed_date"))
    return {"decisions": _decisions(dec), "redemptions": new_red}


# ------------------------------------------------------------------ W07 price order lines

def price_order_lines(t, lines: DataFrame) -> dict:
    """Lines (order_id, item_id, quantity, priced_at timestamp).

    Unknown item (-20003). Price = item price less the discount of the latest-starting
    promotion covering ``priced_at`` (start <= priced_at <= end, compared as timestamps;
    ties: higher promotion id); Percentage: price*(100-p)/100, Amount: price-v; floor 0;
    rounded to cents. The promotion's status is not consulted (as in the reference).
    """
    it = t["item"].select("item_id", F.col("unit_price").alias("_price"))
    p = t["promotion"].select("promotion_id", F.col("start_date").cast("timestamp_ntz").alias("_s"),
                              F.col("end_date").cast("timestamp_ntz").alias("_e"))
    promo = t["promotion_details"].join(p, "promotion_id")
    li = lines.join(it, "item_id", "left")
    cand = (li.join(promo, "item_id")
              .filter((F.col("_s") <= F.col("priced_at")) & (F.col("priced_at") <= F.col("_e")))
              .groupBy("order_id", "item_id")
              .agg(F.max_by(F.struct("discount_type", "discount_value"), F.struct("_s", "promotion_id")).alias("_best")))
    j = li.join(cand, ["order_id", "item_id"], "left")
    price = F.col("_price")
    disc = (F.when(F.col("_best.discount_type") == "Percentage",
                   price * (F.lit(100) - F.col("_best.discount_value")) * F.lit(0.01).cast("decimal(3,2)"))
             .when(F.col("_best.discount_type") == "Amount", price - F.col("_best.discount_value"))
             .otherwise(price))
    final = F.round(F.greatest(disc, F.lit(0)), 2).cast("decimal(8,2)")
    j = j.withColumn("code", _first((F.col("_price").isNull(), -20003)))
    priced = j.filter(F.col("code").isNull()).select("order_id", "item_id", "quantity", final.alias("unit_price"))
    return {"decisions": j.select("order_id", "item_id", F.col("code").isNull().alias("accepted"), "code"),
            "lines": priced}


# ------------------------------------------------------------------ W08 award points

def award_points(t, lines: DataFrame, orders: DataFrame, voucher_orders: DataFrame) -> DataFrame:
    """Earned points rows for orders without a voucher, with a member and a positive
    total: TRUNC(sum of quantity x price). A total below 1 would give 0 points, which the
    amount check forbids, so no row is written for it; nor for a member whose membership
    ended before the order's day (-20033 of the insert)."""
    tot = lines.groupBy("order_id").agg(F.sum(F.col("quantity") * F.col("unit_price")).alias("_t"))
    o = orders.filter(F.col("member_id").isNotNull()).join(voucher_orders.select("order_id"), "order_id", "left_anti")
    if "member" in t.available() if hasattr(t, "available") else "member" in t:
        ended = t["member"].filter(F.col("expiry_date").isNotNull()).select("member_id", "expiry_date")
        o = o.join(ended, "member_id", "left").filter(F.col("expiry_date").isNull() | (F.col("expiry_date") >= F.to_date("order_date")))
    j = o.join(tot, "order_id").filter(F.col("_t") > 0)
    pts = F.floor(F.col("_t")).cast("bigint")
    return (j.filter(pts > 0)
             .select("order_id", "member_id", pts.alias("amount"), F.lit("Earned").alias("transaction_type"),
                     F.col("order_date").alias("redemption_date")))


def award_points_history(t) -> DataFrame:
    """W08 over the stored orders: points each historical order earns (no redemption row)."""
    return award_points(t, t["order_item"], t["orders"].select("order_id", "member_id", "order_date"),
                        t["redemption"].select("order_id"))


def reprice_order_lines(t) -> DataFrame:
    """W07 over the stored order lines: the promotional price at the order's own time."""
    lines = t["order_item"].join(t["orders"].select("order_id", F.col("order_date").alias("priced_at")), "order_id")
    return price_order_lines(t, lines.select("order_id", "item_id", "quantity", "priced_at"))["lines"]


# ------------------------------------------------------------------ W09 create promotions

def create_promotions(t, requests: DataFrame, lines: DataFrame | None = None) -> dict:
    """Requests (req_id, req_ts, promotion_id, name, description, start_date, end_date,
    details array<struct<item_id, discount_type, discount_value>>) -- or, with ``lines``,
    the details already exploded as (req_id, pos, item_id, discount_type, discount_value).

    A promotion is rejected whole on the first failing check: empty name (-20001); missing
    dates (-20002); end before start (-20003); no details (-20004); unknown item (-20005);
    bad discount type (-20006, NULL passes); negative value or percentage above 100 (-20007);
    an Amount above the item's price (-20020, the detail row's trigger); an item twice (-20008). Details are one row per line and checked set-wise; the promotion takes
    the code of its first failing line.
    """
    if lines is None:
        lines = (requests.select("req_id", F.posexplode_outer("details").alias("_pos", "d"))
                 .select("req_id", "_pos", F.col("d.item_id").alias("item_id"),
                         F.col("d.discount_type").alias("discount_type"), F.col("d.discount_value").alias("discount_value"))
                 .filter(F.col("_pos").isNotNull()))
        hdr = requests
        n_lines = F.coalesce(F.size("details"), F.lit(0))
    else:
        lines = lines.select("req_id", F.col("pos").alias("_pos"), "item_id", "discount_type", "discount_value")
        hdr = requests.join(lines.groupBy("req_id").agg(F.count(F.lit(1)).alias("_nd")), "req_id", "left")
        n_lines = F.coalesce(F.col("_nd"), F.lit(0))
    hdr = hdr.withColumn(
        "_h", _first((F.coalesce("name", F.lit("")) == "", -20001),  # the reference's empty string is its NULL; blanks pass
                     (F.col("start_date").isNull() | F.col("end_date").isNull(), -20002),
                     (F.col("end_date") < F.col("start_date"), -20003),
                     (n_lines <= 0, -20004)))
    lines = lines.join(t["item"].select("item_id", "unit_price", F.lit(True).alias("_i")), "item_id", "left")
    w = Window.partitionBy("req_id", "item_id").orderBy("_pos")
    lines = lines.withColumn("_dup", F.row_number().over(w) > 1)
    lines = lines.withColumn("_c", _first(
        (F.col("_i").isNull(), -20005), (~F.col("discount_type").isin("Percentage", "Amount"), -20006),
        ((F.col("discount_value") < 0) | ((F.col("discount_type") == "Percentage") & (F.col("discount_value") > 100)), -20007),
        ((F.col("discount_type") == "Amount") & (F.col("discount_value") > F.col("unit_price")), -20020), (F.col("_dup"), -20008)))
    # the first failing line (in detail order) decides the promotion's code
    line_code = lines.filter(F.col("_c").isNotNull()).groupBy("req_id").agg(F.min_by("_c", "_pos").alias("_lc"))
    j = hdr.join(line_code, "req_id", "left").withColumn("code", F.coalesce(F.col("_h"), F.col("_lc")))
    acc = j.filter(F.col("code").isNull())
    headers = acc.select("promotion_id", F.col("name").alias("promotion_name"), "description",
                         F.lit("Active").alias("status"), "start_date", "end_date")
    details = (lines.join(acc.select("req_id", "promotion_id"), "req_id")
               .select("promotion_id", "item_id", "discount_type", "discount_value"))
    return {"decisions": _decisions(j), "promotions": headers, "promotion_details": details}


# ------------------------------------------------------------------ W10 pickup updates

PICKUP_STATUSES = ("Preparing", "Ready", "Completed", "Expired", "Rescheduled")


def apply_pickup_updates(t, requests: DataFrame) -> dict:
    """Requests (req_id, req_ts, order_id, new_status[, reschedule_date]).

    NULL order: ignored (code IGNORED, nothing changes). Bad status (-20638; Cancelled is
    not accepted here, NULL passes and becomes the status); order missing (-20641); not a Self Pickup order (-20639); no pickup
    row (-20641). Completed after the pickup's expiry sets status Expired and is rejected
    (-20640). Ready sets expiry to req_ts + 3 days; Rescheduled to the given date or
    req_ts + 3 days; Completed stamps pickup_datetime = req_ts. A given date before req_ts is
    rejected and changes nothing (-20003, the row's expiry rule).

    The one state-dependent check needs the expiry in force at the request: the expiry set
    by the latest earlier Ready / Rescheduled request of the order (those are never
    rejected once statically valid), else the stored one. That is a last-non-null window
    per order, so no sequential fold is needed.
    """
    sp = t["self_pickup"]
    for c in ("pickup_exp_date", "pickup_datetime"):
        if c not in sp.columns:
            sp = sp.withColumn(c, F.lit(None).cast("timestamp_ntz"))
    if "reschedule_date" not in requests.columns:
        requests = requests.withColumn("reschedule_date", F.lit(None).cast("timestamp_ntz"))
    o = t["orders"].select("order_id", "order_type")
    r = (requests.join(o, "order_id", "left")
         .join(sp.select("order_id", F.col("pickup_exp_date").alias("_exp0"), F.lit(True).alias("_p")), "order_id", "left"))
    r = r.withColumn("code", _first((F.col("order_id").isNull(), "IGNORED"),
                                    (~F.col("new_status").isin(*PICKUP_STATUSES), -20638),
                                    (F.col("order_type").isNull(), -20641),
                                    (F.lower("order_type") != "self pickup", -20639),
                                    (F.col("_p").isNull(), -20641),
                                    ((F.col("new_status") == "Rescheduled") & (F.col("reschedule_date") < F.col("req_ts")), -20003)))
    ok = r.filter(F.col("code").isNull())
    three = F.expr("INTERVAL 3 DAYS")
    sets = (F.when(F.col("new_status") == "Ready", F.col("req_ts") + three)
             .when(F.col("new_status") == "Rescheduled", F.coalesce(F.col("reschedule_date"), F.col("req_ts") + three)))
    ok = ok.withColumn("_set", sets)
    w = Window.partitionBy("order_id").orderBy("req_ts", "req_id").rowsBetween(Window.unboundedPreceding, -1)
    ok = ok.withColumn("_exp", F.coalesce(F.last("_set", ignorenulls=True).over(w), F.col("_exp0")))
    ok = ok.withColumn("code", F.when((F.col("new_status") == "Completed") & F.col("_exp").isNotNull()
                                      & (F.col("req_ts") > F.col("_exp")), F.lit("-20640")))
    dec = r.filter(F.col("code").isNotNull()).select("req_id", "code").unionByName(ok.select("req_id", "code"))
    decisions = dec.select("req_id", F.col("code").isNull().alias("accepted"), "code")
    eff = ok.withColumn("_status", F.when(F.col("code") == "-20640", F.lit("Expired")).otherwise(F.col("new_status")))
    last = eff.groupBy("order_id").agg(
        F.max_by(F.struct("_status"), F.struct("req_ts", "req_id")).alias("_st"),
        F.max_by("_set", F.struct(F.col("_set").isNotNull(), "req_ts", "req_id")).alias("_lastset"),
        F.max(F.when((F.col("new_status") == "Completed") & F.col("code").isNull(), F.col("req_ts"))).alias("_done"))
    snap = sp.join(last, "order_id", "left").select(
        "pickup_id", "order_id",
        F.coalesce("_done", "pickup_datetime").alias("pickup_datetime"),
        F.when(F.col("_st").isNull(), F.col("pickup_status")).otherwise(F.col("_st._status")).alias("pickup_status"),
        F.coalesce("_lastset", "pickup_exp_date").alias("pickup_exp_date"))
    return {"decisions": decisions, "snapshot": snap}

"""W11 place_orders: multi-line orders, all or nothing, as one batch plan.

Requests come as two frames: headers (req_id, req_ts, member_id, staff_id, branch_id,
order_type, voucher_id, address) and lines (req_id, line_no, item_id, quantity) -- the
reference's line array, exploded. The new order id is the request id.

Checks in the reference's order: no lines (-20006); guest with Delivery or Self Pickup
(-20008); guest with a voucher (-20009); per line in line order: item not stocked at the
branch (-20002) or stock short at that moment (-20001); member expired (-20030); Delivery
without address and without a member address (-20010); voucher checks of the redemption
job (-20043, -20040, -20041, -20044); per line again, as it is inserted: quantity NULL or
not positive (-20014), stock short after the order's own earlier lines (-20013), an item
twice (-1, the primary key). A rejected order changes nothing (atomic per order).

Contention is per (branch, item): a pair whose total demand in the batch never exceeds
its opening stock cannot run short, whatever the order. A voucher that several orders of a
member name is contended too: one unit of it, taken by the first accepted order. Orders that
take from contended resources are settled in rounds, set-wise (``settle``): whatever the
undecided orders before it take, an order is accepted if everything left after them suffices,
and rejected if what the accepted ones leave doesn't. A round decides the earliest undecided
order of every resource at least, in practice nearly all of them; what lies before a resource's
first undecided order is settled and leaves the table. No order waits for a branch, and no task
holds one. Codes then follow from the stock that each order met, line by line.

Every step that later ones read is stored with the columns they need and dropped after the last of
them, and a statement deals all lines out once: a job over all stored orders holds no more
than a few times their size on disk.

Outputs: decisions, orders, order_lines (promotional prices at req_ts, W07), deliveries
(status Preparing; courier chosen as pmod(order_id, couriers) over couriers sorted by id
-- the reference picks one at random), pickups (Preparing), redemptions, points (W08),
snapshot (new branch stock) and low_stock_alerts (every accepted line leaving < 20).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlake.functions.ranking import running_sum, running_sums
from martlake.plans import jobs
from martlake.session import drop, stored

LOW_STOCK = 20


def settle(entries: DataFrame) -> tuple[DataFrame, list[int]]:
    """(req_id, accepted) of the requests in ``entries`` (req_id, req_ts, resource, q, opening):
    a request is accepted if each resource it names still holds its q when its turn comes, in
    (req_ts, req_id) order, and then takes all of them; a request names a resource once, q > 0.
    Also the number of entries that each round began with."""
    entries = stored(entries.withColumn("fixed", F.lit(False)))
    at, decided, sizes = F.struct("req_ts", "req_id"), [], []
    while True:
        sizes.append(entries.count())
        before = [entries]  # what this round stores and no later one reads
        taken = F.when(F.col("fixed"), F.col("q")).otherwise(0)
        run = running_sums(entries.withColumns({"_t": taken, "_u": F.col("q") - taken}), [F.col("req_ts"), F.col("req_id")],
                           {"_taken": "_t", "_open": "_u"}, ["resource"], steps=before)
        left = F.col("opening") - F.col("_taken")  # after the accepted requests before this one
        own = run.filter("NOT fixed").groupBy("req_id").agg(
            F.min(left - F.col("_open") >= 0).alias("accepted"), F.max(left < F.col("q")).alias("_short"))
        done = stored(own.filter("accepted OR _short").select("req_id", "accepted"))
        decided.append(done)
        entries = entries.join(done, "req_id", "left").filter(F.coalesce("accepted", F.lit(True))) \
            .withColumn("fixed", F.col("fixed") | F.col("accepted").isNotNull()).drop("accepted")
        first = entries.filter("NOT fixed").groupBy("resource").agg(F.min(at).alias("_first"))
        entries = entries.join(first, "resource").withColumn("_past", F.col("fixed") & (at < F.col("_first")))
        past = entries.filter("_past").groupBy("resource").agg(F.sum("q").alias("_gone"))
        entries = stored(entries.filter("NOT _past").join(past, "resource", "left").withColumn(
            "opening", F.col("opening") - F.coalesce("_gone", F.lit(0))).drop("_first", "_past", "_gone"))
        drop(*before)
        if entries.isEmpty():
            drop(entries)
            break
    out = decided[0]
    for d in decided[1:]:
        out = out.unionByName(d)
    return out, sizes


def explode_lines(requests: DataFrame, col: str = "lines") -> DataFrame:
    """Array-of-lines requests -> (req_id, line_no, item_id, quantity)."""
    return (requests.select("req_id", F.posexplode(col).alias("line_no", "l"))
            .select("req_id", "line_no", F.col("l.item_id").alias("item_id"), F.col("l.quantity").alias("quantity")))


class _Outputs(dict):
    """Job outputs; the optional ones are planned only when asked for."""

    def __init__(self, ready: dict, deferred: dict):
        super().__init__(ready)
        self._deferred = deferred

    def __missing__(self, key):
        if key not in self._deferred:
            raise KeyError(key)
        self[key] = self._deferred.pop(key)()
        return self[key]

    def keys(self):
        return list(super().keys()) + list(self._deferred)

    def __iter__(self):
        return iter(self.keys())


def place_orders(t, headers: DataFrame, lines: DataFrame, as_of) -> dict:
    """Place multi-line orders all or nothing (see the module docstring for the rules
    and outputs)."""
    bs = t["branch_stock"].select("branch_id", "item_id", F.col("stock_quantity").cast("bigint").alias("opening"))
    mem = t["member"].select("member_id", "expiry_date", (F.col("address") if "address" in t["member"].columns
                                          else F.lit(None).cast("string")).alias("_maddr"), F.lit(True).alias("_m"))
    guest = F.col("member_id").isNull()
    h = headers.withColumn("early", jobs._first(
        (guest & F.col("order_type").isin("Delivery", "Self Pickup"), -20008),
        (guest & F.col("voucher_id").isNotNull(), -20009)))

    # what the line inserts would reject whatever the stock: quantity -20014, an item twice -1
    nth = Window.partitionBy("req_id", "item_id").orderBy("line_no")
    bad = F.when(F.col("quantity").isNull() | (F.col("quantity") <= 0), -20014).when(F.row_number().over(nth) > 1, -1)
    asked = stored(lines.select("req_id", "line_no", "item_id", "quantity")
                   .join(h.select("req_id", "branch_id", F.col("early").isNull().alias("live")), "req_id").withColumn("bad", bad))
    # contention per (branch, item) among orders still in play
    demand = asked.filter("live").groupBy("branch_id", "item_id").agg(F.sum(F.greatest("quantity", F.lit(0))).alias("_dem"))
    pairs = stored(demand.join(bs, ["branch_id", "item_id"]).select("branch_id", "item_id", "opening", (F.col("_dem") > F.col("opening")).alias("contended")))
    # line facts, once
    li = stored(asked.join(pairs, ["branch_id", "item_id"], "left").withColumn("contended", F.coalesce("contended", F.lit(False))))
    drop(asked)
    line = lambda which: F.min(F.when(which, F.col("line_no")))
    plain = ~F.col("contended")
    facts = stored(li.groupBy("req_id").agg(
        F.max("contended").alias("_touch"), line(F.col("opening").isNull()).alias("_unst"),
        line(F.col("bad") == -20014).alias("_qty"), line(F.col("bad") == -1).alias("_twice"),
        line(plain & (F.col("bad") == -20014)).alias("_plain_qty"), line(plain & (F.col("bad") == -1)).alias("_plain_twice")))

    # voucher checks of the redemption job (the new order belongs to the requesting member)
    has_v = F.col("voucher_id").isNotNull()
    v = t["voucher"].select("voucher_id", "exp_date", F.lit(True).alias("_v"))
    hist = t["redemption"].join(t["orders"].select("order_id", "member_id").filter(F.col("member_id").isNotNull()), "order_id")
    used = h.filter(has_v).select("req_id", "voucher_id", "member_id").join(hist.select("voucher_id", "member_id"), ["voucher_id", "member_id"], "left_semi") \
        .select("req_id", F.lit(True).alias("_used"))
    h = (h.join(facts.withColumn("_n", F.lit(True)), "req_id", "left").join(used, "req_id", "left")
          .join(mem, "member_id", "left").join(v, "voucher_id", "left"))
    h = h.withColumn("_addr", F.coalesce(F.col("address"), F.col("_maddr")))
    addr_bad = (F.col("order_type") == "Delivery") & F.col("_addr").isNull()
    h = h.withColumn("early", F.when(F.col("_n").isNull(), "-20006").otherwise(F.col("early")))
    h = h.withColumn("late", jobs._first(
        (F.col("expiry_date") < F.to_date("req_ts"), -20030),
        (addr_bad, -20010),
        (has_v & F.col("_v").isNull(), -20043),
        (has_v & (F.col("exp_date") < F.lit(as_of)), -20040),
        (has_v & F.col("_m").isNull(), -20041),
        (has_v & F.col("_used").isNotNull(), -20044)))
    h = stored(h.select("req_id", "req_ts", "member_id", "staff_id", "branch_id", "order_type", "voucher_id", "_addr", "early", "late",
                        F.coalesce("_touch", F.lit(False)).alias("_touch"), "_unst", "_qty", "_twice", "_plain_qty", "_plain_twice"))
    drop(facts)

    open_h = h.filter(F.col("early").isNull())
    order = F.struct("req_ts", "req_id")
    # only an order that no rule of its own rejects can take anything
    clean = open_h.filter("late IS NULL AND coalesce(_unst, _qty, _twice) IS NULL").select("req_id", "req_ts", "voucher_id", "member_id")
    rivals = open_h.filter(F.col("late").isNull() & F.col("voucher_id").isNotNull())
    several = clean.filter(F.col("voucher_id").isNotNull()).groupBy("voucher_id", "member_id").agg(F.count(F.lit(1)).alias("_k")).filter("_k > 1").drop("_k")
    scarce = stored(li.filter("contended").select("req_id", "line_no", "branch_id", "item_id", "quantity", "opening", "bad")
                    .join(open_h.select("req_id", "req_ts"), "req_id"))
    drop(li, pairs)
    stock_entries = scarce.join(clean.select("req_id"), "req_id", "left_semi").select(
        "req_id", "req_ts", F.concat_ws("|", F.lit("stock"), "branch_id", "item_id").alias("resource"), F.col("quantity").cast("long").alias("q"),
        F.col("opening").cast("long").alias("opening"))
    voucher_entries = clean.join(several, ["voucher_id", "member_id"], "left_semi").select(
        "req_id", "req_ts", F.concat_ws("|", F.lit("voucher"), "voucher_id", "member_id").alias("resource"), F.lit(1).cast("long").alias("q"),
        F.lit(1).cast("long").alias("opening"))
    settled, rounds = settle(stock_entries.unionByName(voucher_entries))
    refused = settled.filter("NOT accepted").select("req_id")
    took = clean.select("req_id").join(refused, "req_id", "left_anti")  # the accepted orders

    # codes: the stock that the lines on contended pairs met, and the vouchers already used
    met = scarce.join(took.withColumn("_took", F.lit(True)), "req_id", "left")
    met = met.withColumn("_takes", F.when(F.col("_took"), F.col("quantity").cast("long")).otherwise(0))
    sums: list = []
    met = running_sum(met, [F.col("req_ts"), F.col("req_id"), F.col("line_no")], "_takes", "_gone", partition_by=["branch_id", "item_id"], steps=sums)
    same = Window.partitionBy("req_id", "item_id").orderBy("line_no")
    met = (met.withColumn("_stock", F.col("opening") - F.col("_gone") + F.sum("_takes").over(same))  # before the order's own lines
           .withColumn("_before", F.first("quantity").over(same)))
    short = F.col("_stock") < F.col("quantity")
    again = F.when((F.col("bad") == -1) & (F.col("_stock") - F.col("_before") < F.col("quantity")), -20013).otherwise(F.col("bad"))
    at_line = lambda at, code: F.when(at.isNotNull() & code.isNotNull(), F.struct(at.alias("at"), code.cast("int").alias("code")))
    by_line = met.groupBy("req_id").agg(line(short).alias("_short"), F.min(at_line(F.col("line_no"), again)).alias("_again"))
    used = rivals.join(took, "req_id", "left_semi").groupBy("voucher_id", "member_id").agg(F.min(order).alias("_first"))
    lost = rivals.join(used, ["voucher_id", "member_id"]).filter(order > F.col("_first")).select("req_id", F.lit("-20044").alias("_dupv"))
    judged = open_h.join(lost, "req_id", "left").join(by_line, "req_id", "left")
    # the code of an order's first line that has one, plain or contended
    of = lambda name, code: at_line(F.col(name), F.lit(code))
    first = lambda *codes: F.least(*codes)["code"].cast("string")
    codes = judged.select("req_id", F.coalesce(
        first(of("_unst", -20002), of("_short", -20001)), "late", "_dupv",
        F.when(F.col("_touch"), first(of("_plain_qty", -20014), of("_plain_twice", -1), F.col("_again")))
         .otherwise(first(of("_qty", -20014), of("_twice", -1)))).alias("code"))
    codes = stored(codes.unionByName(h.filter(F.col("early").isNotNull()).select("req_id", F.col("early").alias("code"))))
    drop(scarce, *sums)
    decisions = codes.select("req_id", F.col("code").isNull().alias("accepted"), "code")
    acc = h.join(codes.filter(F.col("code").isNull()).select("req_id"), "req_id", "left_semi")

    orders = acc.select(F.col("req_id").alias("order_id"), "member_id", "staff_id", "branch_id",
                        F.col("req_ts").alias("order_date"), "order_type")
    acc_lines = lines.join(acc.select("req_id", "req_ts", "branch_id"), "req_id")
    priced = jobs.price_order_lines(
        t, acc_lines.select(F.col("req_id").alias("order_id"), "item_id", "quantity", F.col("req_ts").alias("priced_at")))["lines"]
    couriers = t["delivery_company"].select("company_id")
    cw = couriers.withColumn("_idx", F.row_number().over(Window.orderBy("company_id")) - 1)
    n_c = couriers.agg(F.count(F.lit(1))).scalar()  # number of couriers: a scalar subquery
    dl = (acc.filter(F.col("order_type") == "Delivery")
             .withColumn("_idx", F.pmod(F.col("req_id"), n_c)).join(cw, "_idx")
             .select(F.col("req_id").alias("delivery_id"), F.col("req_id").alias("order_id"), "company_id",
                     F.col("_addr").alias("delivery_address"), F.lit(None).cast("timestamp_ntz").alias("delivery_date"),
                     F.lit("Preparing").alias("delivery_status")))
    pk = acc.filter(F.col("order_type") == "Self Pickup").select(
        F.col("req_id").alias("pickup_id"), F.col("req_id").alias("order_id"),
        F.lit(None).cast("timestamp_ntz").alias("pickup_datetime"), F.lit("Preparing").alias("pickup_status"),
        F.lit(None).cast("timestamp_ntz").alias("pickup_exp_date"))
    red = acc.filter(F.col("voucher_id").isNotNull()).select(
        F.col("req_id").alias("redemption_id"), "voucher_id", F.col("req_id").alias("order_id"),
        F.col("req_ts").alias("redeemed_date"))
    points = jobs.award_points(t, priced, orders, red.select("order_id"))

    # stock: opening minus accepted deductions; alerts from the running stock per pair
    ded = acc_lines.select("branch_id", "item_id", "req_ts", "req_id", "line_no", (-F.col("quantity").cast("bigint")).alias("d"))
    moved = ded.groupBy("branch_id", "item_id").agg(F.sum("d").alias("_d"))
    snap = (t["branch_stock"].join(moved, ["branch_id", "item_id"], "left")
            .withColumn("stock_quantity", (F.col("stock_quantity") + F.coalesce("_d", F.lit(0))).cast("bigint")).drop("_d"))

    def alerts() -> DataFrame:
        run = running_sum(ded, [F.col("req_ts"), F.col("req_id"), F.col("line_no")], "d", "_rs",
                          partition_by=["branch_id", "item_id"])
        return (run.join(bs, ["branch_id", "item_id"])
                   .withColumn("stock_after", F.col("opening") + F.col("_rs"))
                   .filter(F.col("stock_after") < LOW_STOCK)
                   .select("branch_id", "item_id", F.col("req_id").alias("order_id"), F.col("req_ts").alias("order_date"),
                           "stock_after"))

    return _Outputs({"decisions": decisions, "orders": orders, "order_lines": priced, "deliveries": dl, "pickups": pk,
                     "redemptions": red, "points": points, "snapshot": snap, "rounds": rounds}, {"low_stock_alerts": alerts})


def replay_orders(t):
    """Requests that re-place every stored order against the opening stock (W11 over the data).

    Headers from ``orders`` (voucher = the order's first redemption, address = none for
    every seventh order, whose member's address is used), lines from ``order_item`` in item order.
    """
    first_red = (t["redemption"].groupBy("order_id")
                 .agg(F.min_by("voucher_id", F.struct("redeemed_date", "redemption_id")).alias("voucher_id")))
    headers = (t["orders"].join(first_red, "order_id", "left")
               .select(F.col("order_id").alias("req_id"), F.col("order_date").alias("req_ts"), "member_id", "staff_id",
                       "branch_id", "order_type", "voucher_id",
                       F.when(F.col("order_id") % 7 > 0, F.concat(F.lit("Addr "), F.col("order_id").cast("string"))).alias("address")))
    lines = t["order_item"].select(F.col("order_id").alias("req_id"), F.col("item_id").alias("line_no"), "item_id", "quantity")
    return headers, lines

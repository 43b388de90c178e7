"""Validation rules re-aimed from the reference's row triggers.

Every rule is set-based: ``rule(t, as_of) -> DataFrame(rule_id, table_name, row_key, code)``
with one row per violating row and the code the trigger raises. When a trigger checks
several things in turn, the first failing check's code is reported (a ``when`` chain in
the trigger's order). ``run_rules`` unions the rules that the given tables can feed.

Historical rows have no insert time: V13 and V14 compare with the row's own timestamp;
V10-V12 compare with ``as_of``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlake.functions.dates import ic_birth_date, lit_date
from martlake.plans.ledger import ledger_fold

VIOLATION_COLS = ("rule_id", "table_name", "row_key", "code")


def _viol(df: DataFrame, rule_id: str, table: str, key: Column, code: Column) -> DataFrame:
    return df.select(F.lit(rule_id).alias("rule_id"), F.lit(table).alias("table_name"),
                     key.cast("string").alias("row_key"), code.cast("int").alias("code"))


def _first(*checks) -> Column:
    """First failing check's code: checks are (condition, code) pairs in trigger order."""
    out = None
    for cond, code in checks:
        out = F.when(cond, F.lit(code)) if out is None else out.when(cond, F.lit(code))
    return out


def _line_key():
    return F.concat_ws("|", F.col("order_id").cast("string"), F.col("item_id").cast("string"))


# ---------------------------------------------------------------- ledgers

def stock_ledger(t, lines: DataFrame | None = None) -> DataFrame:
    """V01 detail: replay order lines against branch stock in (order date, order, item) order.

    Checks per line: quantity <= 0 (-20014); order missing (-20010); item missing (-20011);
    (branch, item) not stocked (-20012); stock short at that point (-20013, ordered fold).
    Returns every line with ``code`` (NULL when accepted) and ``stock_after``.
    """
    lines = lines if lines is not None else t["order_item"]
    o = t["orders"].select("order_id", "branch_id", "order_date")
    stock = t["branch_stock"].select("branch_id", "item_id", F.col("stock_quantity").alias("opening"))
    j = (lines.select("order_id", "item_id", "quantity")
         .join(o, "order_id", "left")
         .join(t["item"].select("item_id", F.lit(True).alias("_item")), "item_id", "left")
         .join(stock.select("branch_id", "item_id", F.lit(True).alias("_stocked")), ["branch_id", "item_id"], "left"))
    static = _first((F.col("quantity").isNull() | (F.col("quantity") <= 0), -20014),
                    (F.col("order_date").isNull(), -20010),
                    (F.col("_item").isNull(), -20011),
                    (F.col("_stocked").isNull(), -20012))
    j = j.withColumn("code", static)
    bad = j.filter(F.col("code").isNotNull()).select("order_id", "item_id", "branch_id", "order_date", "quantity",
                                                     "code", F.lit(None).cast("bigint").alias("stock_after"))
    ok = (j.filter(F.col("code").isNull()).select("order_id", "item_id", "branch_id", "order_date", "quantity")
           .withColumn("delta", -F.col("quantity").cast("bigint")))
    folded = ledger_fold(ok, stock, keys=["branch_id", "item_id"], order=["order_date", "order_id"])
    folded = folded.select("order_id", "item_id", "branch_id", "order_date", "quantity",
                           F.when(~F.col("accepted"), F.lit(-20013)).cast("int").alias("code"),
                           F.col("balance_after").alias("stock_after"))
    return bad.unionByName(folded)


def stock_ledger_rule(t, as_of=None) -> DataFrame:
    """Order lines the stock-deduction trigger would reject."""
    d = stock_ledger(t).filter(F.col("code").isNotNull())
    return _viol(d, "V01", "order_item", _line_key(), F.col("code"))


def points_ledger(t, events: DataFrame | None = None) -> DataFrame:
    """V02 detail: point rows folded over member balances in (date, id) order.

    Checks: amount <= 0 (-20020); type not Earned/Used (-20021; NULL passes and moves nothing); member missing (-20022);
    Used more than the balance at that point (-20023). Earned adds, Used subtracts.
    """
    ev = events if events is not None else t["point_history"]
    mem = t["member"].select("member_id", F.col("points_balance").cast("bigint").alias("opening"))
    j = ev.join(mem.select("member_id", F.lit(True).alias("_m")), "member_id", "left")
    static = _first((F.col("amount").isNull() | (F.col("amount") <= 0), -20020),
                    (~F.col("transaction_type").isin("Earned", "Used"), -20021),
                    (F.col("_m").isNull(), -20022))
    j = j.withColumn("code", static)
    cols = ["point_redemption_id", "member_id", "amount", "transaction_type", "redemption_date"]
    bad = j.filter(F.col("code").isNotNull()).select(*cols, "code", F.lit(None).cast("bigint").alias("balance_after"))
    ok = (j.filter(F.col("code").isNull()).select(*cols)
           .withColumn("delta", F.when(F.col("transaction_type") == "Used", -F.col("amount")).when(F.col("transaction_type") == "Earned", F.col("amount"))
                       .otherwise(0).cast("bigint")))
    folded = ledger_fold(ok, mem, keys=["member_id"], order=["redemption_date", "point_redemption_id"])
    folded = folded.select(*cols, F.when(~F.col("accepted"), F.lit(-20023)).cast("int").alias("code"), "balance_after")
    return bad.unionByName(folded)


def points_ledger_rule(t, as_of=None) -> DataFrame:
    """Point rows the balance trigger would reject."""
    d = points_ledger(t).filter(F.col("code").isNotNull())
    return _viol(d, "V02", "point_history", F.col("point_redemption_id"), F.col("code"))


def member_balances(t) -> DataFrame:
    """Closing points balance per member after the V02 fold (opening + accepted deltas)."""
    d = points_ledger(t).filter(F.col("code").isNull())
    delta = F.when(F.col("transaction_type") == "Used", -F.col("amount")).when(F.col("transaction_type") == "Earned", F.col("amount")).otherwise(0)
    moves = d.groupBy("member_id").agg(F.sum(delta).cast("bigint").alias("_d"))
    return (t["member"].select("member_id", F.col("points_balance").cast("bigint").alias("opening"))
            .join(moves, "member_id", "left")
            .select("member_id", "opening", (F.col("opening") + F.coalesce("_d", F.lit(0))).alias("closing")))


def stock_restore(t, deleted_lines: DataFrame) -> DataFrame:
    """Deleted order lines give their quantity back to the branch's stock.

    Returns the new branch_stock: one delta aggregate per (branch, item) applied to the
    snapshot (rows without a stock row are not created, as the trigger only updates).
    """
    o = t["orders"].select("order_id", "branch_id")
    back = (deleted_lines.select("order_id", "item_id", "quantity").join(o, "order_id")
            .groupBy("branch_id", "item_id").agg(F.sum("quantity").cast("bigint").alias("_back")))
    return (t["branch_stock"].join(back, ["branch_id", "item_id"], "left")
            .select("branch_id", "item_id",
                    (F.col("stock_quantity") + F.coalesce("_back", F.lit(0))).cast("bigint").alias("stock_quantity"),
                    "last_restock_date"))


def deleted_lines(old_lines: DataFrame, new_lines: DataFrame) -> DataFrame:
    """Lines present in the old snapshot and gone from the new one (anti-join on the key)."""
    return old_lines.join(new_lines.select("order_id", "item_id"), ["order_id", "item_id"], "left_anti")


def cancelled_delivery_lines(t) -> DataFrame:
    """Order lines of deliveries in status Cancelled: the deletions V05 restores."""
    c = t["delivery"].filter(F.col("delivery_status") == "Cancelled").select("order_id")
    return t["order_item"].join(c, "order_id", "left_semi")


def stock_restore_cancelled(t) -> DataFrame:
    """Stock after returning the lines of cancelled deliveries (the deletions on the data)."""
    return stock_restore(t, cancelled_delivery_lines(t))


def low_stock_alerts(t, threshold: int = 20) -> DataFrame:
    """An alert for every accepted stock change leaving less than ``threshold`` units
    (it fires on each such change, not only when crossing the threshold)."""
    d = stock_ledger(t).filter(F.col("code").isNull() & (F.col("stock_after") < threshold))
    return d.select("branch_id", "item_id", "order_id", "order_date", "stock_after")


# ---------------------------------------------------------------- redemption rules

def duplicate_redemption(t, as_of=None) -> DataFrame:
    """Unknown order (-20030); the same voucher already redeemed on the order (-20031).

    Rows are taken in (redeemed date, id) order; only the first of a (voucher, order) pair
    passes. A window per (voucher, order) pair holds only that pair's rows.
    """
    from pyspark.sql import Window
    r = t["redemption"].join(t["orders"].select("order_id", F.lit(True).alias("_o")), "order_id", "left")
    w = Window.partitionBy("voucher_id", "order_id").orderBy(F.col("redeemed_date").asc_nulls_last(), "redemption_id")
    r = r.withColumn("_n", F.row_number().over(w))
    code = _first((F.col("_o").isNull(), -20030), (F.col("_n") > 1, -20031))
    d = r.withColumn("code", code).filter(F.col("code").isNotNull())
    return _viol(d, "V03", "redemption", F.col("redemption_id"), F.col("code"))


def expired_redemption(t, as_of=None) -> DataFrame:
    """Unknown order (-20030); unknown voucher (-20031); order date after expiry (-20032).
    A NULL expiry passes."""
    r = (t["redemption"].join(t["orders"].select("order_id", "order_date"), "order_id", "left")
         .join(t["voucher"].select("voucher_id", "exp_date", F.lit(True).alias("_v")), "voucher_id", "left"))
    code = _first((F.col("order_date").isNull(), -20030), (F.col("_v").isNull(), -20031),
                  (F.col("order_date") > F.col("exp_date").cast("timestamp_ntz"), -20032))
    d = r.withColumn("code", code).filter(F.col("code").isNotNull())
    return _viol(d, "V04", "redemption", F.col("redemption_id"), F.col("code"))


# ---------------------------------------------------------------- member and price rules

def ic_dob_mismatch(t, as_of=None) -> DataFrame:
    """The first six IC digits must be a real date (-20011) equal to the birth date (-20012).

    Needs ``ic`` and ``date_of_birth`` on the member frame.
    """
    m = t["member"]
    b = ic_birth_date(F.col("ic"))
    code = _first((F.col("ic").isNotNull() & b.isNull(), -20011),
                  (F.col("date_of_birth").isNotNull() & (b != F.col("date_of_birth")), -20012))
    d = m.withColumn("code", code).filter(F.col("code").isNotNull())
    return _viol(d, "V07", "member", F.col("member_id"), F.col("code"))


def discount_above_price(t, as_of=None) -> DataFrame:
    """Item of a promotion line missing (-20021); Amount discount above the price (-20020)."""
    j = t["promotion_details"].join(t["item"].select("item_id", "unit_price"), "item_id", "left")
    code = _first((F.col("unit_price").isNull(), -20021),
                  ((F.col("discount_type") == "Amount") & (F.col("discount_value") > F.col("unit_price")), -20020))
    d = j.withColumn("code", code).filter(F.col("code").isNotNull())
    return _viol(d, "V08", "promotion_details",
                 F.concat_ws("|", F.col("promotion_id").cast("string"), F.col("item_id").cast("string")), F.col("code"))


def latest_cost(t) -> DataFrame:
    """Latest procurement cost per item (latest date, then highest procurement id)."""
    return (t["procurement"].groupBy("item_id")
            .agg(F.max_by("unit_cost", F.struct("procurement_date", "procurement_id")).alias("latest_cost")))


def price_below_cost(t, as_of=None) -> DataFrame:
    """Item price below its latest procurement cost (-20020); never procured passes."""
    j = t["item"].join(latest_cost(t), "item_id")
    d = j.filter(F.col("unit_price") < F.col("latest_cost"))
    return _viol(d, "V09", "item", F.col("item_id"), F.lit(-20020))


def member_expiry_past(t, as_of) -> DataFrame:
    """Member expiry before ``as_of`` (-20001); NULL passes."""
    d = t["member"].filter(F.col("expiry_date") < lit_date(as_of))
    return _viol(d, "V10", "member", F.col("member_id"), F.lit(-20001))


def voucher_expiry_past(t, as_of) -> DataFrame:
    """Voucher expiry before ``as_of`` (-20002); NULL passes."""
    d = t["voucher"].filter(F.col("exp_date") < lit_date(as_of))
    return _viol(d, "V11", "voucher", F.col("voucher_id"), F.lit(-20002))


def pickup_expiry_past(t, as_of) -> DataFrame:
    """Pickup expiry before ``as_of`` (-20003); NULL (or no expiry column) passes."""
    p = t["self_pickup"]
    if "pickup_exp_date" not in p.columns:
        p = p.withColumn("pickup_exp_date", F.lit(None).cast("timestamp_ntz"))
    d = p.filter(F.col("pickup_exp_date") < F.lit(as_of).cast("timestamp_ntz"))
    return _viol(d, "V12", "self_pickup", F.col("pickup_id"), F.lit(-20003))


def expired_member_order(t, as_of=None) -> DataFrame:
    """Order placed by a member whose expiry is before the order day (-20030); guests pass."""
    j = t["orders"].filter(F.col("member_id").isNotNull()).join(t["member"].select("member_id", "expiry_date"), "member_id")
    d = j.filter(F.col("expiry_date") < F.to_date("order_date"))
    return _viol(d, "V13", "orders", F.col("order_id"), F.lit(-20030))


def expired_member_points(t, as_of=None) -> DataFrame:
    """Point row of a member whose expiry is before the row's day (-20033)."""
    j = t["point_history"].join(t["member"].select("member_id", "expiry_date"), "member_id")
    d = j.filter(F.col("expiry_date") < F.to_date("redemption_date"))
    return _viol(d, "V14", "point_history", F.col("point_redemption_id"), F.lit(-20033))


def member_age(t, as_of) -> DataFrame:
    """Birth date in the future (-20031); younger than 12 years (-20032). Needs ``date_of_birth``."""
    m = t["member"]
    dob = F.col("date_of_birth")
    code = _first((dob > lit_date(as_of), -20031), (F.months_between(lit_date(as_of), dob) / 12 < 12, -20032))
    d = m.withColumn("code", code).filter(dob.isNotNull() & F.col("code").isNotNull())
    return _viol(d, "V15", "member", F.col("member_id"), F.col("code"))


RULES = {
    "V01": stock_ledger_rule, "V02": points_ledger_rule, "V03": duplicate_redemption, "V04": expired_redemption,
    "V07": ic_dob_mismatch, "V08": discount_above_price, "V09": price_below_cost, "V10": member_expiry_past,
    "V11": voucher_expiry_past, "V12": pickup_expiry_past, "V13": expired_member_order,
    "V14": expired_member_points, "V15": member_age,
}
_NEEDS = {"V07": ("member", ("ic", "date_of_birth")), "V12": ("self_pickup", ("pickup_exp_date",)), "V15": ("member", ("date_of_birth",))}
NOT_CHECKED = "NOT_CHECKED"


def run_rules(t, as_of: _dt.date, rules=None) -> DataFrame:
    """Union of the violation frames of all rules; a rule whose input columns are absent gives
    one row with row_key NOT_CHECKED and no code."""
    out, unseen = None, []
    for rid, fn in RULES.items():
        if rules is not None and rid not in rules:
            continue
        need = _NEEDS.get(rid)
        if need and not set(need[1]) <= set(t[need[0]].columns):
            unseen.append((rid, need[0], NOT_CHECKED, None))
            continue
        v = fn(t, as_of)
        out = v if out is None else out.unionByName(v)
    if unseen:
        rows = t.spark.createDataFrame(unseen, "rule_id string, table_name string, row_key string, code int")
        out = rows if out is None else out.unionByName(rows)
    return out

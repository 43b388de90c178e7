"""Data-quality job re-aimed from the DDL constraints.

One table of constraint specs drives everything. Row rules of a table (NOT NULL, length,
pattern, domain, range, NULL primary key) are evaluated together in a single scan of the
table: each row yields an array of the constraints it breaks, which is exploded into
violation rows. Key rules (primary key and UNIQUE duplicates) are one aggregate per key,
foreign keys one anti-join per reference. CHECK semantics: a row violates a check only
when the condition is FALSE (NULL / unknown passes); a NULL foreign key passes.

Result: ``(check_id, constraint_name, table_name, row_key)``. Specs whose columns are not
present in a frame are skipped (the test adapter carries only the columns operators read).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ----------------------------------------------------------------------------------------
# The constraints of the reference schema.
# ----------------------------------------------------------------------------------------
PRIMARY_KEYS = {
    "voucher": ("voucher_id",), "member": ("member_id",), "branch": ("branch_id",), "staff": ("staff_id",),
    "delivery_company": ("company_id",), "item": ("item_id",), "supplier": ("supplier_id",),
    "promotion": ("promotion_id",), "orders": ("order_id",), "order_item": ("order_id", "item_id"),
    "branch_stock": ("branch_id", "item_id"), "promotion_details": ("promotion_id", "item_id"),
    "procurement": ("procurement_id",), "redemption": ("redemption_id",), "delivery": ("delivery_id",),
    "self_pickup": ("pickup_id",), "point_history": ("point_redemption_id",),
}

# (constraint, child table, child column, parent table, parent column)
FOREIGN_KEYS = (
    ("fk_staff_branch", "staff", "branch_id", "branch", "branch_id"),
    ("fk_orders_member", "orders", "member_id", "member", "member_id"),
    ("fk_orders_staff", "orders", "staff_id", "staff", "staff_id"),
    ("fk_orders_branch", "orders", "branch_id", "branch", "branch_id"),
    ("fk_orderitem_order", "order_item", "order_id", "orders", "order_id"),
    ("fk_orderitem_item", "order_item", "item_id", "item", "item_id"),
    ("fk_branchstock_branch", "branch_stock", "branch_id", "branch", "branch_id"),
    ("fk_branchstock_item", "branch_stock", "item_id", "item", "item_id"),
    ("fk_promodetails_promotion", "promotion_details", "promotion_id", "promotion", "promotion_id"),
    ("fk_promodetails_item", "promotion_details", "item_id", "item", "item_id"),
    ("fk_procurement_item", "procurement", "item_id", "item", "item_id"),
    ("fk_procurement_supplier", "procurement", "supplier_id", "supplier", "supplier_id"),
    ("fk_procurement_branch", "procurement", "branch_id", "branch", "branch_id"),
    ("fk_redemption_voucher", "redemption", "voucher_id", "voucher", "voucher_id"),
    ("fk_redemption_order", "redemption", "order_id", "orders", "order_id"),
    ("fk_delivery_order", "delivery", "order_id", "orders", "order_id"),
    ("fk_delivery_company", "delivery", "company_id", "delivery_company", "company_id"),
    ("fk_pickup_order", "self_pickup", "order_id", "orders", "order_id"),
    ("fk_pointhistory_member", "point_history", "member_id", "member", "member_id"),
)

# (constraint, table, column)
UNIQUES = (
    ("uq_member_ic", "member", "ic"), ("uq_member_email", "member", "email"),
    ("uq_delivery_order", "delivery", "order_id"), ("uq_pickup_order", "self_pickup", "order_id"),
)

# table -> ((column, varchar length or None, not null), ...)
COLUMNS = {
    "voucher": (("voucher_id", 10, True), ("voucher_type", 20, False), ("voucher_value", None, True),
                ("description", 255, False)),
    "member": (("member_id", None, True), ("name", 100, True), ("ic", 14, True), ("email", 40, False),
               ("address", 255, False)),
    "branch": (("branch_id", None, True), ("branch_name", 100, True), ("address", 255, False)),
    "staff": (("staff_id", None, True), ("branch_id", None, True), ("staff_name", 100, True), ("position", 50, False),
              ("contact_no", 15, False)),
    "delivery_company": (("company_id", None, True), ("company_name", 100, True), ("contact_no", 15, False)),
    "item": (("item_id", 10, True), ("item_name", 100, True), ("description", 255, False),
             ("unit_price", None, True), ("category", 50, False)),
    "supplier": (("supplier_id", None, True), ("supplier_name", 100, True), ("contact_person", 100, False),
                 ("phone_no", 15, False), ("email", 100, False), ("address", 255, False)),
    "promotion": (("promotion_id", None, True), ("promotion_name", 100, True), ("description", 255, False),
                  ("status", 20, False)),
    "orders": (("order_id", None, True), ("branch_id", None, True), ("order_date", None, True),
               ("order_type", 20, False)),
    "order_item": (("order_id", None, True), ("item_id", 10, True), ("quantity", None, True), ("unit_price", None, True)),
    "branch_stock": (("branch_id", None, True), ("item_id", 10, True)),
    "promotion_details": (("promotion_id", None, True), ("item_id", 10, True), ("discount_type", 20, False)),
    "procurement": (("procurement_id", None, True), ("item_id", 10, True), ("supplier_id", None, True),
                    ("branch_id", None, True), ("quantity", None, True), ("unit_cost", None, True),
                    ("procurement_date", None, True)),
    "redemption": (("redemption_id", None, True), ("voucher_id", 10, True), ("order_id", None, True)),
    "delivery": (("delivery_id", None, True), ("order_id", None, True), ("company_id", None, True),
                 ("delivery_address", 255, True), ("delivery_status", 20, False)),
    "self_pickup": (("pickup_id", None, True), ("order_id", None, True), ("pickup_status", 20, False)),
    "point_history": (("point_redemption_id", None, True), ("member_id", None, True), ("amount", None, True),
                      ("transaction_type", 10, False)),
}

EMAIL = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
PHONE = r"^0[1-9][0-9]?-[0-9]{7,8}$"
IC = r"^[0-9]{6}-[0-9]{2}-[0-9]{4}$"
# (constraint, table, column, pattern)
PATTERNS = (
    ("chk_member_ic", "member", "ic", IC), ("chk_member_email", "member", "email", EMAIL),
    ("chk_staff_contact", "staff", "contact_no", PHONE), ("chk_company_contact", "delivery_company", "contact_no", PHONE),
    ("chk_supplier_phone", "supplier", "phone_no", PHONE), ("chk_supplier_email", "supplier", "email", EMAIL),
)

# (constraint, table, column, allowed values)
DOMAINS = (
    ("chk_voucher_type", "voucher", "voucher_type", ("Percentage", "Amount")),
    ("chk_promotion_status", "promotion", "status", ("Active", "Inactive", "Expired")),
    ("chk_order_type", "orders", "order_type", ("Delivery", "Self Pickup", "In Store")),
    ("chk_discount_type", "promotion_details", "discount_type", ("Percentage", "Amount")),
    ("chk_delivery_status", "delivery", "delivery_status", ("Delivered", "Out for Delivery", "Pending", "Preparing", "Cancelled")),
    ("chk_pickup_status", "self_pickup", "pickup_status", ("Completed", "Ready", "Preparing", "Expired", "Rescheduled", "Cancelled")),
    ("chk_point_type", "point_history", "transaction_type", ("Earned", "Used")),
)

# (constraint, table, SQL condition that must not be FALSE)
RANGES = (
    ("chk_voucher_value", "voucher", "voucher_value >= 0"),
    ("chk_voucher_pct_cap", "voucher", "(voucher_type = 'Percentage' AND voucher_value BETWEEN 0 AND 100) OR (voucher_type = 'Amount' AND voucher_value >= 0)"),
    ("chk_member_points", "member", "points_balance >= 0"),
    ("chk_delivery_charge", "delivery_company", "delivery_charge >= 0"),
    ("chk_item_price", "item", "unit_price >= 0"),
    ("chk_promotion_dates", "promotion", "end_date >= start_date"),
    ("chk_orderitem_qty", "order_item", "quantity > 0"),
    ("chk_orderitem_price", "order_item", "unit_price >= 0"),
    ("chk_stock_qty", "branch_stock", "stock_quantity >= 0"),
    ("chk_discount_value", "promotion_details", "discount_value >= 0"),
    ("chk_discount_pct_cap", "promotion_details", "(discount_type = 'Percentage' AND discount_value BETWEEN 0 AND 100) OR (discount_type = 'Amount' AND discount_value >= 0)"),
    ("chk_procurement_qty", "procurement", "quantity > 0"),
    ("chk_procurement_cost", "procurement", "unit_cost >= 0"),
    ("chk_point_amount", "point_history", "amount > 0"),
)
# (columns each range condition reads)
RANGE_COLUMNS = {
    "chk_voucher_value": ("voucher_value",), "chk_voucher_pct_cap": ("voucher_type", "voucher_value"),
    "chk_member_points": ("points_balance",), "chk_delivery_charge": ("delivery_charge",),
    "chk_item_price": ("unit_price",), "chk_promotion_dates": ("start_date", "end_date"),
    "chk_orderitem_qty": ("quantity",), "chk_orderitem_price": ("unit_price",), "chk_stock_qty": ("stock_quantity",),
    "chk_discount_value": ("discount_value",), "chk_discount_pct_cap": ("discount_type", "discount_value"),
    "chk_procurement_qty": ("quantity",), "chk_procurement_cost": ("unit_cost",), "chk_point_amount": ("amount",),
}

ALL_CHECKS = ("C01", "C02", "C03", "C04", "C05", "C06", "C07")
OUT_SCHEMA = "check_id string, constraint_name string, table_name string, row_key string"


def row_key(df: DataFrame, table: str):
    return F.concat_ws("|", *[F.col(c).cast("string") for c in PRIMARY_KEYS[table]])


def _is_false(cond):
    return F.coalesce(~cond, F.lit(False))


def _row_rules(df: DataFrame, table: str, checks) -> list:
    """(check_id, constraint name, violated Column) for every row rule applicable to the frame."""
    cols = set(df.columns)
    types = dict(df.dtypes)
    out = []
    if "C01" in checks and set(PRIMARY_KEYS[table]) <= cols:
        null_pk = None
        for c in PRIMARY_KEYS[table]:
            null_pk = F.col(c).isNull() if null_pk is None else (null_pk | F.col(c).isNull())
        out.append(("C01", f"pk_{table}_not_null", null_pk))
    if "C04" in checks:
        for c, n, nn in COLUMNS.get(table, ()):
            if c not in cols:
                continue
            if nn:
                out.append(("C04", f"nn_{table}_{c}", F.col(c).isNull()))
            if n is not None and types[c] == "string":
                out.append(("C04", f"len_{table}_{c}", F.coalesce(F.length(c) > n, F.lit(False))))
    if "C05" in checks:
        for name, tb, c, pat in PATTERNS:
            if tb == table and c in cols:
                out.append(("C05", name, _is_false(F.col(c).rlike(pat))))
    if "C06" in checks:
        for name, tb, c, vals in DOMAINS:
            if tb == table and c in cols:
                out.append(("C06", name, _is_false(F.col(c).isin(*vals))))
    if "C07" in checks:
        for name, tb, cond in RANGES:
            if tb == table and set(RANGE_COLUMNS[name]) <= cols:
                out.append(("C07", name, _is_false(F.expr(cond))))
    return out


NOT_CHECKED = "NOT_CHECKED"


def not_checked(table: str, columns, checks) -> list[tuple]:
    """Rows (check_id, constraint name, table, NOT_CHECKED) for the rules on columns that the
    table doesn't have: those constraints hold or not unseen."""
    cols, out = set(columns), []
    if "C03" in checks:
        out += [("C03", name) for name, tb, c in UNIQUES if tb == table and c not in cols]
    if "C04" in checks:
        for c, n, nn in COLUMNS.get(table, ()):
            if c not in cols:
                out += [("C04", f"nn_{table}_{c}")] * bool(nn) + [("C04", f"len_{table}_{c}")] * (n is not None)
    if "C05" in checks:
        out += [("C05", name) for name, tb, c, _ in PATTERNS if tb == table and c not in cols]
    if "C06" in checks:
        out += [("C06", name) for name, tb, c, _ in DOMAINS if tb == table and c not in cols]
    if "C07" in checks:
        out += [("C07", name) for name, tb, _ in RANGES if tb == table and not set(RANGE_COLUMNS[name]) <= cols]
    return [(*r, table, NOT_CHECKED) for r in out]


def _shape(t, table: str) -> DataFrame:
    """A frame with the table's columns; a table no rule reads needn't be stored for them."""
    return t.derived(table) if hasattr(t, "derived") else t[table]


def _empty(spark):
    return spark.createDataFrame([], OUT_SCHEMA)


def constraint_violations(t, checks=ALL_CHECKS) -> DataFrame:
    """All violations of the requested check classes over the retail tables, and a row with
    row_key NOT_CHECKED for each rule on a column that a table at hand doesn't have."""
    from martlake.sources.retail import TABLES
    checks = set(checks)
    have = set(t.available()) if hasattr(t, "available") else set(TABLES)
    parts = []
    for table in TABLES:
        if table not in have:
            continue
        rules = _row_rules(_shape(t, table), table, checks)
        if not rules:
            continue  # C01 has a rule for every table with its key
        df = t[table]
        if set(PRIMARY_KEYS[table]) <= set(df.columns):
            arr = F.array(*[F.when(v, F.struct(F.lit(cid).alias("check_id"), F.lit(name).alias("constraint_name")))
                            for cid, name, v in rules])
            hits = F.filter(arr, lambda x: x.isNotNull())
            rows = (df.select(row_key(df, table).alias("row_key"), hits.alias("_v"))
                      .filter(F.size("_v") > 0)
                      .select(F.explode("_v").alias("v"), "row_key")
                      .select("v.check_id", "v.constraint_name", F.lit(table).alias("table_name"), "row_key"))
            parts.append(rows)
        if "C01" in checks and set(PRIMARY_KEYS[table]) <= set(df.columns):
            keys = list(PRIMARY_KEYS[table])
            dup = (df.select(*keys).dropna().groupBy(*keys).count().filter(F.col("count") > 1)
                     .select(F.lit("C01").alias("check_id"), F.lit(f"pk_{table}").alias("constraint_name"),
                             F.lit(table).alias("table_name"), row_key(df, table).alias("row_key")))
            parts.append(dup)
    if "C02" in checks:
        for name, child, ccol, parent, pcol in FOREIGN_KEYS:
            if child not in have or parent not in have:
                continue
            c, p = t[child], t[parent]
            if ccol not in c.columns or pcol not in p.columns:
                continue
            orphans = (c.filter(F.col(ccol).isNotNull())
                        .join(p.select(F.col(pcol).alias(ccol)), ccol, "left_anti"))
            parts.append(orphans.select(F.lit("C02").alias("check_id"), F.lit(name).alias("constraint_name"),
                                        F.lit(child).alias("table_name"), row_key(c, child).alias("row_key")))
    if "C03" in checks:
        for name, table, col in UNIQUES:
            if table not in have:
                continue
            if col not in _shape(t, table).columns:
                continue
            df = t[table]
            dup = (df.filter(F.col(col).isNotNull()).groupBy(col).count().filter(F.col("count") > 1)
                     .select(F.lit("C03").alias("check_id"), F.lit(name).alias("constraint_name"),
                             F.lit(table).alias("table_name"), F.col(col).cast("string").alias("row_key")))
            parts.append(dup)
    unseen = [r for table in TABLES if table in have for r in not_checked(table, _shape(t, table).columns, checks)]
    if unseen:
        parts.append(t.spark.createDataFrame(unseen, OUT_SCHEMA))
    if not parts:
        return _empty(t.spark)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


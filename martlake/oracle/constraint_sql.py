"""Oracle SQL (DuckDB) for the constraint checks, generated from the same constraint specs
over the adapter views (whose column lists are given here)."""

from martlake.operators.constraints import (COLUMNS, DOMAINS, FOREIGN_KEYS, PATTERNS, PRIMARY_KEYS, RANGE_COLUMNS,
                                            RANGES, UNIQUES)

# columns of the adapter views: name -> is a string column
ADAPTER_COLUMNS = {
    "branch": {"branch_id": False, "branch_name": True},
    "member": {"member_id": False, "name": True, "email": True, "points_balance": False, "expiry_date": False},
    "item": {"item_id": False, "item_name": True, "category": True, "unit_price": False},
    "supplier": {"supplier_id": False, "supplier_name": True},
    "staff": {"staff_id": False, "branch_id": False},
    "orders": {"order_id": False, "member_id": False, "staff_id": False, "branch_id": False, "order_date": False,
               "order_type": True},
    "order_item": {"order_id": False, "item_id": False, "quantity": False, "unit_price": False},
    "procurement": {"procurement_id": False, "item_id": False, "supplier_id": False, "branch_id": False, "quantity": False,
                    "unit_cost": False, "procurement_date": False},
    "branch_stock": {"branch_id": False, "item_id": False, "stock_quantity": False, "last_restock_date": False},
    "promotion": {"promotion_id": False, "promotion_name": True, "status": True, "start_date": False, "end_date": False},
    "promotion_details": {"promotion_id": False, "item_id": False, "discount_type": True, "discount_value": False},
    "voucher": {"voucher_id": True, "voucher_type": True, "voucher_value": False, "exp_date": False},
    "redemption": {"redemption_id": False, "voucher_id": True, "order_id": False, "redeemed_date": False},
    "delivery_company": {"company_id": False, "company_name": True},
    "delivery": {"delivery_id": False, "order_id": False, "company_id": False, "delivery_status": True},
    "self_pickup": {"pickup_id": False, "order_id": False, "pickup_status": True},
    "point_history": {"point_redemption_id": False, "member_id": False, "amount": False, "transaction_type": True,
                      "redemption_date": False},
}


def _key(table: str, alias: str = "") -> str:
    a = f"{alias}." if alias else ""
    return " || '|' || ".join(f"cast({a}{c} as varchar)" for c in PRIMARY_KEYS[table])


def _q(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def _violations(check: str) -> str:
    parts = []
    for table, cols in ADAPTER_COLUMNS.items():
        rv = f"r_{table}"
        def row(name, cond):
            parts.append(f"select '{check}' as check_id, '{name}' as constraint_name, '{table}' as table_name, "
                         f"{_key(table)} as row_key from {rv} where {cond}")
        if check == "C01":
            row(f"pk_{table}_not_null", " or ".join(f"{c} is null" for c in PRIMARY_KEYS[table]))
            keys = ", ".join(PRIMARY_KEYS[table])
            parts.append(f"select 'C01', 'pk_{table}', '{table}', {_key(table)} from {rv} "
                         f"where {' and '.join(c + ' is not null' for c in PRIMARY_KEYS[table])} group by {keys} having count(*) > 1")
        if check == "C04":
            for c, n, nn in COLUMNS.get(table, ()):
                if c not in cols:
                    continue
                if nn:
                    row(f"nn_{table}_{c}", f"{c} is null")
                if n is not None and cols[c]:
                    row(f"len_{table}_{c}", f"length({c}) > {n}")
        if check == "C05":
            for name, tb, c, pat in PATTERNS:
                if tb == table and c in cols:
                    row(name, f"not regexp_matches({c}, {_q(pat)})")
        if check == "C06":
            for name, tb, c, vals in DOMAINS:
                if tb == table and c in cols:
                    row(name, f"{c} not in ({', '.join(_q(v) for v in vals)})")
        if check == "C07":
            for name, tb, cond in RANGES:
                if tb == table and set(RANGE_COLUMNS[name]) <= set(cols):
                    row(name, f"not ({cond})")
    if check == "C02":
        for name, child, ccol, parent, pcol in FOREIGN_KEYS:
            if ccol in ADAPTER_COLUMNS[child] and pcol in ADAPTER_COLUMNS[parent]:
                parts.append(f"select 'C02' as check_id, '{name}' as constraint_name, '{child}' as table_name, "
                             f"{_key(child, 'c')} as row_key from r_{child} c "
                             f"where c.{ccol} is not null and not exists (select 1 from r_{parent} p where p.{pcol} = c.{ccol})")
    if check == "C03":
        for name, table, col in UNIQUES:
            if col in ADAPTER_COLUMNS[table]:
                parts.append(f"select 'C03' as check_id, '{name}' as constraint_name, '{table}' as table_name, "
                             f"cast({col} as varchar) as row_key from r_{table} "
                             f"where {col} is not null group by {col} having count(*) > 1")
    # rules on columns that the adapter doesn't give
    def unseen(name, table):
        parts.append(f"select '{check}' as check_id, '{name}' as constraint_name, '{table}' as table_name, 'NOT_CHECKED' as row_key")
    for table, cols in ADAPTER_COLUMNS.items():
        if check == "C03":
            for name, tb, c in UNIQUES:
                if tb == table and c not in cols:
                    unseen(name, table)
        if check == "C04":
            for c, n, nn in COLUMNS.get(table, ()):
                if c not in cols and nn:
                    unseen(f"nn_{table}_{c}", table)
                if c not in cols and n is not None:
                    unseen(f"len_{table}_{c}", table)
        if check == "C05":
            for name, tb, c, _ in PATTERNS:
                if tb == table and c not in cols:
                    unseen(name, table)
        if check == "C06":
            for name, tb, c, _ in DOMAINS:
                if tb == table and c not in cols:
                    unseen(name, table)
        if check == "C07":
            for name, tb, _ in RANGES:
                if tb == table and any(c not in cols for c in RANGE_COLUMNS[name]):
                    unseen(name, table)
    if not parts:
        return ("select cast(null as varchar) as check_id, cast(null as varchar) as constraint_name, "
                "cast(null as varchar) as table_name, cast(null as varchar) as row_key where false")
    return "\nunion all\n".join(parts)


NAMES = {"C01": "pk_unique_not_null", "C02": "fk_orphans", "C03": "unique_columns", "C04": "length_and_not_null",
         "C05": "pattern_checks", "C06": "domain_checks", "C07": "range_checks"}

SQL = {name: _violations(cid) for cid, name in NAMES.items()}

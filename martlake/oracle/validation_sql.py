"""Oracle SQL (DuckDB) for the validation rules. The ordered folds (V01, V02) are
recursive CTEs that walk each key's events one by one -- an independent check of the
fast-path-plus-streaming fold used on Spark."""

_V01_FOLD = """
with recursive l as (
  select oi.order_id, oi.item_id, oi.quantity, o.branch_id, o.order_date, bs.stock_quantity as opening,
    case when oi.quantity is null or oi.quantity <= 0 then -20014 when o.order_id is null then -20010
         when i.item_id is null then -20011 when bs.item_id is null then -20012 end as scode
  from r_order_item oi left join r_orders o on o.order_id = oi.order_id left join r_item i on i.item_id = oi.item_id
  left join r_branch_stock bs on bs.branch_id = o.branch_id and bs.item_id = oi.item_id),
ev as (select *, row_number() over (partition by branch_id, item_id order by order_date, order_id) as rn from l where scode is null),
f(branch_id, item_id, rn, bal, order_id, order_date, rej) as (
  select distinct branch_id, item_id, 0, cast(opening as bigint), cast(null as bigint), cast(null as timestamp), false from ev
  union all
  select f.branch_id, f.item_id, ev.rn,
    case when f.bal - ev.quantity >= 0 then f.bal - ev.quantity else f.bal end, ev.order_id, ev.order_date, f.bal - ev.quantity < 0
  from f join ev on ev.branch_id = f.branch_id and ev.item_id = f.item_id and ev.rn = f.rn + 1)"""

_V02_FOLD = """
with recursive ev0 as (
  select ph.*, m.points_balance,
    case when ph.amount is null or ph.amount <= 0 then -20020
         when ph.transaction_type not in ('Earned', 'Used') then -20021
         when m.member_id is null then -20022 end as scode
  from r_point_history ph left join r_member m on m.member_id = ph.member_id),
ev as (select *, row_number() over (partition by member_id order by redemption_date, point_redemption_id) as rn,
  case when transaction_type = 'Used' then -amount when transaction_type = 'Earned' then amount else 0 end as d from ev0 where scode is null),
f(member_id, rn, bal, pid, rej) as (
  select distinct member_id, 0, cast(points_balance as bigint), cast(null as bigint), false from ev
  union all
  select f.member_id, ev.rn, case when f.bal + ev.d >= 0 then f.bal + ev.d else f.bal end, ev.point_redemption_id, f.bal + ev.d < 0
  from f join ev on ev.member_id = f.member_id and ev.rn = f.rn + 1)"""

SQL = {
    # streams run to completion equal the batch ledgers' detail
    "points_ledger_stream": _V02_FOLD + """
select point_redemption_id, member_id, cast(amount as bigint) as amount, transaction_type, redemption_date,
  cast(scode as varchar) as code, cast(null as bigint) as balance_after from ev0 where scode is not null
union all
select ev.point_redemption_id, ev.member_id, cast(ev.amount as bigint), ev.transaction_type, ev.redemption_date,
  case when f.rej then '-20023' end, f.bal
from f join ev on ev.point_redemption_id = f.pid""",

    "low_stock_stream": _V01_FOLD + """
select order_id, item_id, branch_id, order_date, cast(quantity as bigint) as quantity, cast(scode as varchar) as code,
  cast(null as bigint) as stock_after, false as low_stock from l where scode is not null
union all
select f.order_id, f.item_id, f.branch_id, f.order_date, cast(ev.quantity as bigint), case when f.rej then '-20013' end,
  f.bal, (not f.rej) and f.bal < 20
from f join ev on ev.branch_id = f.branch_id and ev.item_id = f.item_id and ev.rn = f.rn""",

    "dedupe_redemptions_stream": """
select redemption_id, voucher_id, order_id, redeemed_date, cast(null as varchar) as code from (
  select r.*, row_number() over (partition by r.voucher_id, r.order_id order by r.redeemed_date asc nulls last, r.redemption_id) as rn
  from r_redemption r where r.order_id in (select order_id from r_orders)) where rn = 1""",

    "stock_ledger_violations": _V01_FOLD + """
select 'V01' as rule_id, 'order_item' as table_name, cast(order_id as varchar) || '|' || cast(item_id as varchar) as row_key,
  cast(code as integer) as code
from (select order_id, item_id, scode as code from l where scode is not null
      union all select order_id, item_id, -20013 from f where rej)""",

    "low_stock_alerts": _V01_FOLD + """
select branch_id, item_id, order_id, order_date, bal as stock_after from f where rn > 0 and not rej and bal < 20""",

    "points_ledger_violations": _V02_FOLD + """
select 'V02' as rule_id, 'point_history' as table_name, cast(pid as varchar) as row_key, cast(code as integer) as code
from (select point_redemption_id as pid, scode as code from ev0 where scode is not null
      union all select pid, -20023 from f where rej)""",

    "member_points_balances": _V02_FOLD + """
, last as (select member_id, bal from (select *, row_number() over (partition by member_id order by rn desc) as r from f) where r = 1)
select m.member_id, cast(m.points_balance as bigint) as opening, coalesce(last.bal, cast(m.points_balance as bigint)) as closing
from r_member m left join last on last.member_id = m.member_id""",

    "duplicate_redemption": """
select 'V03' as rule_id, 'redemption' as table_name, cast(redemption_id as varchar) as row_key, cast(code as integer) as code from (
  select r.redemption_id, case when o.order_id is null then -20030
    when row_number() over (partition by r.voucher_id, r.order_id order by r.redeemed_date asc nulls last, r.redemption_id) > 1 then -20031 end as code
  from r_redemption r left join r_orders o on o.order_id = r.order_id) where code is not null""",

    "expired_redemption": """
select 'V04' as rule_id, 'redemption' as table_name, cast(r.redemption_id as varchar) as row_key,
  cast(case when o.order_id is null then -20030 when v.voucher_id is null then -20031 when o.order_date > v.exp_date then -20032 end as integer) as code
from r_redemption r left join r_orders o on o.order_id = r.order_id left join r_voucher v on v.voucher_id = r.voucher_id
where o.order_id is null or v.voucher_id is null or o.order_date > v.exp_date""",

    "stock_restore_cancelled": """
with back as (select o.branch_id, oi.item_id, sum(oi.quantity) as b from r_order_item oi join r_orders o on o.order_id = oi.order_id
  where oi.order_id in (select order_id from r_delivery where delivery_status = 'Cancelled') group by o.branch_id, oi.item_id)
select bs.branch_id, bs.item_id, cast(bs.stock_quantity + coalesce(back.b, 0) as bigint) as stock_quantity, bs.last_restock_date
from r_branch_stock bs left join back on back.branch_id = bs.branch_id and back.item_id = bs.item_id""",

    "discount_above_price": """
select 'V08' as rule_id, 'promotion_details' as table_name, cast(pd.promotion_id as varchar) || '|' || cast(pd.item_id as varchar) as row_key,
  cast(case when i.item_id is null then -20021 else -20020 end as integer) as code
from r_promotion_details pd left join r_item i on i.item_id = pd.item_id
where i.item_id is null or (pd.discount_type = 'Amount' and pd.discount_value > i.unit_price)""",

    "price_below_cost": """
select 'V09' as rule_id, 'item' as table_name, cast(i.item_id as varchar) as row_key, -20020 as code
from r_item i join (select item_id, arg_max(unit_cost, (procurement_date, procurement_id)) as latest_cost from r_procurement group by item_id) lc
  on lc.item_id = i.item_id
where i.unit_price < lc.latest_cost""",

    "member_expiry_past": """
select 'V10' as rule_id, 'member' as table_name, cast(member_id as varchar) as row_key, -20001 as code
from r_member where expiry_date < date '2001-08-01'""",

    "voucher_expiry_past": """
select 'V11' as rule_id, 'voucher' as table_name, voucher_id as row_key, -20002 as code
from r_voucher where exp_date < date '2001-08-01'""",

    "expired_member_order": """
select 'V13' as rule_id, 'orders' as table_name, cast(o.order_id as varchar) as row_key, -20030 as code
from r_orders o join r_member m on m.member_id = o.member_id where m.expiry_date < cast(o.order_date as date)""",

    "expired_member_points": """
select 'V14' as rule_id, 'point_history' as table_name, cast(ph.point_redemption_id as varchar) as row_key, -20033 as code
from r_point_history ph join r_member m on m.member_id = ph.member_id where m.expiry_date < cast(ph.redemption_date as date)""",
}


# run_rules: every rule the test tables can feed, as one frame
_RULE_QUERIES = ("stock_ledger_violations", "points_ledger_violations", "duplicate_redemption", "expired_redemption",
                 "discount_above_price", "price_below_cost", "member_expiry_past", "voucher_expiry_past",
                 "expired_member_order", "expired_member_points")
SQL["validation_violations"] = "\nunion all\n".join(
    f"select rule_id, table_name, row_key, cast(code as integer) as code from ({SQL[n]}) v_{i}"
    for i, n in enumerate(_RULE_QUERIES)) + """
union all select * from (values ('V07', 'member', 'NOT_CHECKED', cast(null as integer)), ('V12', 'self_pickup', 'NOT_CHECKED', cast(null as integer)),
                                ('V15', 'member', 'NOT_CHECKED', cast(null as integer))) unseen(rule_id, table_name, row_key, code)"""


# V07 / V15 over the member rows of the registration requests (they carry IC and birth date)
SQL["ic_dob_mismatch"] = """
select 'V07' as rule_id, 'member' as table_name, cast(req_id as varchar) as row_key, cast(code as integer) as code from (
  select req_id, case when ic is not null and bd is null then -20011
                      when date_of_birth is not null and bd <> date_of_birth then -20012 end as code
  from (select q.*, case when regexp_full_match(substr(ic, 1, 6), '[0-9]{6}')
                         then cast(try_strptime(case when cast(substr(ic, 1, 2) as integer) >= 50 then '19' else '20' end
                                                || substr(ic, 1, 6), '%Y%m%d') as date) end as bd
        from q_register q))
where code is not null"""

# months between as the reference's database (and Spark) count them: whole months, plus
# the day difference over 31 unless both days are equal or both are month ends
_MONTHS = """((year(a) - year(b)) * 12 + (month(a) - month(b))
  + case when day(a) = day(b) or (a = last_day(a) and b = last_day(b)) then 0 else (day(a) - day(b)) / 31.0 end)"""

SQL["member_age"] = f"""
select 'V15' as rule_id, 'member' as table_name, cast(req_id as varchar) as row_key, cast(code as integer) as code from (
  select req_id, case when b > a then -20031 when {_MONTHS} / 12 < 12 then -20032 end as code
  from (select req_id, date_of_birth as b, date '2024-01-31' as a from q_register where date_of_birth is not null))
where code is not null"""

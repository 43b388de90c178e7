"""Oracle SQL (DuckDB) for the member operators."""

_BEHAVIOR = """
select m.member_id, m.name, m.email, m.points_balance,
  count(distinct o.order_id) as total_orders,
  count(distinct oi.item_id) as different_items_purchased,
  cast(coalesce(sum(oi.quantity), 0) as bigint) as total_units_purchased,
  cast(coalesce(sum(oi.quantity * oi.unit_price), 0) as decimal(18,2)) as total_spending,
  coalesce(cast(sum(oi.quantity * oi.unit_price) as double) / count(oi.quantity * oi.unit_price), 0) as average_line_spending
from r_member m left join r_orders o on m.member_id = o.member_id
left join r_order_item oi on o.order_id = oi.order_id
left join r_item i on oi.item_id = i.item_id
group by m.member_id, m.name, m.email, m.points_balance
having count(distinct o.order_id) > 0"""

_RFM_BASE = """
with per as (
select o.branch_id, m.member_id, m.name as member_name, count(distinct o.order_id) as frequency,
  cast(coalesce(sum(oi.quantity * oi.unit_price), 0) as decimal(18,2)) as monetary,
  cast(date '2001-08-01' - cast(max(o.order_date) as date) as integer) as recency
from r_member m join r_orders o on m.member_id = o.member_id
left join r_order_item oi on oi.order_id = o.order_id
group by o.branch_id, m.member_id, m.name),
sc as (select *, (case when recency <= 30 then 3 when recency <= 90 then 2 else 1 end)
   + (case when frequency >= 10 then 3 when frequency >= 5 then 2 else 1 end)
   + (case when monetary >= 500 then 3 when monetary >= 200 then 2 else 1 end) as rfm_score from per)
select branch_id, cast(row_number() over (partition by branch_id order by rfm_score desc, recency asc, frequency desc, monetary desc, member_id) as integer) as rank,
  member_id, member_name, recency, frequency, monetary, rfm_score,
  count(*) over (partition by branch_id) as customers_total
from sc"""

SQL = {
    "member_purchase_behavior": _BEHAVIOR,

    "member_segments": f"""
select *, case when total_spending >= 5000 then 'VIP CUSTOMER' when total_spending >= 2000 then 'HIGH VALUE'
  when total_spending >= 500 then 'REGULAR' else 'LOW ACTIVITY' end as customer_segment
from ({_BEHAVIOR}) v""",

    "member_total_spending": """
select m.member_id, m.name,
  cast(coalesce((select sum(oi.quantity * oi.unit_price) from r_orders o join r_order_item oi on o.order_id = oi.order_id
                 where o.member_id = m.member_id), 0) as decimal(18,2)) as total_spending
from r_member m""",

    "customer_rfm": _RFM_BASE,

    "top_members_with_items": """
with top as (
select m.member_id, m.name, m.points_balance, cast(sum(oi.quantity * oi.unit_price) as decimal(18,2)) as spent
from r_member m join r_orders o on m.member_id = o.member_id join r_order_item oi on o.order_id = oi.order_id
group by m.member_id, m.name, m.points_balance order by spent desc, m.member_id limit 5),
rk as (select *, cast(row_number() over (order by spent desc, member_id) as integer) as member_rank from top),
it as (select o.member_id, i.item_name, cast(sum(oi.quantity) as bigint) as units
  from r_order_item oi join r_item i on oi.item_id = i.item_id join r_orders o on o.order_id = oi.order_id
  where o.member_id in (select member_id from top) group by o.member_id, i.item_name),
itr as (select *, cast(row_number() over (partition by member_id order by units desc, item_name) as integer) as item_rank from it)
select rk.member_rank, rk.member_id, rk.name, rk.points_balance, rk.spent, itr.item_rank, itr.item_name, itr.units
from rk left join itr on itr.member_id = rk.member_id and itr.item_rank <= 3""",

    "monthly_member_spending": """
with mo as (select * from r_orders where cast(order_date as date) between date '2001-07-01' and date '2001-07-31'),
per as (
select m.member_id, m.name, m.email, m.points_balance, m.expiry_date, count(distinct o.order_id) as order_count,
  cast(coalesce(sum(oi.quantity * oi.unit_price), 0) as decimal(18,2)) as total_spent
from r_member m join mo o on o.member_id = m.member_id join r_order_item oi on oi.order_id = o.order_id
group by m.member_id, m.name, m.email, m.points_balance, m.expiry_date
order by total_spent desc, m.member_id limit 10),
rk as (select *, cast(row_number() over (order by total_spent desc, member_id) as integer) as member_rank from per),
fav as (select member_id, branch_name as fav_branch, visit_count as fav_visits from (
  select o.member_id, b.branch_name, count(o.order_id) as visit_count,
    row_number() over (partition by o.member_id order by count(o.order_id) desc, b.branch_name) as r
  from mo o join r_branch b on b.branch_id = o.branch_id group by o.member_id, b.branch_name) where r = 1),
pr as (select * from (
  select o.member_id, i.item_name, i.category, cast(sum(oi.quantity) as bigint) as total_qty,
    cast(sum(oi.quantity * oi.unit_price) as decimal(18,2)) as total_value,
    cast(row_number() over (partition by o.member_id order by sum(oi.quantity) desc, i.item_name, i.category) as integer) as product_rank
  from r_order_item oi join mo o on o.order_id = oi.order_id join r_item i on i.item_id = oi.item_id
  group by o.member_id, i.item_name, i.category) where product_rank <= 5)
select rk.member_rank, rk.member_id, rk.name, rk.email, rk.points_balance, rk.order_count, rk.total_spent,
  case when rk.expiry_date < date '2001-08-01' then 'EXPIRED' when rk.expiry_date < date '2001-08-01' + 30 then 'EXPIRING SOON' else 'ACTIVE' end as member_status,
  coalesce(fav.fav_branch, 'N/A') as fav_branch, cast(coalesce(fav.fav_visits, 0) as bigint) as fav_visits,
  pr.product_rank, pr.item_name, pr.category, pr.total_qty, pr.total_value,
  (select count(distinct member_id) from mo) as active_members
from rk left join fav on fav.member_id = rk.member_id left join pr on pr.member_id = rk.member_id""",

    "member_order_history": """
select o.member_id, o.order_id, o.order_date, o.order_type, i.item_id, i.item_name, oi.quantity, oi.unit_price,
  cast(oi.quantity * oi.unit_price as decimal(18,2)) as subtotal
from r_orders o join r_order_item oi on o.order_id = oi.order_id join r_item i on oi.item_id = i.item_id
where o.member_id is not null""",

    "member_point_activity": """
with d as (
select ph.*, m.name, m.points_balance,
  case when ph.transaction_type = 'Earned' then ph.amount else 0 end as e,
  case when ph.transaction_type = 'Used' then ph.amount else 0 end as u
from r_member m join r_point_history ph on ph.member_id = m.member_id
where ph.redemption_date >= date '2024-01-01' and ph.redemption_date < date '2024-01-15' + interval 1 day)
select 'DETAIL' as level, member_id, name, points_balance, point_redemption_id, redemption_date, transaction_type,
  cast(e as bigint) as earned, cast(u as bigint) as used, cast(e - u as bigint) as net, cast(1 as bigint) as transactions, cast(null as bigint) as members from d
union all
select 'MEMBER', member_id, max(name), max(points_balance), null, null, null, cast(sum(e) as bigint), cast(sum(u) as bigint),
  cast(sum(e) - sum(u) as bigint), count(*), null from d group by member_id
union all
select 'TOTAL', null, null, null, null, null, null, cast(sum(e) as bigint), cast(sum(u) as bigint), cast(sum(e) - sum(u) as bigint),
  count(*), count(distinct member_id) from d""",
}

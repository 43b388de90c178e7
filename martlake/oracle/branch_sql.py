"""Oracle SQL (DuckDB) for the branch, voucher, promotion and delivery operators."""

from martlake.oracle.sales_sql import ratio2

_REV = """select o.branch_id, cast(sum(oi.quantity * oi.unit_price) as decimal(18,2)) as total_revenue
from r_orders o join r_order_item oi on o.order_id = oi.order_id where o.order_date >= date '1999-08-01' group by o.branch_id"""

_AIC = """select item_id, cast(sum(unit_cost) as double) / count(unit_cost) as avg_unit_cost
from r_procurement where procurement_date >= date '1999-08-01' group by item_id"""

_COST = f"""select o.branch_id, round(sum(oi.quantity * aic.avg_unit_cost), 2) as total_cost
from r_orders o join r_order_item oi on o.order_id = oi.order_id join ({_AIC}) aic on oi.item_id = aic.item_id
where o.order_date >= date '1999-08-01' group by o.branch_id"""

_PROFIT = f"""
select b.branch_id, trim(regexp_replace(b.branch_name, 'Mart', '', 'gi')) as branch_loc,
  count(distinct o.order_id) as total_orders, br.total_revenue, bc.total_cost,
  round(cast(br.total_revenue as double) - bc.total_cost, 2) as net_profit,
  {ratio2('cast(br.total_revenue * 100 as bigint)', 'count(distinct o.order_id)')} as avg_order_val
from r_branch b join r_orders o on b.branch_id = o.branch_id
join ({_REV}) br on o.branch_id = br.branch_id
join ({_COST}) bc on o.branch_id = bc.branch_id
where o.order_date >= date '1999-08-01'
group by b.branch_id, b.branch_name, br.total_revenue, bc.total_cost
having round(cast(br.total_revenue as double) - bc.total_cost, 2) > 0"""

_VR = """
select r.voucher_id, count(distinct r.redemption_id) as redemption_count, count(distinct r.order_id) as order_count,
  cast(sum(oi.quantity * oi.unit_price) as decimal(18,2)) as total_sales
from r_redemption r join r_orders o on r.order_id = o.order_id join r_order_item oi on o.order_id = oi.order_id
where o.order_date >= date '1999-08-01'
group by r.voucher_id having count(distinct r.redemption_id) >= 10"""

_DCP = f"""
select cast(dc.company_id as bigint) as company_id, dc.company_name, count(d.delivery_id) as total_deliveries,
  cast(sum(case when d.delivery_status = 'Delivered' then 1 else 0 end) as bigint) as delivered,
  cast(sum(case when d.delivery_status = 'Out for Delivery' then 1 else 0 end) as bigint) as out_for_delivery,
  cast(sum(case when d.delivery_status = 'Pending' then 1 else 0 end) as bigint) as pending,
  cast(sum(case when d.delivery_status = 'Preparing' then 1 else 0 end) as bigint) as preparing,
  {ratio2("sum(case when d.delivery_status = 'Delivered' then 1 else 0 end) * 10000", 'count(d.delivery_id)')} as completion_rate
from r_delivery_company dc join r_delivery d on dc.company_id = d.company_id join r_orders o on d.order_id = o.order_id
where o.order_date >= date '2001-01-01' and o.order_date < date '2001-08-16' + interval 1 day
group by dc.company_id, dc.company_name"""

SQL = {
    "branch_staff_count": "select branch_id, count(staff_id) as staff_count from r_staff group by branch_id",

    "monthly_branch_sales": """
select cast(b.branch_id as bigint) as branch_id, b.branch_name, strftime(o.order_date, '%Y-%m') as month,
  cast(sum(oi.quantity * oi.unit_price) as decimal(18,2)) as monthly_sales, count(distinct o.order_id) as monthly_orders
from r_branch b join r_orders o on b.branch_id = o.branch_id join r_order_item oi on o.order_id = oi.order_id
group by b.branch_id, b.branch_name, strftime(o.order_date, '%Y-%m')""",

    "branch_efficiency": """
with sc as (select branch_id, count(staff_id) as staff_count from r_staff group by branch_id),
msv as (select b.branch_id, strftime(o.order_date, '%Y-%m') as month,
  sum(oi.quantity * oi.unit_price) as monthly_sales, count(distinct o.order_id) as monthly_orders
  from r_branch b join r_orders o on b.branch_id = o.branch_id join r_order_item oi on o.order_id = oi.order_id
  group by b.branch_id, strftime(o.order_date, '%Y-%m'))
select cast(b.branch_id as bigint) as branch_id, trim(regexp_replace(b.branch_name, 'Mart', '', 'gi')) as branch_location,
  sc.staff_count as headcount, cast(sum(msv.monthly_orders) as bigint) as total_orders,
  cast(sum(msv.monthly_sales) as decimal(18,2)) as total_sales,
  cast(sum(msv.monthly_sales) as double) / sc.staff_count as sales_per_staff
from r_branch b join sc on b.branch_id = sc.branch_id join msv on b.branch_id = msv.branch_id
where strptime(msv.month, '%Y-%m') >= date '1999-08-01'
group by b.branch_id, b.branch_name, sc.staff_count
having sum(msv.monthly_sales) > 1000 and sum(msv.monthly_orders) >= 10""",

    "branch_revenue": _REV,
    "branch_cost": _COST,
    "branch_profitability": _PROFIT,
    "branch_profit_ranked": f"""
select *, cast(row_number() over (order by net_profit desc, branch_id) as integer) as rank from ({_PROFIT}) v""",

    "company_summary": """
with l as (select o.branch_id, o.order_id, i.category, oi.quantity, oi.unit_price
  from r_orders o join r_order_item oi on oi.order_id = o.order_id join r_item i on i.item_id = oi.item_id),
cat as (select branch_id, category, count(distinct order_id) as order_count, cast(sum(quantity) as bigint) as total_qty,
  cast(sum(quantity * unit_price) as decimal(18,2)) as total_sales from l group by branch_id, category
  having sum(quantity * unit_price) > 0),
dord as (select l.branch_id, count(distinct l.order_id) as distinct_orders from l
  where exists (select 1 from cat where cat.branch_id = l.branch_id and cat.category = l.category) group by l.branch_id),
br as (select b.branch_id, b.branch_name, cast(coalesce(sum(c.order_count), 0) as bigint) as order_count,
  cast(coalesce(max(d.distinct_orders), 0) as bigint) as distinct_orders,
  cast(coalesce(sum(c.total_qty), 0) as bigint) as total_qty, cast(coalesce(sum(c.total_sales), 0) as decimal(18,2)) as total_sales
  from r_branch b left join cat c on c.branch_id = b.branch_id left join dord d on d.branch_id = b.branch_id
  group by b.branch_id, b.branch_name)
select 'CATEGORY' as level, c.branch_id, b.branch_name, c.category, c.order_count, cast(null as bigint) as distinct_orders,
  c.total_qty, c.total_sales from cat c join r_branch b on b.branch_id = c.branch_id
union all
select 'BRANCH', branch_id, branch_name, null, order_count, distinct_orders, total_qty, total_sales from br
union all
select 'TOTAL', null, null, null, cast(sum(order_count) as bigint), cast(sum(distinct_orders) as bigint),
  cast(sum(total_qty) as bigint), cast(sum(total_sales) as decimal(18,2)) from br""",

    "table_row_counts": """
select 'branch' as table_name, count(*) as row_count from r_branch union all select 'member', count(*) from r_member
union all select 'item', count(*) from r_item union all select 'supplier', count(*) from r_supplier
union all select 'staff', count(*) from r_staff union all select 'orders', count(*) from r_orders
union all select 'order_item', count(*) from r_order_item union all select 'procurement', count(*) from r_procurement
union all select 'branch_stock', count(*) from r_branch_stock union all select 'promotion', count(*) from r_promotion
union all select 'promotion_details', count(*) from r_promotion_details union all select 'voucher', count(*) from r_voucher
union all select 'redemption', count(*) from r_redemption union all select 'delivery_company', count(*) from r_delivery_company
union all select 'delivery', count(*) from r_delivery union all select 'self_pickup', count(*) from r_self_pickup
union all select 'point_history', count(*) from r_point_history""",

    "voucher_redemption": _VR,

    "voucher_effectiveness_top": f"""
select cast(row_number() over (order by vr.redemption_count desc, vr.total_sales desc, vo.voucher_id) as integer) as rank,
  vo.voucher_id, vo.voucher_type, vo.voucher_value, vr.redemption_count, vr.total_sales,
  {ratio2('cast(vr.total_sales * 100 as bigint)', 'vr.order_count')} as avg_order_value
from r_voucher vo join ({_VR}) vr on vo.voucher_id = vr.voucher_id
order by vr.redemption_count desc, vr.total_sales desc, vo.voucher_id limit 10""",

    "member_voucher_redemptions": """
select o.member_id, o.order_id, o.order_date, o.order_type, r.redemption_id, r.voucher_id, v.voucher_type, v.voucher_value,
  case when v.voucher_type = 'Amount' then 'RM ' || format('{:,.2f}', v.voucher_value)
       when v.voucher_type = 'Percentage' then format('{:,.2f}', v.voucher_value) || '%' end as voucher_label,
  r.redeemed_date
from r_orders o join r_redemption r on r.order_id = o.order_id join r_voucher v on r.voucher_id = v.voucher_id
where o.member_id is not null""",

    "promotion_lines": """
select p.promotion_id, p.promotion_name, p.status, p.start_date, p.end_date, pd.item_id, pd.discount_type, pd.discount_value
from r_promotion p join r_promotion_details pd on pd.promotion_id = p.promotion_id""",

    "active_promotions": """
select p.promotion_id, p.promotion_name, p.start_date, p.end_date, pd.item_id, pd.discount_type, pd.discount_value
from r_promotion_details pd join r_promotion p on pd.promotion_id = p.promotion_id
where timestamp '2001-08-01 00:00:00' between p.start_date and p.end_date""",

    "order_line_totals": """
select order_id, item_id, quantity, unit_price, cast(quantity * unit_price as decimal(18,2)) as line_total from r_order_item""",

    "order_member_points": """
select ph.member_id, ph.point_redemption_id, ph.amount, ph.transaction_type, ph.redemption_date
from r_point_history ph where ph.member_id in (select member_id from r_orders where member_id is not null)""",

    "delivery_company_performance": _DCP,

    "delivery_management_summary": f"""
with p as ({_DCP})
select cast(sum(total_deliveries) as bigint) as total_deliveries, cast(sum(delivered) as bigint) as delivered,
  {ratio2('sum(delivered) * 10000', 'sum(total_deliveries)')} as overall_rate,
  (select company_name from p order by completion_rate desc, total_deliveries desc, company_id limit 1) as best_company,
  (select completion_rate from p order by completion_rate desc, total_deliveries desc, company_id limit 1) as best_rate,
  (select company_name from p order by completion_rate asc, total_deliveries desc, company_id limit 1) as lowest_company,
  (select completion_rate from p order by completion_rate asc, total_deliveries desc, company_id limit 1) as lowest_rate
from p""",
}

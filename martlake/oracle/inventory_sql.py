"""Oracle SQL (DuckDB) for the inventory operators."""

_PREV_MONTH = "o.order_date >= date '2001-07-01' and o.order_date < date '2001-08-01'"

_TURNOVER_ITEM = f"""
with s as (select oi.item_id, cast(sum(oi.quantity) as bigint) as quantity_sold
           from r_order_item oi join r_orders o on oi.order_id = o.order_id where {_PREV_MONTH} group by oi.item_id),
pc as (select item_id, cast(sum(quantity * unit_cost) as double) / cast(nullif(sum(quantity), 0) as double) as weighted_avg_cost
       from r_procurement group by item_id),
bs as (select item_id, cast(sum(stock_quantity) as bigint) as current_stock from r_branch_stock group by item_id),
v as (
select i.item_id, i.item_name, i.category,
  coalesce(s.quantity_sold, 0) as quantity_sold,
  coalesce(s.quantity_sold, 0) * coalesce(pc.weighted_avg_cost, 0) as total_cogs,
  coalesce(bs.current_stock, 0) as current_stock,
  coalesce(bs.current_stock, 0) * coalesce(pc.weighted_avg_cost, 0) as inventory_value,
  case when coalesce(bs.current_stock, 0) = 0 or coalesce(pc.weighted_avg_cost, 0) = 0 then 0.0
       else (coalesce(s.quantity_sold, 0) * coalesce(pc.weighted_avg_cost, 0)) / (coalesce(bs.current_stock, 0) * coalesce(pc.weighted_avg_cost, 0)) end as turnover_ratio
from r_item i left join s on i.item_id = s.item_id left join pc on i.item_id = pc.item_id left join bs on i.item_id = bs.item_id)
"""

SQL = {
    "previous_month_item_sales": f"""
select oi.item_id, cast(sum(oi.quantity) as bigint) as quantity_sold
from r_order_item oi join r_orders o on oi.order_id = o.order_id where {_PREV_MONTH} group by oi.item_id""",

    "current_stock": "select item_id, cast(sum(stock_quantity) as bigint) as current_stock from r_branch_stock group by item_id",

    "inventory_turnover_by_item": _TURNOVER_ITEM + "select * from v",

    "inventory_turnover_by_category": _TURNOVER_ITEM + """
select category, cast(sum(quantity_sold) as bigint) as quantity_sold, round(sum(total_cogs), 2) as total_cogs,
  cast(sum(current_stock) as bigint) as current_stock, round(sum(inventory_value), 2) as inventory_value,
  case when sum(inventory_value) = 0 then 0.0 else round(sum(total_cogs) / sum(inventory_value), 4) end as turnover_ratio
from v where category in ('STANDARD', 'ECONOMY', 'MEDIUM', 'PROMO', 'LARGE', 'SMALL')
group by category having sum(quantity_sold) > 200""",

    "branch_stock_total": """
select branch_id, cast(sum(stock_quantity) as bigint) as total_stock from r_branch_stock group by branch_id having sum(stock_quantity) > 0""",

    "branch_stock_status": """
select bs.branch_id, i.item_id, i.item_name, i.category, bs.stock_quantity,
  upper(strftime(bs.last_restock_date, '%d-%b-%Y')) as last_restock_date,
  case when bs.stock_quantity < 50 then 'LOW STOCK' else 'OK' end as stock_status
from r_branch_stock bs join r_item i on i.item_id = bs.item_id
order by bs.stock_quantity asc nulls last, i.item_id, bs.branch_id""",

    "branch_stock_by_category": """
select bs.branch_id, i.category, count(i.item_id) as item_count, cast(sum(bs.stock_quantity) as bigint) as total_qty,
  round(cast(sum(bs.stock_quantity) as double) / count(bs.stock_quantity), 2) as avg_qty
from r_branch_stock bs join r_item i on i.item_id = bs.item_id
group by bs.branch_id, i.category having sum(bs.stock_quantity) > 0""",

    "branch_stock_summary": """
select b.branch_id, b.branch_name, sv.total_stock from r_branch b
join (select branch_id, cast(sum(stock_quantity) as bigint) as total_stock from r_branch_stock group by branch_id having sum(stock_quantity) > 0) sv
  on sv.branch_id = b.branch_id
where sv.total_stock >= 39000""",

    "item_stock_distribution": """
select bs.item_id, b.branch_id, b.branch_name, cast(sum(bs.stock_quantity) as bigint) as branch_total
from r_branch_stock bs join r_branch b on b.branch_id = bs.branch_id
group by bs.item_id, b.branch_id, b.branch_name having sum(bs.stock_quantity) >= 0""",

    "branch_stock_in_out": """
with si as (select branch_id, item_id, cast(sum(quantity) as bigint) as total_in from r_procurement group by branch_id, item_id having sum(quantity) >= 0),
so as (select o.branch_id, oi.item_id, cast(sum(oi.quantity) as bigint) as total_out from r_orders o join r_order_item oi on oi.order_id = o.order_id
       group by o.branch_id, oi.item_id having sum(oi.quantity) >= 0)
select bs.branch_id, bs.item_id, i.item_name, coalesce(si.total_in, 0) as total_in, coalesce(so.total_out, 0) as total_out,
  bs.stock_quantity, upper(strftime(bs.last_restock_date, '%d-%b-%Y')) as last_restock_date
from r_branch_stock bs join r_item i on i.item_id = bs.item_id
left join si on si.branch_id = bs.branch_id and si.item_id = bs.item_id
left join so on so.branch_id = bs.branch_id and so.item_id = bs.item_id""",

    "stock_reorder": """
with d as (
select b.branch_id, b.branch_name, i.item_id, i.item_name, i.category, bs.stock_quantity, bs.last_restock_date,
  (select sum(cast(p.unit_cost * 100 as bigint)) from r_procurement p where p.item_id = i.item_id) as sc,
  (select count(p.unit_cost) from r_procurement p where p.item_id = i.item_id) as n
from r_branch_stock bs join r_item i on i.item_id = bs.item_id join r_branch b on b.branch_id = bs.branch_id
where bs.stock_quantity < 15),
d2 as (select *, coalesce(cast(sc as double) / n, 0) as est_unit_price_d,
  (15 - stock_quantity) * coalesce(cast(sc as double) / n, 0) as est_cost,
  coalesce(cast(sign(sc) * floor((2 * abs(sc) + n) / (2 * n)) as decimal(18,0)) * 0.01, 0) as row_price,
  coalesce(cast(sign((15 - stock_quantity) * sc) * floor((2 * abs((15 - stock_quantity) * sc) + n) / (2 * n)) as decimal(18,0)) * 0.01, 0) as row_cost,
  case when stock_quantity = 0 then 'CRITICAL' when stock_quantity <= 15 / 2 then 'HIGH' else 'MEDIUM' end as urgency from d)
select 'ITEM' as level, branch_id, branch_name, item_id, item_name, category, stock_quantity,
  upper(strftime(last_restock_date, '%d-%b-%Y')) as last_restock_date, cast(row_price as decimal(18,2)) as est_unit_price, urgency,
  cast(row_cost as decimal(18,2)) as est_cost, cast(1 as bigint) as alert_count from d2
union all
select 'BRANCH', branch_id, max(branch_name), null, null, null, null, null, null, null, cast(round(sum(est_cost), 2) as decimal(18,2)), count(*) from d2 group by branch_id
union all
select 'TOTAL', null, null, null, null, null, null, null, null, null, cast(round(sum(est_cost), 2) as decimal(18,2)), count(*) from d2""",

    "branch_stock_listing": """
select b.branch_id, b.branch_name, case when s.item_id is null then 'NO STOCK' else 'OK' end as status,
  s.item_id, s.item_name, s.category, s.unit_price, s.stock_quantity
from r_branch b left join (select bs.branch_id, i.item_id, i.item_name, i.category, i.unit_price, bs.stock_quantity
  from r_branch_stock bs join r_item i on i.item_id = bs.item_id) s on s.branch_id = b.branch_id""",
}

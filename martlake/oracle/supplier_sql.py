"""Oracle SQL (DuckDB) for the supplier operators; parameters as registered in the catalog."""

SQL = {
    "supplier_performance": """
select s.supplier_id, s.supplier_name,
  count(distinct p.item_id) as total_items_supplied,
  count(distinct p.branch_id) as branches_supplied,
  cast(sum(p.quantity) as bigint) as total_quantity_supplied,
  cast(sum(p.quantity * p.unit_cost) as decimal(18,2)) as total_procurement_cost,
  cast(sum(p.unit_cost) as double) / count(p.unit_cost) as average_unit_cost
from r_supplier s join r_procurement p on s.supplier_id = p.supplier_id
join r_item i on p.item_id = i.item_id join r_branch b on p.branch_id = b.branch_id
where p.quantity > 0
group by s.supplier_id, s.supplier_name
having sum(p.quantity * p.unit_cost) > 0""",

    "supplier_performance_ranked": """
select *, cast(rank() over (order by total_procurement_cost desc) as integer) as procurement_rank from (
select s.supplier_id, s.supplier_name,
  count(distinct p.item_id) as total_items_supplied,
  count(distinct p.branch_id) as branches_supplied,
  cast(sum(p.quantity) as bigint) as total_quantity_supplied,
  cast(sum(p.quantity * p.unit_cost) as decimal(18,2)) as total_procurement_cost,
  cast(sum(p.unit_cost) as double) / count(p.unit_cost) as average_unit_cost
from r_supplier s join r_procurement p on s.supplier_id = p.supplier_id
join r_item i on p.item_id = i.item_id join r_branch b on p.branch_id = b.branch_id
where p.quantity > 0
group by s.supplier_id, s.supplier_name
having sum(p.quantity * p.unit_cost) > 0) v""",

    "supplier_procurement_summary": """
with perf as (
select s.supplier_id, s.supplier_name,
  count(distinct p.item_id) as total_items_supplied,
  count(distinct p.branch_id) as branches_supplied,
  cast(sum(p.quantity) as bigint) as total_quantity_supplied,
  cast(sum(p.quantity * p.unit_cost) as decimal(18,2)) as total_procurement_cost
from r_supplier s join r_procurement p on s.supplier_id = p.supplier_id
join r_item i on p.item_id = i.item_id join r_branch b on p.branch_id = b.branch_id
where p.quantity > 0
group by s.supplier_id, s.supplier_name
having sum(p.quantity * p.unit_cost) > 0)
select 'SUPPLIER' as row_type, cast(row_number() over (order by total_procurement_cost desc, supplier_id) as integer) as rank,
  supplier_id, supplier_name, total_items_supplied, branches_supplied, total_quantity_supplied, total_procurement_cost
from perf
union all
select 'TOTAL', null, null, null, null, null, null, cast(sum(total_procurement_cost) as decimal(18,2)) from perf""",

    "weighted_avg_cost": """
select item_id, cast(sum(quantity * unit_cost) as double) / cast(nullif(sum(quantity), 0) as double) as weighted_avg_cost
from r_procurement group by item_id""",

    "avg_item_cost": """
select item_id, cast(sum(unit_cost) as double) / count(unit_cost) as avg_unit_cost
from r_procurement where procurement_date >= date '1999-08-01' group by item_id""",

    "supplier_comparison": """
select p.item_id, p.supplier_id, s.supplier_name, count(p.procurement_id) as times_ordered,
  cast(sum(p.quantity) as bigint) as total_quantity,
  round(cast(sum(p.unit_cost) as double) / count(p.unit_cost), 2) as avg_unit_cost
from r_procurement p join r_supplier s on s.supplier_id = p.supplier_id
group by p.item_id, p.supplier_id, s.supplier_name""",

    "procurement_comparison": """
with agg as (
select p.item_id, s.supplier_id, s.supplier_name, count(p.procurement_id) as times_ordered,
  cast(sum(p.quantity) as bigint) as total_quantity_supplied,
  round(cast(sum(p.unit_cost) as double) / count(p.unit_cost), 2) as avg_unit_cost,
  cast(sum(p.quantity * p.unit_cost) as decimal(18,2)) as total_spent
from r_procurement p join r_supplier s on s.supplier_id = p.supplier_id
group by p.item_id, s.supplier_id, s.supplier_name)
select a.item_id, i.item_name,
  cast(row_number() over (partition by a.item_id order by a.avg_unit_cost asc nulls last, a.supplier_id) as integer) as supplier_rank,
  a.supplier_id, a.supplier_name, a.times_ordered, a.total_quantity_supplied, a.avg_unit_cost, a.total_spent
from agg a join r_item i on i.item_id = a.item_id
where exists (select 1 from r_procurement p where p.item_id = i.item_id)""",

    # the view's fan-out rows are counted, grouped per (supplier, item, month)
    "supplier_item_sales_monthly": """
select s.supplier_id, s.supplier_name, i.item_id, i.item_name, i.category, strftime(o.order_date, '%Y-%m') as month,
  count(distinct p.procurement_id) as procurement_rows,
  count(*) as view_rows,
  cast(sum(oi.quantity) as bigint) as quantity,
  cast(sum(oi.quantity * oi.unit_price) as decimal(18,2)) as sales
from r_supplier s join r_procurement p on s.supplier_id = p.supplier_id
join r_item i on p.item_id = i.item_id
join r_order_item oi on i.item_id = oi.item_id
join r_orders o on oi.order_id = o.order_id
group by s.supplier_id, s.supplier_name, i.item_id, i.item_name, i.category, strftime(o.order_date, '%Y-%m')""",

    "supplier_item_sales": """
select s.supplier_id, s.supplier_name, i.category,
  cast(sum(oi.quantity) as bigint) as quantity_sold,
  cast(sum(oi.quantity * oi.unit_price) as decimal(18,2)) as total_sales
from r_supplier s join r_procurement p on s.supplier_id = p.supplier_id
join r_item i on p.item_id = i.item_id
join r_order_item oi on i.item_id = oi.item_id
join r_orders o on oi.order_id = o.order_id
where o.order_date >= date '2001-07-01' and o.order_date < date '2001-08-01'
group by s.supplier_id, s.supplier_name, i.category
having sum(oi.quantity) > 20""",
}

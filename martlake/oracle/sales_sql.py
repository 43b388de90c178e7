"""Oracle SQL (DuckDB) for the sales operators."""

_RATIO2 = "cast(sign({n}) * floor((2 * abs({n}) + {d}) / (2 * {d})) as decimal(18,0)) * 0.01"


def ratio2(n: str, d: str) -> str:
    """Exact ROUND(n/d, 2) for n in cents (same rule as functions.money.round_ratio)."""
    return "cast(" + _RATIO2.format(n=n, d=d) + " as decimal(18,2))"


_TREND = f"""
select cast(extract(year from o.order_date) as integer) as sales_year, o.order_type,
  count(distinct o.order_id) as total_orders,
  cast(sum(oi.quantity * oi.unit_price) as decimal(18,2)) as revenue,
  {ratio2('cast(sum(oi.quantity * oi.unit_price) * 100 as bigint)', 'count(distinct o.order_id)')} as avg_order_value,
  count(distinct o.branch_id) as branches_served
from r_orders o join r_order_item oi on o.order_id = oi.order_id
group by extract(year from o.order_date), o.order_type"""

_ITEM_WINDOW = f"""
select oi.item_id, cast(sum(oi.quantity) as bigint) as total_quantity,
  cast(sum(oi.quantity * oi.unit_price) as decimal(18,2)) as total_sales,
  {ratio2('sum(cast(oi.unit_price * 100 as bigint))', 'count(oi.unit_price)')} as avg_unit_price
from r_order_item oi join r_orders o on oi.order_id = o.order_id
where o.order_date >= date '1999-08-01'
group by oi.item_id having sum(oi.quantity) > 0"""

_PAIRS = """
select oi1.item_id as item_a, ia.item_name as item_a_name, oi2.item_id as item_b, ib.item_name as item_b_name,
  count(distinct oi1.order_id) as times_together
from r_order_item oi1
join r_order_item oi2 on oi1.order_id = oi2.order_id and oi1.item_id < oi2.item_id
join r_item ia on ia.item_id = oi1.item_id
join r_item ib on ib.item_id = oi2.item_id
group by oi1.item_id, ia.item_name, oi2.item_id, ib.item_name
having count(distinct oi1.order_id) >= {min_support}"""

SQL = {
    "item_sales_totals": """
select i.item_id, i.item_name, i.category,
  cast(coalesce(sum(oi.quantity), 0) as bigint) as total_units_sold,
  cast(coalesce(sum(oi.quantity * oi.unit_price), 0) as decimal(18,2)) as total_revenue,
  count(distinct oi.order_id) as times_ordered
from r_item i left join r_order_item oi on i.item_id = oi.item_id
group by i.item_id, i.item_name, i.category""",

    "top_selling_items": """
select v.*, i.unit_price as current_price from (
select i.item_id, i.item_name, i.category,
  cast(coalesce(sum(oi.quantity), 0) as bigint) as total_units_sold,
  cast(coalesce(sum(oi.quantity * oi.unit_price), 0) as decimal(18,2)) as total_revenue,
  count(distinct oi.order_id) as times_ordered
from r_item i left join r_order_item oi on i.item_id = oi.item_id
group by i.item_id, i.item_name, i.category
order by total_units_sold desc, i.item_id limit 10) v join r_item i on v.item_id = i.item_id""",

    "order_channel_trend": _TREND,

    "order_channel_trend_latest": f"""
select v.*, strftime(max(o.order_date), '%d-%m-%Y') as latest_order
from ({_TREND}) v join r_orders o on cast(extract(year from o.order_date) as integer) = v.sales_year and o.order_type = v.order_type
group by all""",

    "item_sales_window": _ITEM_WINDOW,

    "item_price_sales_top": f"""
select cast(row_number() over (order by v.total_sales desc, v.total_quantity desc, v.item_id) as integer) as rank, v.*
from (select isv.*, i.item_name, i.category from r_item i join ({_ITEM_WINDOW}) isv on i.item_id = isv.item_id
      order by isv.total_sales desc, isv.total_quantity desc, isv.item_id limit 10) v""",

    "item_pair_frequency": _PAIRS.format(min_support=2),

    "top_item_pairs_with_stock": f"""
select v.item_a, v.item_a_name, v.item_b, v.item_b_name, v.times_together,
  sa.total_qty as item_a_stock, sb.total_qty as item_b_stock
from ({_PAIRS.format(min_support=5)}) v
join (select item_id, cast(sum(stock_quantity) as bigint) as total_qty from r_branch_stock group by item_id) sa on sa.item_id = v.item_a
join (select item_id, cast(sum(stock_quantity) as bigint) as total_qty from r_branch_stock group by item_id) sb on sb.item_id = v.item_b
order by v.times_together desc, v.item_a, v.item_b limit 20""",

    "category_sales_summary": """
with d as (
select i.category, i.item_id, i.item_name, cast(coalesce(sum(oi.quantity), 0) as bigint) as units,
  cast(coalesce(sum(oi.quantity * oi.unit_price), 0) as decimal(18,2)) as revenue
from r_item i left join r_order_item oi on i.item_id = oi.item_id
group by i.category, i.item_id, i.item_name)
select 'ITEM' as level, category, item_id, item_name, units, revenue, cast(1 as bigint) as item_count from d
union all
select 'CATEGORY', category, null, null, cast(sum(units) as bigint), cast(sum(revenue) as decimal(18,2)), count(*) from d group by category""",

    "promotion_performance": """
with s as (
select oi.item_id, sum(oi.quantity) as q, sum(oi.quantity * oi.unit_price) as r, count(*) as n
from r_order_item oi join r_orders o on oi.order_id = o.order_id
where o.order_date >= date '2001-07-01' and o.order_date < date '2001-07-31' + interval 1 day
group by oi.item_id),
d as (
select p.promotion_id, p.promotion_name, p.status, p.start_date, p.end_date, pd.item_id, i.item_name, pd.discount_type, pd.discount_value,
  cast(coalesce(s.q, 0) as bigint) as quantity_sold, cast(coalesce(s.r, 0) as decimal(18,2)) as sales_revenue,
  cast(coalesce(s.n, 0) as bigint) as order_lines
from r_promotion p join r_promotion_details pd on pd.promotion_id = p.promotion_id
join r_item i on pd.item_id = i.item_id left join s on s.item_id = pd.item_id)
select 'ITEM' as level, * from d
union all
select 'PROMOTION', p.promotion_id, p.promotion_name, p.status, p.start_date, p.end_date, null, null, null, null,
  cast(coalesce(sum(d.quantity_sold), 0) as bigint), cast(coalesce(sum(d.sales_revenue), 0) as decimal(18,2)),
  cast(coalesce(sum(d.order_lines), 0) as bigint)
from r_promotion p left join d on d.promotion_id = p.promotion_id
group by p.promotion_id, p.promotion_name, p.status, p.start_date, p.end_date""",
}

"""Oracle SQL (DuckDB) for the batch jobs whose outcome does not depend on a sequential fold."""

_PRICE = """
with lc as (select item_id, arg_max(unit_cost, (procurement_date, procurement_id)) as latest_cost from r_procurement group by item_id),
r as (select q.*, lc.latest_cost,
  case when i.item_id is null then '-20012' when q.new_price < 0 then '-20010'
       when lc.latest_cost is not null and q.new_price < lc.latest_cost then '-20011' end as code
  from q_price q left join r_item i on i.item_id = q.item_id left join lc on lc.item_id = q.item_id)"""

_RECEIVE = """
with r as (select p.procurement_id as req_id, p.*,
  case when p.quantity <= 0 then '-20020' when p.unit_cost < 0 then '-20021'
       when i.item_id is null or s.supplier_id is null or b.branch_id is null then 'NOT_FOUND' end as code
  from r_procurement p left join r_item i on i.item_id = p.item_id left join r_supplier s on s.supplier_id = p.supplier_id
  left join r_branch b on b.branch_id = p.branch_id),
d as (select branch_id, item_id, sum(quantity) as dq from r where code is null group by branch_id, item_id)"""

_PICKUP = """
with r as (
  select q.*, o.order_type, sp.order_id as sp_order,
    case when q.order_id is null then 'IGNORED'
         when q.new_status not in ('Preparing', 'Ready', 'Completed', 'Expired', 'Rescheduled') then '-20638'
         when o.order_id is null then '-20641' when lower(o.order_type) != 'self pickup' then '-20639'
         when sp.order_id is null then '-20641'
         when q.new_status = 'Rescheduled' and q.reschedule_date < q.req_ts then '-20003' end as scode
  from q_pickup q left join r_orders o on o.order_id = q.order_id left join r_self_pickup sp on sp.order_id = q.order_id),
ok as (select *, case when new_status = 'Ready' then req_ts + interval 3 day
                     when new_status = 'Rescheduled' then coalesce(reschedule_date, req_ts + interval 3 day) end as sets from r where scode is null),
ok2 as (select *, last_value(sets ignore nulls) over (partition by order_id order by req_ts, req_id
          rows between unbounded preceding and 1 preceding) as exp_in_force from ok),
dec as (select req_id, scode as code from r where scode is not null
  union all select req_id, case when new_status = 'Completed' and exp_in_force is not null and req_ts > exp_in_force then '-20640' end from ok2)"""

_REDEEM = """
with hist as (select distinct r.voucher_id, o.member_id from r_redemption r join r_orders o on o.order_id = r.order_id where o.member_id is not null),
r as (
  select q.*, o.member_id as owner, coalesce(o.order_date > v.exp_date, false) as dated_after,
    case when v.voucher_id is null then '-20043' when v.exp_date < date '2001-08-01' then '-20040'
         when m.member_id is null then '-20041' when o.order_id is null then '-20043'
         when o.member_id is not null and o.member_id <> q.member_id then '-20042'
         when h.voucher_id is not null then '-20044'
         when exists (select 1 from r_redemption x where x.voucher_id = q.voucher_id and x.order_id = q.order_id) then '-20031' end as scode
  from q_redeem q left join r_voucher v on v.voucher_id = q.voucher_id left join r_member m on m.member_id = q.member_id
  left join r_orders o on o.order_id = q.order_id left join hist h on h.voucher_id = q.voucher_id and h.member_id = q.member_id),
taken as (select a.req_id as later_id, min(a.owner) as owner from r a join r b on b.voucher_id = a.voucher_id
            and (b.owner = a.owner or (a.owner is null and b.owner is null and b.order_id = a.order_id))
            and (b.req_ts, b.req_id) < (a.req_ts, a.req_id)
          where a.scode is null and b.scode is null and not b.dated_after group by a.req_id),
dec as (
  select r.req_id, case when scode is not null then scode when t.later_id is not null and r.owner is not null then '-20044'
                        when t.later_id is not null then '-20031' when dated_after then '-20032' end as code
  from r left join taken t on t.later_id = r.req_id)"""

SQL = {
    "update_item_prices": _PRICE + "\nselect req_id, code is null as accepted, code from r",

    "update_item_prices_snapshot": _PRICE + """
, last as (select item_id, arg_max(new_price, (req_ts, req_id)) as np from r where code is null group by item_id)
select i.item_id, i.item_name, i.category, cast(coalesce(last.np, i.unit_price) as decimal(8,2)) as unit_price
from r_item i left join last on last.item_id = i.item_id""",

    "receive_procurements": _RECEIVE + "\nselect req_id, code is null as accepted, code from r",

    "receive_procurements_snapshot": _RECEIVE + """
select coalesce(bs.branch_id, d.branch_id) as branch_id, coalesce(bs.item_id, d.item_id) as item_id,
  cast(coalesce(bs.stock_quantity, 0) + coalesce(d.dq, 0) as bigint) as stock_quantity,
  case when d.dq is not null then date '2001-08-01' else bs.last_restock_date end as last_restock_date
from r_branch_stock bs full outer join d on d.branch_id = bs.branch_id and d.item_id = bs.item_id""",

    "redeem_vouchers": _REDEEM + "\nselect req_id, code is null as accepted, code from dec",

    "redeem_vouchers_new": _REDEEM + """
select q.req_id as redemption_id, q.voucher_id, q.order_id, q.req_ts as redeemed_date
from q_redeem q join dec on dec.req_id = q.req_id where dec.code is null""",

    "price_order_lines": """
with l as (select oi.order_id, oi.item_id, oi.quantity, o.order_date as priced_at, i.unit_price as price
  from r_order_item oi join r_orders o on o.order_id = oi.order_id join r_item i on i.item_id = oi.item_id),
c as (select l.order_id, l.item_id, arg_max((pd.discount_type, pd.discount_value), (cast(p.start_date as timestamp), p.promotion_id)) as best
  from l join r_promotion_details pd on pd.item_id = l.item_id join r_promotion p on p.promotion_id = pd.promotion_id
  where cast(p.start_date as timestamp) <= l.priced_at and l.priced_at <= cast(p.end_date as timestamp)
  group by l.order_id, l.item_id)
select l.order_id, l.item_id, l.quantity,
  cast(round(greatest(case when c.best[1] = 'Percentage' then l.price * (100 - c.best[2]) * 0.01
                           when c.best[1] = 'Amount' then l.price - c.best[2] else l.price end, 0), 2) as decimal(8,2)) as unit_price
from l left join c on c.order_id = l.order_id and c.item_id = l.item_id""",

    "award_points": """
select o.order_id, o.member_id, cast(floor(sum(oi.quantity * oi.unit_price)) as bigint) as amount, 'Earned' as transaction_type,
  o.order_date as redemption_date
from r_orders o join r_order_item oi on oi.order_id = o.order_id left join r_member m on m.member_id = o.member_id
where o.member_id is not null and o.order_id not in (select order_id from r_redemption)
  and (m.expiry_date is null or m.expiry_date >= cast(o.order_date as date))
group by o.order_id, o.member_id, o.order_date
having sum(oi.quantity * oi.unit_price) > 0 and floor(sum(oi.quantity * oi.unit_price)) > 0""",

    "apply_pickup_updates": _PICKUP + "\nselect req_id, code is null as accepted, code from dec",

    "apply_pickup_updates_snapshot": _PICKUP + """
, eff as (select o.*, d.code, case when d.code = '-20640' then 'Expired' else o.new_status end as st
  from ok2 o join dec d on d.req_id = o.req_id),
last as (select order_id, arg_max(st, (req_ts, req_id)) as st,
  arg_max(sets, (sets is not null, req_ts, req_id)) as lastset,
  max(case when new_status = 'Completed' and code is null then req_ts end) as done
  from eff group by order_id)
select sp.pickup_id, sp.order_id, last.done as pickup_datetime, coalesce(last.st, sp.pickup_status) as pickup_status,
  last.lastset as pickup_exp_date
from r_self_pickup sp left join last on last.order_id = sp.order_id""",
}

# A recursive CTE walks each item's transfers in order, carrying the item's stock per
# branch as a MAP (branch -> units); an accepted transfer rewrites two entries.
_TRANSFER = """
with recursive r as (
  select q.*, case when q.from_branch = q.to_branch then '-20010' when q.quantity <= 0 then '-20011'
    when i.item_id is null or bf.branch_id is null or bt.branch_id is null then 'NOT_FOUND' end as scode
  from q_transfer q left join r_item i on i.item_id = q.item_id
  left join r_branch bf on bf.branch_id = q.from_branch left join r_branch bt on bt.branch_id = q.to_branch),
ev as (select *, row_number() over (partition by item_id order by req_ts, req_id) as rn from r where scode is null),
op as (select item_id, map(list(cast(branch_id as bigint)), list(cast(stock_quantity as bigint))) as m
       from r_branch_stock group by item_id),
f(item_id, rn, m, req_id, code) as (
  select e.item_id, 0, coalesce(op.m, cast(map() as map(bigint, bigint))), cast(null as bigint), cast(null as varchar)
  from (select distinct item_id from ev) e left join op on op.item_id = e.item_id
  union all
  select f.item_id, ev.rn,
    case when not map_contains(f.m, ev.from_branch) or f.m[ev.from_branch] < ev.quantity then f.m
         else map_concat(f.m, map([ev.from_branch, ev.to_branch],
                                  [f.m[ev.from_branch] - ev.quantity, coalesce(f.m[ev.to_branch], 0) + ev.quantity])) end,
    ev.req_id,
    case when not map_contains(f.m, ev.from_branch) then '-20012' when f.m[ev.from_branch] < ev.quantity then '-20013' end
  from f join ev on ev.item_id = f.item_id and ev.rn = f.rn + 1)"""

SQL["transfer_stock"] = _TRANSFER + """
select req_id, code is null as accepted, code from (
  select req_id, scode as code from r where scode is not null
  union all select req_id, code from f where rn > 0)"""

SQL["transfer_stock_snapshot"] = _TRANSFER + """
, last as (select item_id, m from (select *, row_number() over (partition by item_id order by rn desc) as k from f) where k = 1),
got as (select distinct ev.item_id, ev.to_branch as branch_id from f join ev on ev.req_id = f.req_id where f.rn > 0 and f.code is null),
cells as (select item_id, unnest(map_keys(m)) as branch_id, unnest(map_values(m)) as stock_quantity from last)
select c.branch_id, cast(c.item_id as bigint) as item_id, c.stock_quantity,
  case when got.item_id is not null then date '2024-01-31' else bs.last_restock_date end as last_restock_date
from cells c left join r_branch_stock bs on bs.branch_id = c.branch_id and bs.item_id = c.item_id
left join got on got.branch_id = c.branch_id and got.item_id = c.item_id
union all
select cast(bs.branch_id as bigint), cast(bs.item_id as bigint), cast(bs.stock_quantity as bigint), bs.last_restock_date
from r_branch_stock bs where bs.item_id not in (select item_id from last)"""

# W11 over the stored orders: a recursive CTE walks each branch's orders in (req_ts, req_id)
# order, carrying the branch's stock per item as a MAP; an order's lines are lists checked
# with lambdas (first failing line in line order), an accepted order rewrites its items.
# The member table carries no address, so a Delivery order without one falls to -20010.
# A voucher is spent by an accepted order, of any branch: the walk goes through all orders.
_PLACE = """
with recursive hdr as (
  select o.order_id as req_id, o.order_date as req_ts, o.member_id, o.staff_id, o.branch_id, o.order_type, fr.voucher_id,
    case when o.order_id % 7 > 0 then 'Addr ' || o.order_id end as address
  from r_orders o left join (select order_id, arg_min(voucher_id, (redeemed_date, redemption_id)) as voucher_id
                             from r_redemption group by order_id) fr on fr.order_id = o.order_id),
ln as (select order_id as req_id, item_id as line_no, item_id, quantity from r_order_item),
nl as (select req_id, count(*) as n from ln group by req_id),
hist as (select distinct r.voucher_id, o.member_id from r_redemption r join r_orders o on o.order_id = r.order_id
         where o.member_id is not null),
h0 as (
  select hdr.*,
    case when coalesce(nl.n, 0) = 0 then '-20006'
         when hdr.member_id is null and hdr.order_type in ('Delivery', 'Self Pickup') then '-20008'
         when hdr.member_id is null and hdr.voucher_id is not null then '-20009' end as early,
    case when m.expiry_date < cast(hdr.req_ts as date) then '-20030' when hdr.order_type = 'Delivery' and hdr.address is null then '-20010'
         when hdr.voucher_id is not null and v.voucher_id is null then '-20043'
         when hdr.voucher_id is not null and v.exp_date < date '2001-08-01' then '-20040'
         when hdr.voucher_id is not null and m.member_id is null then '-20041'
         when hdr.voucher_id is not null and hi.voucher_id is not null then '-20044' end as late0
  from hdr left join nl on nl.req_id = hdr.req_id left join r_voucher v on v.voucher_id = hdr.voucher_id
  left join r_member m on m.member_id = hdr.member_id
  left join hist hi on hi.voucher_id = hdr.voucher_id and hi.member_id = hdr.member_id),
h as (
  select h0.*, coalesce(late0, case when early is null and late0 is null and voucher_id is not null
    and row_number() over (partition by early is null and late0 is null and voucher_id is not null, voucher_id, member_id
                           order by req_ts, req_id) > 1 then '-20044' end) as late
  from h0),
ordl as (select h.req_id, h.branch_id, h.req_ts, h.late, list(ln.item_id order by ln.line_no) as items,
           list(cast(ln.quantity as bigint) order by ln.line_no) as qtys
         from h join ln on ln.req_id = h.req_id where h.early is null group by h.req_id, h.branch_id, h.req_ts, h.late),
ev as (select *, row_number() over (partition by branch_id order by req_ts, req_id) as rn from ordl),
op as (select branch_id, map(list(item_id), list(cast(stock_quantity as bigint))) as m from r_branch_stock group by branch_id),
f(branch_id, rn, m, req_id, code) as (
  select e.branch_id, 0, coalesce(op.m, cast(map() as map(bigint, bigint))), cast(null as bigint), cast(null as varchar)
  from (select distinct branch_id from ev) e left join op on op.branch_id = e.branch_id
  union all
  select f.branch_id, ev.rn,
    case when coalesce(list_filter(list_transform(ev.items, lambda x, i: case when not map_contains(f.m, x) then '-20002'
                                     when f.m[x] < ev.qtys[i] then '-20001' end), lambda c: c is not null)[1], ev.late) is null
         then map_concat(f.m, map(ev.items, list_transform(ev.items, lambda x, i: f.m[x] - ev.qtys[i])))
         else f.m end,
    ev.req_id,
    coalesce(list_filter(list_transform(ev.items, lambda x, i: case when not map_contains(f.m, x) then '-20002'
                           when f.m[x] < ev.qtys[i] then '-20001' end), lambda c: c is not null)[1], ev.late)
  from f join ev on ev.branch_id = f.branch_id and ev.rn = f.rn + 1),
dec as (select req_id, early as code from h where early is not null
        union all select req_id, code from f where rn > 0)"""

SQL["place_orders"] = _PLACE + "\nselect cast(req_id as bigint) as req_id, code is null as accepted, code from dec"

SQL["place_orders_snapshot"] = _PLACE + """
, moved as (select h.branch_id, ln.item_id, sum(ln.quantity) as q from dec join h on h.req_id = dec.req_id
            join ln on ln.req_id = dec.req_id where dec.code is null group by h.branch_id, ln.item_id)
select bs.branch_id, bs.item_id, cast(bs.stock_quantity - coalesce(moved.q, 0) as bigint) as stock_quantity, bs.last_restock_date
from r_branch_stock bs left join moved on moved.branch_id = bs.branch_id and moved.item_id = bs.item_id"""

SQL["place_orders_low_stock_alerts"] = _PLACE + """
, acc as (select h.branch_id, h.req_id, h.req_ts, ln.item_id, ln.line_no, ln.quantity from dec join h on h.req_id = dec.req_id
          join ln on ln.req_id = dec.req_id where dec.code is null),
run as (select acc.*, bs.stock_quantity - sum(acc.quantity) over (partition by acc.branch_id, acc.item_id
          order by acc.req_ts, acc.req_id, acc.line_no rows between unbounded preceding and current row) as stock_after
        from acc join r_branch_stock bs on bs.branch_id = acc.branch_id and bs.item_id = acc.item_id)
select branch_id, item_id, req_id as order_id, req_ts as order_date, cast(stock_after as bigint) as stock_after
from run where stock_after < 20"""

_ACCEPTED = ", a as (select h.* from dec join h on h.req_id = dec.req_id where dec.code is null)"

SQL["place_orders_orders"] = _PLACE + _ACCEPTED + """
select req_id as order_id, member_id, staff_id, branch_id, req_ts as order_date, order_type from a"""

SQL["place_orders_pickups"] = _PLACE + _ACCEPTED + """
select req_id as pickup_id, req_id as order_id, cast(null as timestamp) as pickup_datetime, 'Preparing' as pickup_status,
  cast(null as timestamp) as pickup_exp_date from a where order_type = 'Self Pickup'"""

SQL["place_orders_deliveries"] = _PLACE + _ACCEPTED + """
, couriers as (select company_id, row_number() over (order by company_id) - 1 as i, count(*) over () as n from r_delivery_company)
select req_id as delivery_id, req_id as order_id, c.company_id, a.address as delivery_address, cast(null as timestamp) as delivery_date,
  'Preparing' as delivery_status from a join couriers c on a.req_id % c.n = c.i where a.order_type = 'Delivery'"""

SQL["place_orders_order_lines"] = _PLACE + _ACCEPTED + ", p as (" + SQL["price_order_lines"] + """)
select p.* from p join a on a.req_id = p.order_id"""

SQL["receive_procurements_new"] = _RECEIVE + """
select req_id as procurement_id, item_id, supplier_id, branch_id, quantity, unit_cost, date '2001-08-01' as procurement_date
from r where code is null"""

# S04 run to completion: every request with the status and expiry after it (W10 rules), plus
# one TIMER row for each Ready / Rescheduled whose expiry passes before the order's next event
# that counts, and is not after the last event of the input (in milliseconds, as Spark keeps the
# watermark); from then on the status is Expired.
SQL["pickup_lifecycle_stream"] = _PICKUP + """
, ok3 as (select *, case when new_status = 'Completed' and exp_in_force is not null and req_ts > exp_in_force
                         then 'Expired' else new_status end as eff,
                    case when new_status = 'Completed' and exp_in_force is not null and req_ts > exp_in_force
                         then '-20640' end as code,
                    last_value(sets ignore nulls) over (partition by order_id order by req_ts, req_id
                      rows between unbounded preceding and current row) as exp_now,
                    lead(req_ts) over (partition by order_id order by req_ts, req_id) as next_ts
          from ok2),
timers as (select order_id, req_ts as since_ts, req_id as since_id, exp_now from ok3
           where eff in ('Ready', 'Rescheduled') and exp_now is not null and (next_ts is null or next_ts > exp_now)
             and floor(epoch_us(exp_now) / 1000) <= floor(epoch_us((select max(req_ts) from q_pickup)) / 1000)),
allrows as (select q.req_id, q.order_id, q.req_ts, q.new_status, coalesce(x.scode, ok3.code) as code, ok3.eff, ok3.sets,
              sp.pickup_status as status0
            from q_pickup q left join r_self_pickup sp on sp.order_id = q.order_id join r x on x.req_id = q.req_id
            left join ok3 on ok3.req_id = q.req_id),
per as (select req_id, order_id, req_ts, new_status, code,
          coalesce(last_value(eff ignore nulls) over w, status0) as status_after,
          last_value(sets ignore nulls) over w as exp_after
        from allrows window w as (partition by order_id order by req_ts, req_id rows between unbounded preceding and current row))
select cast(p.req_id as bigint) as req_id, cast(p.order_id as bigint) as order_id, p.req_ts, p.new_status, p.code,
  case when p.status_after in ('Ready', 'Rescheduled') and p.exp_after < p.req_ts then 'Expired' else p.status_after end as status_after,
  p.exp_after from per p
union all
select cast(null as bigint), cast(order_id as bigint), exp_now, 'Expired', 'TIMER', 'Expired', exp_now from timers"""


_DELIVERY = """
with ex as (select delivery_id, order_id, delivery_status from r_delivery),
cr as (
  select q.*, case when q.status not in ('Delivered', 'Out for Delivery', 'Pending', 'Preparing', 'Cancelled') then '-20050'
    when o.order_id is null then '-20053' when eo.order_id is not null then '-20054' when dc.company_id is null then '-20055'
    when coalesce(trim(q.address), '') = '' then '-20056' end as scode
  from q_delivery q left join r_orders o on o.order_id = q.order_id
  left join (select distinct order_id from ex) eo on eo.order_id = q.order_id
  left join r_delivery_company dc on dc.company_id = q.company_id where q.action = 'create'),
cr2 as (select *, case when scode is null and row_number() over (partition by scode is null, order_id order by req_ts, req_id) > 1
                       then '-20054' else scode end as code from cr),
created as (select delivery_id, status, req_ts as cts, req_id as cid from cr2 where code is null),
known as (select delivery_id, delivery_status as s0, cast(null as timestamp) as cts, cast(null as bigint) as cid from ex
          union all select delivery_id, status, cts, cid from created),
up as (
  select q.*, k.s0, case when q.status not in ('Delivered', 'Out for Delivery', 'Pending', 'Preparing', 'Cancelled') then '-20050'
    when (k.s0 is null and k.cts is null) or (k.cts is not null and (q.req_ts < k.cts or (q.req_ts = k.cts and q.req_id < k.cid))) then '-20052'
    end as scode
  from q_delivery q left join known k on k.delivery_id = q.delivery_id where q.action <> 'create'),
up2 as (select *, case when scode is null and (s0 = 'Delivered' or coalesce(max(case when status = 'Delivered' then 1 else 0 end)
          over (partition by scode is null, delivery_id order by req_ts, req_id rows between unbounded preceding and 1 preceding), 0) = 1)
          then '-20051' else scode end as code from up)"""

SQL["apply_delivery_updates"] = _DELIVERY + """
select req_id, code is null as accepted, code from (select req_id, code from cr2 union all select req_id, code from up2)"""

SQL["apply_delivery_updates_snapshot"] = _DELIVERY + """
, last as (select delivery_id, arg_max(status, (req_ts, req_id)) as st, arg_max(req_ts, (req_ts, req_id)) as ts
           from up2 where code is null group by delivery_id),
base as (select delivery_id, order_id, company_id, cast(null as varchar) as delivery_address,
           cast(null as timestamp) as delivery_date, delivery_status from r_delivery
         union all
         select delivery_id, order_id, company_id, trim(address), case when status = 'Delivered' then req_ts end, status
         from cr2 where code is null)
select b.delivery_id, b.order_id, b.company_id, b.delivery_address,
  case when l.st is null then b.delivery_date when l.st = 'Delivered' then l.ts when l.st = 'Cancelled' then null
       else b.delivery_date end as delivery_date,
  coalesce(l.st, b.delivery_status) as delivery_status
from base b left join last l on l.delivery_id = b.delivery_id"""


_PROMO = """
with ln as (select l.*, i.item_id is not null as known, i.unit_price,
              row_number() over (partition by l.req_id, l.item_id order by l.pos) > 1 as dup
            from q_promo_lines l left join r_item i on i.item_id = l.item_id),
lc as (select req_id, arg_min(c, pos) as lc from (
         select *, case when not known then '-20005' when discount_type not in ('Percentage', 'Amount') then '-20006'
                        when discount_value < 0 or (discount_type = 'Percentage' and discount_value > 100) then '-20007'
                        when discount_type = 'Amount' and discount_value > unit_price then '-20020'
                        when dup then '-20008' end as c from ln) where c is not null group by req_id),
nd as (select req_id, count(*) as n from q_promo_lines group by req_id),
dec as (select h.req_id, h.promotion_id,
          coalesce(case when coalesce(h.name, '') = '' then '-20001'
                        when h.start_date is null or h.end_date is null then '-20002'
                        when h.end_date < h.start_date then '-20003'
                        when coalesce(nd.n, 0) <= 0 then '-20004' end, lc.lc) as code
        from q_promo_hdr h left join nd on nd.req_id = h.req_id left join lc on lc.req_id = h.req_id)"""

SQL["create_promotions"] = _PROMO + "\nselect req_id, code is null as accepted, code from dec"

SQL["create_promotions_new"] = _PROMO + """
select d.promotion_id, h.name as promotion_name, h.description, 'Active' as status, h.start_date, h.end_date
from dec d join q_promo_hdr h on h.req_id = d.req_id where d.code is null"""

SQL["create_promotions_details"] = _PROMO + """
select d.promotion_id, l.item_id, l.discount_type, l.discount_value
from dec d join q_promo_lines l on l.req_id = d.req_id where d.code is null"""


# A recursive CTE walks the requests in order, as the procedure is called once for each,
# carrying the ICs and e-mails of the members registered so far
_REGISTER = """
with recursive q as (
  select r.*, row_number() over (order by req_ts, req_id) as rn,
    case when regexp_full_match(substr(ic, 1, 6), '[0-9]{6}')
         then cast(try_strptime(case when cast(substr(ic, 1, 2) as integer) >= 50 then '19' else '20' end || substr(ic, 1, 6), '%Y%m%d') as date)
    end as bd, date '2024-01-31' as a, date_of_birth as b
  from q_register r),
s as (
  select q.*, case when b > a then '-20003' when email in (select email from r_member where email is not null) then '-20002' end as before,
    case when ic is not null and bd is null then '-20011' when bd <> b then '-20012'
         when ((year(a) - year(b)) * 12 + (month(a) - month(b)) + case when day(a) = day(b) or (a = last_day(a) and b = last_day(b))
               then 0 else (day(a) - day(b)) / 31.0 end) / 12 < 12 then '-20032' end as after
  from q),
w(rn, req_id, code, ics, mails) as (
  select cast(0 as bigint), cast(null as bigint), cast(null as varchar), cast([] as varchar[]), cast([] as varchar[])
  union all
  select s.rn, s.req_id,
    coalesce(s.before, case when list_contains(w.ics, s.ic) then '-20001' when list_contains(w.mails, s.email) then '-20002' end, s.after),
    case when s.before is null and s.after is null and not coalesce(list_contains(w.ics, s.ic), false)
           and not coalesce(list_contains(w.mails, s.email), false) then list_append(w.ics, s.ic) else w.ics end,
    case when s.before is null and s.after is null and not coalesce(list_contains(w.ics, s.ic), false)
           and not coalesce(list_contains(w.mails, s.email), false) and s.email is not null then list_append(w.mails, s.email) else w.mails end
  from w join s on s.rn = w.rn + 1),
r3 as (select s.*, w.code from s join w on w.rn = s.rn)"""

SQL["register_members"] = _REGISTER + "\nselect req_id, code is null as accepted, code from r3"

SQL["register_members_new"] = _REGISTER + """
select req_id as member_id, name, ic, email, address, date_of_birth, date '2025-01-31' as expiry_date,
  cast(0 as bigint) as points_balance from r3 where code is null"""


SQL["pickup_expiry_past"] = f"""
select 'V12' as rule_id, 'self_pickup' as table_name, cast(pickup_id as varchar) as row_key, -20003 as code
from ({SQL["apply_pickup_updates_snapshot"]}) s where pickup_exp_date < timestamp '2024-01-31 00:00:00'"""

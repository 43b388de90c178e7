"""The retail adapter as SQL CTE text (DuckDB dialect), mirroring sources/retail.py."""

ADAPTER_CTES = {
    "r_branch": "select 1001+n_nationkey as branch_id, 'Mart '||n_name as branch_name from nation",
    "r_member": """select c_custkey as member_id, c_name as name, lower(c_name)||'@example.com' as email,
 cast(abs(c_acctbal) as decimal(10,0)) as points_balance,
 cast(date '2001-08-01' + cast(c_custkey % 120 - 30 as int) as date) as expiry_date from customer""",
    "r_item": """select p_partkey as item_id, p_name||' '||cast(p_partkey as varchar(20)) as item_name, p_type as category,
 cast(cast(p_retailprice as decimal(8,2)) - 890 as decimal(8,2)) as unit_price from part""",
    "r_supplier": "select s_suppkey as supplier_id, s_name as supplier_name from supplier",
    "r_staff": "select 4001+s_suppkey as staff_id, 1001+s_suppkey % 25 as branch_id from supplier",
    "r_orders": """select o_orderkey as order_id, case when o_orderstatus='F' and o_orderkey % 10 = 0 then null else o_custkey end as member_id,
 4001+o_orderkey % 100 as staff_id, 1001 + (o_orderkey*7 + o_custkey) % 25 as branch_id, o_orderdate as order_date,
 case o_orderstatus when 'F' then 'In Store' when 'O' then 'Delivery' else 'Self Pickup' end as order_type from orders""",
    "r_order_item": """select l_orderkey as order_id, l_partkey as item_id, cast(sum(cast(floor((l_quantity+9)/10) as int)) as int) as quantity,
 cast(min(round(cast(cast(p_retailprice as decimal(8,2)) - 890 as decimal(8,2)) * (1-cast(l_discount as decimal(3,2))),2)) as decimal(8,2)) as unit_price
 from lineitem join part on p_partkey=l_partkey group by l_orderkey, l_partkey""",
    "r_procurement": """select l_orderkey*100000000+l_partkey as procurement_id, l_partkey as item_id, min(l_suppkey) as supplier_id,
 1001 + (l_orderkey+l_partkey) % 25 as branch_id, cast(sum(l_quantity) as int) as quantity,
 cast(min(round((cast(p_retailprice as decimal(8,2)) - 890) * cast(0.55 + 0.01*(l_suppkey % 10) as decimal(3,2)),2)) as decimal(8,2)) as unit_cost,
 min(l_shipdate) as procurement_date from lineitem join part on p_partkey=l_partkey where l_returnflag='R' group by l_orderkey,l_partkey""",
    "r_branch_stock": """select 1001+n_nationkey as branch_id, p_partkey as item_id, cast((p_partkey*7+n_nationkey*13) % 120 as int) as stock_quantity,
 cast(date '2001-08-01' - cast(p_partkey % 90 as int) as date) as last_restock_date from part join nation on (p_partkey+n_nationkey) % 3 = 0""",
    "r_promotion": """select 5001+n_nationkey as promotion_id, 'Promo '||n_name as promotion_name, 'Active' as status,
 cast(date '2001-01-01' + cast(n_nationkey*9 as int) as date) as start_date, cast(date '2001-01-01' + cast(n_nationkey*9+30 as int) as date) as end_date from nation""",
    "r_promotion_details": """select 5001+n_nationkey as promotion_id, p_partkey as item_id, case when p_partkey % 2=0 then 'Percentage' else 'Amount' end as discount_type,
 cast(case when p_partkey % 2=0 then 10 + n_nationkey else 1 + n_nationkey % 5 end as decimal(8,2)) as discount_value
 from part join nation on p_partkey % 25 = n_nationkey or p_partkey % 25 = (n_nationkey+1) % 25""",
    "r_voucher": """select 'V'||cast(100+n_nationkey as varchar(10)) as voucher_id, case when n_nationkey % 2=0 then 'Percentage' else 'Amount' end as voucher_type,
 cast(5+n_nationkey as decimal(8,2)) as voucher_value, cast(date '2001-01-01' + cast(n_nationkey*20 as int) as date) as exp_date from nation""",
    "r_redemption": """select 30001+o_orderkey as redemption_id, 'V'||cast(100+(o_orderkey*3+o_custkey) % 25 as varchar(10)) as voucher_id, o_orderkey as order_id,
 o_orderdate as redeemed_date from orders where o_orderkey % 5 = 1""",
    "r_delivery_company": "select 2001+r_regionkey as company_id, 'Courier '||r_name as company_name from region",
    "r_delivery": """select 50001+o_orderkey as delivery_id, o_orderkey as order_id, 2001+(o_orderkey + o_custkey) % 5 as company_id,
 case when (o_orderkey*3+o_custkey) % 20 < 14 then 'Delivered' when (o_orderkey*3+o_custkey) % 20 < 16 then 'Out for Delivery' when (o_orderkey*3+o_custkey) % 20 < 17 then 'Pending'
 when (o_orderkey*3+o_custkey) % 20 < 19 then 'Preparing' else 'Cancelled' end as delivery_status from orders where o_orderstatus='O'""",
    "r_self_pickup": """select 40001+o_orderkey as pickup_id, o_orderkey as order_id, case when o_orderkey % 4=0 then 'Ready' else 'Completed' end as pickup_status
 from orders where o_orderstatus='P'""",
    "r_point_history": """select 10001+event_id as point_redemption_id, user_id as member_id, cast(floor(value) as int)+1 as amount,
 case when event_type in ('click','error') then 'Used' else 'Earned' end as transaction_type, ts as redemption_date from events""",
    # request tables for the batch jobs
    "q_transfer": """select event_id as req_id, ts as req_ts, 1001+user_id % 25 as from_branch, 1001+(user_id+event_id) % 25 as to_branch,
 case when (event_id) % 3 = 0 then (event_id) % 20 else (event_id) * 7919 % ((select max(p_partkey) from part) + 50) end as item_id, cast(floor(value) as int) % 40 as quantity from events where event_type='click'""",
    "q_price": """select event_id as req_id, ts as req_ts, case when (event_id) % 3 = 0 then (event_id) % 20 else (event_id) * 7919 % ((select max(p_partkey) from part) + 50) end as item_id, cast(cast(value as decimal(8,2)) - 20 as decimal(8,2)) as new_price
 from events where event_type='view'""",
    "q_redeem": """select event_id as req_id, ts as req_ts, 'V'||cast(95+event_id % 32 as varchar(10)) as voucher_id, case when event_id % 3 = 0 then event_id % 20 else event_id * 7919 % ((select max(o_orderkey) from orders) + 50) end as order_id,
 user_id as member_id from events where event_type='purchase'""",
    "q_pickup": """select event_id as req_id, ts as req_ts, case when event_id % 3 = 0 then event_id % 20 else event_id * 7919 % ((select max(o_orderkey) from orders) + 50) end as order_id, case event_id % 6 when 0 then 'Preparing' when 1 then 'Ready'
 when 2 then 'Completed' when 3 then 'Expired' when 4 then 'Rescheduled' else 'Shipped' end as new_status,
 case when event_id % 6 = 4 and event_id % 5 = 1 then ts - interval 1 day when event_id % 6 = 4 and event_id % 5 > 1 then ts + to_days(cast(event_id % 7 as int)) end as reschedule_date from events where event_type='signup'""",
    "q_delivery": """select event_id as req_id, ts as req_ts, case when event_id % 4 = 0 then 'create' else 'update' end as action,
 case when event_id % 4 = 0 then -1 - event_id else 50001 + case when event_id % 3 = 0 then event_id % 20 else event_id * 7919 % ((select max(o_orderkey) from orders) + 50) end end as delivery_id, case when event_id % 3 = 0 then event_id % 20 else event_id * 7919 % ((select max(o_orderkey) from orders) + 50) end as order_id,
 2001 + event_id % 7 as company_id, case when event_id % 7 = 0 then null else 'Addr ' || cast(user_id as varchar) end as address,
 case event_id % 6 when 0 then 'Delivered' when 1 then 'Out for Delivery' when 2 then 'Pending' when 3 then 'Preparing'
 when 4 then 'Cancelled' else 'Lost' end as status from events where event_type = 'error'""",
    "q_promo_hdr": """select event_id as req_id, ts as req_ts, 7000000 + event_id as promotion_id,
 case when event_id % 9 = 0 then '' else 'Promo ' || cast(user_id as varchar) end as name, cast(null as varchar) as description,
 cast(ts as date) as start_date, cast(ts as date) + cast(event_id % 40 - 5 as int) as end_date from events where event_type = 'view'""",
    "q_promo_lines": """select req_id, pos, case when (req_id + (pos % 3) * 13) % 3 = 0 then (req_id + (pos % 3) * 13) % 20 else (req_id + (pos % 3) * 13) * 7919 % ((select max(p_partkey) from part) + 50) end as item_id,
 case when (req_id + pos) % 7 = 0 then 'Bogus' when (req_id + pos) % 7 < 4 then 'Percentage' else 'Amount' end as discount_type,
 cast(((req_id + pos * 17) % 130) - 10 as decimal(8,2)) as discount_value
 from (select event_id as req_id, unnest(range(0, event_id % 5)) as pos from events where event_type = 'view' and event_id % 5 > 0)""",
    "q_register": """select req_id, req_ts, name, case when req_id % 19 = 0 then '991340' when req_id % 13 = 0
 then strftime(dob + 1, '%y%m%d') else strftime(dob, '%y%m%d') end || '-' || lpad(cast(user_id % 100 as varchar), 2, '0') || '-'
 || lpad(cast(user_id % 10000 as varchar), 4, '0') as ic, email, dob as date_of_birth, cast(null as varchar) as address from (
 select event_id as req_id, ts as req_ts, user_id, 'New member ' || cast(user_id as varchar) as name,
 case when event_id % 11 = 0 then date '2030-01-01' else cast(date '1950-01-01' + cast((user_id * 3701) % 25000 as int) as date) end as dob,
 case when event_id % 17 = 0 then null when event_id % 5 = 0 then 'customer#' || lpad(cast(user_id as varchar), 9, '0') || '@example.com'
 else 'new' || cast(event_id as varchar) || '@example.com' end as email from events where event_type = 'signup')""",
}


def with_adapter(body: str) -> str:
    """Prefix an oracle query with the CTEs it references (r_* / q_* names)."""
    used = [name for name in ADAPTER_CTES if name in body]
    if not used:
        return body
    ctes = ",\n".join(f"{n} as ({ADAPTER_CTES[n]})" for n in used)
    stripped = body.lstrip()
    if stripped[:15].lower() == "with recursive ":
        return f"with recursive {ctes},\n{stripped[15:]}"
    if stripped[:5].lower() == "with ":
        return f"with {ctes},\n{stripped[5:]}"
    return f"with {ctes}\n{body}"

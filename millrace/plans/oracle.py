"""The registered queries in SQL, over the same tables."""

from __future__ import annotations

SECONDS = "'%Y-%m-%d %H:%M:%S'"

EVENTS = """
ev as (select event_id, ts, user_id, event_type, value, props,
              cast(json_extract_string(props, '$.k') as integer) as k,
              cast(round(value * 100) as bigint) as cents from events)"""

PAGES = EVENTS + """,
pv as (select event_id, ts, cast(user_id as varchar) as mid,
              case event_type when 'view' then 'home' when 'click' then 'good_detail' else event_type end as page_id,
              case event_type when 'signup' then null when 'error' then 'login' else 'home' end as last_page_id,
              cast(k % 3 as varchar) as vc, cast(k % 4 as varchar) as ch, cast(k % 5 as varchar) as ar,
              cast(k % 2 as varchar) as is_new, cents as during_time, k from ev)"""

LINES = """
ol as (select l_orderkey || '-' || l_linenumber as order_detail_id, l_orderkey as order_id, l_partkey as sku_id,
              l_shipdate as ts, l_partkey, l_suppkey, base as original_amount,
              base * rate // 100 as activity_amount, cast(round(l_quantity) as bigint) as coupon_amount,
              base - base * rate // 100 as order_amount,
              row_number() over (partition by l_orderkey, l_linenumber
                                 order by l_shipdate desc, l_partkey desc, l_suppkey desc) as newest
       from (select *, cast(round(l_extendedprice * 100) as bigint) as base,
                    cast(round(l_discount * 100) as bigint) as rate from lineitem))"""

LOG = PAGES + """,
lg as (select *, event_id % 10 <> 9 as ok, page_id = 'signup' as starting,
              page_id <> 'signup' and not (page_id = 'purchase' and k % 10 = 0) as paged from pv)"""

ARRIVALS = EVENTS + """,
ar as (select event_id, user_id, user_id % 4 as source, event_id + (event_id * 7919) % 37 as place, ts,
              epoch_us(ts) // 1000 as ts_ms from ev),
mx as (select *, max(ts_ms) over (partition by source order by place, event_id
                                  rows between unbounded preceding and 1 preceding) as seen,
              (ts_ms // 3600000 + 1) * 3600000 as window_end from ar),
mk as (select *, coalesce(window_end + 6000 <= seen, false) as late,
              coalesce(window_end + 3000 <= seen, false) as closed from mx)"""

DICT = """
dic as (select distinct substr(o_orderpriority, 1, 1) as dic_code, o_orderpriority as dic_name
        from orders where o_orderpriority not like '5%')"""

DETAIL = DICT + """,
li as (select *, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey as line_id from lineitem),
detail as (
  select line_id as id, cast(l_orderkey as varchar) as order_id, cast(o_custkey as varchar) as user_id,
         cast(l_partkey as varchar) as sku_id, 'sku ' || l_partkey as sku_name,
         cast(o_custkey % 25 as varchar) as province_id,
         case when l_discount > 0.05 then cast(l_suppkey % 7 as varchar) end as activity_id,
         case when l_discount > 0.05 then cast(l_suppkey % 11 as varchar) end as activity_rule_id,
         case when l_tax > 0.04 then cast(l_partkey % 13 as varchar) end as coupon_id,
         strftime(l_shipdate, '%Y-%m-%d') as date_id, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') as create_time,
         cast(l_suppkey as varchar) as source_id, dic_code as source_type, dic_name as source_type_name,
         cast(cast(l_quantity as bigint) as varchar) as sku_num,
         cast(cast(cast(l_quantity as bigint) as decimal(16,2)) * cast(l_extendedprice as decimal(16,2)) as varchar)
           as split_original_amount,
         cast(cast(l_discount as decimal(16,2)) as varchar) as split_activity_amount,
         cast(cast(l_tax as decimal(16,2)) as varchar) as split_coupon_amount,
         cast(cast(l_extendedprice as decimal(16,2)) as varchar) as split_total_amount,
         cast(epoch_us(l_shipdate) // 1000000 as varchar) as ts
  from li join orders on l_orderkey = o_orderkey
  join dic on dic_code = cast(l_linenumber % 5 + 1 as varchar))"""

SKU = """
c3 as (select distinct p_type as id, lower(p_type) as name, substr(p_type, 1, 1) as category2_id from part),
c2 as (select distinct category2_id as id, 'group ' || category2_id as name,
              case when category2_id < 'N' then 'A-M' else 'N-Z' end as category1_id from c3),
sku as (select p_partkey as sku_id, p_name as sku_name, p_brand as trademark_id, upper(p_brand) as trademark_name,
               c3.id as category3_id, c3.name as category3_name, c2.id as category2_id, c2.name as category2_name,
               c2.category1_id, 'root ' || c2.category1_id as category1_name
        from part join c3 on p_type = c3.id join c2 on c3.category2_id = c2.id)"""

MOVED = """
mv as (select o_orderkey, o_custkey, o_orderdate, '1003' as status from orders where o_orderstatus = 'F'
       union all select o_orderkey, o_custkey, o_orderdate, '1005' from orders where o_orderstatus = 'P'
       union all select o_orderkey, o_custkey, o_orderdate, '1006' from orders
                 where o_orderstatus = 'P' and o_orderkey % 2 = 0)"""

CART = EVENTS + """,
cart as (select cast(event_id as varchar) as id, cast(user_id as varchar) as user_id, cast(k * 10 as varchar) as sku_id,
                cast(cast(value as decimal(16,2)) as varchar) as cart_price, cast(k % 7 as varchar) as source_id,
                cast(k % 5 + 1 as varchar) as source_type,
                cast(case event_type when 'purchase' then k else k - event_id % 100 end as integer) as sku_num,
                cast(epoch_us(ts) // 1000000 as varchar) as ts
         from ev where event_type = 'purchase' or (event_type = 'click' and k > event_id % 100))"""


def bounds(ts: str, width: str) -> str:
    start = f"time_bucket(interval '{width}', {ts})"
    return f"strftime({start}, {SECONDS}) as stt, strftime({start} + interval '{width}', {SECONDS}) as edt"


def unique_and_new(source: str, unique: str, new: str, width: str) -> str:
    return f"""
with d as (select user_id, ts::date as day, min(ts) as ts from ({source}) group by all),
     f as (select *, min(day) over (partition by user_id) = day as first from d)
select {bounds('ts', width)}, count(*) as {unique}, cast(sum(cast(first as integer)) as bigint) as {new}
from f group by all"""


ORACLE: dict[str, str] = {}

ORACLE["order_window"] = unique_and_new(
    "select o_custkey as user_id, o_orderdate as ts from orders",
    "order_unique_user_count", "order_new_user_count", "1 day",
)
ORACLE["payment_window"] = unique_and_new(
    "select user_id, ts from events where event_type = 'purchase'",
    "payment_suc_unique_user_count", "payment_suc_new_user_count", "1 hour",
)
ORACLE["cart_uu_window"] = f"""
with {CART},
d as (select user_id, min(to_timestamp(cast(ts as bigint))::timestamp) as ts from cart
      group by user_id, to_timestamp(cast(ts as bigint))::timestamp::date)
select {bounds('ts', '1 hour')}, count(*) as cart_add_uu_ct from d group by all"""
ORACLE["register_window"] = f"""
select {bounds('ts', '1 hour')}, count(*) as register_ct from events where event_type = 'signup' group by all"""
ORACLE["page_view_window"] = f"""
with {PAGES},
f as (select *, row_number() over (partition by mid, ts::date order by ts, event_id) as n from pv)
select {bounds('ts', '1 hour')}, vc, ch, ar, is_new, cast(sum(cast(n = 1 as integer)) as bigint) as uv_ct,
       cast(sum(cast(last_page_id is null as integer)) as bigint) as sv_ct, count(*) as pv_ct,
       cast(sum(during_time) as bigint) as dur_sum
from f group by all"""
ORACLE["home_detail_uv_window"] = f"""
with {PAGES},
f as (select *, row_number() over (partition by mid, page_id, ts::date order by ts, event_id) as n from pv
      where page_id in ('home', 'good_detail'))
select {bounds('ts', '1 hour')}, cast(sum(cast(page_id = 'home' as integer)) as bigint) as home_uv_ct,
       cast(sum(cast(page_id = 'good_detail' as integer)) as bigint) as good_detail_uv_ct
from f where n = 1 group by all"""
ORACLE["login_window"] = f"""
with d as (select o_custkey, o_orderdate::date as day, min(o_orderdate) as ts from orders
           where o_orderpriority like '1%' or o_orderpriority like '2%' group by all),
     b as (select *, coalesce(day - lag(day) over (partition by o_custkey order by day) > 7, false) as back from d)
select {bounds('ts', '1 day')}, cast(sum(cast(back as integer)) as bigint) as back_ct, count(*) as uu_ct
from b group by all"""
WORDS = "list_distinct(list_filter(regexp_split_to_array(lower({0}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> ''))"
ORACLE["keyword_window"] = f"""
with p as (select text, to_timestamp(1704067200 + conv_id * 7 + turn)::timestamp as ts from conversations
           where turn % 3 in (0, 1) and role <> 'system' and text is not null),
     w as (select unnest({WORDS.format('text')}) as keyword, ts from p)
select {bounds('ts', '5 seconds')}, keyword, count(*) as keyword_count from w group by all"""
ORACLE["sku_order_window"] = f"""
with {LINES}, {SKU},
s as (select {bounds('ts', '1 day')}, sku_id,
       cast(sum(case when newest = 1 then original_amount else 0 end) as bigint) as original_amount,
       cast(sum(case when newest = 1 then activity_amount else 0 end) as bigint) as activity_amount,
       cast(sum(case when newest = 1 then coupon_amount else 0 end) as bigint) as coupon_amount,
       cast(sum(case when newest = 1 then order_amount else 0 end) as bigint) as order_amount
      from ol group by all)
select s.*, sku_name, trademark_id, category3_id, category3_name, category2_id, category2_name, category1_id,
       category1_name, trademark_name
from s left join sku using (sku_id)"""
ORACLE["province_order_window"] = f"""
with {LINES}
select {bounds('ts', '1 day')}, c_nationkey as province_id, count(distinct order_id) as order_count,
       cast(sum(case when newest = 1 then order_amount else 0 end) as bigint) as order_amount,
       n_name as province_name
from ol join orders on order_id = o_orderkey join customer on o_custkey = c_custkey
left join nation on c_nationkey = n_nationkey
group by all"""
ORACLE["refund_window"] = f"""
with {SKU}
select {bounds('l_shipdate', '1 day')}, category3_id, category2_id, category1_id, trademark_id, l_suppkey as user_id,
       category2_name, category3_name, count(distinct l_orderkey) as refund_count, category1_name, trademark_name
from lineitem left join sku on l_partkey = sku_id where l_returnflag = 'R' group by all"""
ORACLE["revision_netting"] = f"""
with {LINES}, s as (select *, 1 as sign from ol union all select *, -1 from ol where newest > 1)
select order_detail_id, sku_id, strftime(ts, {SECONDS}) as ts, original_amount * sign as original_amount,
       activity_amount * sign as activity_amount, coupon_amount * sign as coupon_amount,
       order_amount * sign as order_amount, sign from s"""
ORACLE["upsert_latest"] = f"""
with {LINES}
select order_detail_id, '{{"sku_id":' || sku_id || ',"order_amount":' || order_amount || '}}' as value
from ol where newest = 1 and coupon_amount <> 50"""
ORACLE["replacing_compact"] = f"""
with {LINES},
v as (select time_bucket(interval '30 days', ts, timestamp '1970-01-01') as b, sku_id % 100 as brand, l_suppkey as ts,
             cast(sum(order_amount) as bigint) as order_amount from ol group by all),
r as (select *, row_number() over (partition by b, brand order by ts desc) as n from v)
select strftime(b, {SECONDS}) as stt, strftime(b + interval '30 days', {SECONDS}) as edt, brand, ts, order_amount
from r where n = 1"""
ORACLE["cdc_clean"] = """
select 'user_info' as "table", 'insert' as type, '1704067200' as ts, cast(c_custkey as varchar) as id, c_name as name
from customer
union all select 'user_info', 'update', '1704153600', cast(c_custkey as varchar), c_name from customer where c_custkey % 3 = 0
union all select 'vendor_info', 'insert', '1704067200', cast(s_suppkey as varchar), s_name from supplier
union all select 'sku_info', 'insert', '1704067200', cast(p_partkey as varchar), p_name from part"""
CAPTURED = """
cp as (select 'table_' || o_custkey as source_table, lower(substr(o_orderpriority, 3)) as source_type,
              'sink_' || o_orderkey as sink_table,
              case o_orderstatus when 'F' then 'd' when 'P' then 'u' else 'c' end as op, o_orderdate, o_orderkey
       from orders)"""
ORACLE["cdc_unwrap"] = f"with {CAPTURED} select source_table, source_type, sink_table, op from cp"
ORACLE["config_current"] = f"""
with {CAPTURED},
r as (select *, row_number() over (partition by source_table, source_type order by o_orderdate desc, o_orderkey desc) as n
      from cp)
select source_table, source_type, sink_table, op from r where n = 1 and op <> 'd'"""
ORACLE["change_insert_select"] = """
select cast(o_orderkey as varchar) as id, cast(o_custkey as varchar) as user_id,
       cast(o_custkey % 25 as varchar) as province_id, cast(cast(o_totalprice as decimal(16,2)) as varchar) as amount,
       cast(epoch_us(o_orderdate) // 1000000 as varchar) as ts
from orders"""
ORACLE["status_transition"] = f"""
with {MOVED}
select cast(o_orderkey as varchar) as id, cast(o_custkey as varchar) as user_id, status as order_status,
       cast(epoch_us(o_orderdate) // 1000000 as varchar) as ts from mv"""
ORACLE["cart_add"] = f"with {CART} select * from cart"
FACT = DETAIL + """,
fx as (select *, cast(create_time as timestamp) as moment from detail)"""
ORACLE["sku_order_from_fact"] = f"""
with {FACT}
select {bounds('moment', '1 day')}, sku_id,
       cast(sum(cast(split_original_amount as decimal(18,4))) as varchar) as original_amount,
       cast(sum(cast(split_activity_amount as decimal(18,2))) as varchar) as activity_amount,
       cast(sum(cast(split_coupon_amount as decimal(18,2))) as varchar) as coupon_amount,
       cast(sum(cast(split_total_amount as decimal(18,2))) as varchar) as order_amount
from fx group by all"""
ORACLE["province_order_from_fact"] = f"""
with {FACT}
select {bounds('moment', '1 day')}, province_id, count(distinct order_id) as order_count,
       cast(sum(cast(split_total_amount as decimal(18,2))) as varchar) as order_amount
from fx group by all"""
ORACLE["order_detail_fact"] = f"with {DETAIL} select * from detail"
ORACLE["order_cancel_fact"] = f"""
with {DETAIL}, {MOVED}
select id, order_id, user_id, sku_id, sku_name, province_id, activity_id, activity_rule_id, coupon_id,
       strftime(o_orderdate, '%Y-%m-%d') as date_id, strftime(o_orderdate, {SECONDS}) as cancel_time, source_id,
       source_type as source_type_code, source_type_name, sku_num, split_original_amount, split_activity_amount,
       split_coupon_amount, split_total_amount, ts
from detail join mv on order_id = cast(o_orderkey as varchar) and status = '1003'"""
ORACLE["payment_fact"] = f"""
with {DETAIL}
select d.id as order_detail_id, order_id, user_id, sku_id, sku_name, province_id, activity_id, activity_rule_id,
       coupon_id, p.dic_code as payment_type_code, p.dic_name as payment_type_name,
       strftime(o_orderdate, {SECONDS}) as callback_time, source_id, source_type as source_type_code,
       source_type_name, sku_num, split_original_amount, split_activity_amount, split_coupon_amount,
       split_total_amount as split_payment_amount, cast(epoch_us(o_orderdate) // 1000000 as varchar) as ts
from orders join dic p on o_orderpriority = p.dic_name
join detail d on order_id = cast(o_orderkey as varchar) where o_orderstatus <> 'F'"""
BACK = """
bk as (select cast(l_orderkey as varchar) as order_id, cast(l_partkey as varchar) as sku_id,
              l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey as id,
              cast(l_suppkey as varchar) as user_id, cast(cast(l_quantity as bigint) as varchar) as refund_num,
              cast(cast(l_extendedprice as decimal(16,2)) as varchar) as refund_amount,
              strftime(l_shipdate, '%Y-%m-%d') as date_id, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') as moment,
              cast(l_linenumber % 5 + 1 as varchar) as kind, cast(l_partkey % 5 + 1 as varchar) as reason,
              cast(l_suppkey % 5 + 1 as varchar) as pay, l_linestatus,
              cast(epoch_us(l_shipdate) // 1000000 as varchar) as ts
       from lineitem where l_returnflag = 'R')"""
ORACLE["refund_request_fact"] = f"""
with {DICT}, {MOVED}, {BACK}
select bk.id, bk.user_id, order_id, sku_id, cast(o_custkey % 25 as varchar) as province_id, date_id, moment as create_time,
       kind as refund_type_code, a.dic_name as refund_type_name, reason as refund_reason_type_code,
       b.dic_name as refund_reason_type_name, 'reason ' || reason as refund_reason_txt, refund_num, refund_amount, ts
from bk join mv on order_id = cast(o_orderkey as varchar) and status = '1005'
join dic a on kind = a.dic_code join dic b on reason = b.dic_code"""
ORACLE["refund_from_fact"] = f"""
with {DICT}, {MOVED}, {BACK}, {SKU},
rq as (select order_id, bk.sku_id, bk.user_id, cast(moment as timestamp) as asked
       from bk join mv on order_id = cast(o_orderkey as varchar) and status = '1005'
       join dic a on kind = a.dic_code join dic b on reason = b.dic_code)
select {bounds('asked', '1 day')}, category3_id, category2_id, category1_id, trademark_id, user_id, category2_name, category3_name,
       count(distinct order_id) as refund_count, category1_name, trademark_name
from rq left join sku on rq.sku_id = cast(sku.sku_id as varchar) group by all"""
ORACLE["cancel_from_stored_fact"] = ORACLE["order_cancel_fact"]
ORACLE["payment_from_stored_fact"] = ORACLE["payment_fact"]
ORACLE["refund_paid_fact"] = f"""
with {DICT}, {MOVED}, {BACK}
select p.id, cast(o_custkey as varchar) as user_id, p.order_id, p.sku_id, cast(o_custkey % 25 as varchar) as province_id,
       p.pay as payment_type_code, dic_name as payment_type_name, p.date_id, p.moment as callback_time,
       r.refund_num, p.refund_amount, p.ts
from bk p join bk r on p.order_id = r.order_id and p.sku_id = r.sku_id
join mv on p.order_id = cast(o_orderkey as varchar) and status = '1006'
join dic on p.pay = dic_code where p.l_linestatus = 'F'"""
ORACLE["left_join_upsert"] = """
select cast(c_custkey as integer) as id, c_name as name, s_nationkey as age
from customer left join supplier on c_custkey = s_suppkey"""
ORACLE["dict_lookup"] = f"""
with {DICT} select o_orderkey, dic_code as code, dic_name as name from orders join dic on o_orderpriority = dic_name"""
ORACLE["dict_lookup_twice"] = f"""
with {DICT}
select l_orderkey, l_linenumber, l_partkey, l_suppkey, a.dic_code as kind, b.dic_code as reason,
       a.dic_name as kind_name, b.dic_name as reason_name
from lineitem join dic a on a.dic_code = cast(l_partkey % 5 + 1 as varchar)
join dic b on b.dic_code = cast(l_suppkey % 5 + 1 as varchar)"""
ORACLE["dim_enrich_chain"] = """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, s_name as vendor, s_nationkey as nation_id, n_name as nation,
       n_regionkey as region_id, r_name as region
from lineitem left join supplier on l_suppkey = s_suppkey and s_acctbal >= 0
left join nation on s_nationkey = n_nationkey left join region on n_regionkey = r_regionkey"""
ORACLE["config_route"] = """
select 'dim_user_info' as sink_table, 'id' as sink_pk, cast(c_custkey as varchar) as id, 'insert' as op_type,
       '1704067200' as ts from customer
union all select 'dim_user_info', 'id', cast(c_custkey as varchar), 'update', '1704153600' from customer where c_custkey % 3 = 0
union all select 'dim_sku_info', 'id', cast(p_partkey as varchar), 'insert', '1704067200' from part"""
ORACLE["config_route_transition"] = f"""
with o as (select *, cast(epoch_us(o_orderdate) // 1000000 as varchar) as ts from orders)
select 'dwd_coupon_order' as sink_table,
       'id=' || o_orderkey || ';op_type=update;used_time=' || strftime(o_orderdate, {SECONDS}) || ';user_id=' || o_custkey
         as data, ts
from o where o_orderstatus = 'F'
union all select 'dwd_coupon_pay', 'coupon_status=1403;id=' || o_orderkey || ';op_type=update', ts
from o where o_orderstatus = 'P'
union all select 'dwd_coupon_get', 'id=' || o_orderkey || ';op_type=insert;user_id=' || o_custkey, ts
from o where o_orderstatus = 'O'"""
ORACLE["config_prune"] = """
select 'dwd_order_placed' as sink_table,
       'id=' || o_orderkey || ';op_type=insert;total_amount=' || cast(o_totalprice as decimal(16,2)) || ';user_id=' || o_custkey
         as data from orders"""
ORACLE["dim_upsert"] = """
select cast(c_custkey as varchar) as id, c_name as name,
       case when c_custkey % 3 = 0 then lower(c_mktsegment) else c_mktsegment end as segment from customer"""
ORACLE["route_write"] = """
select 'dwd_order_placed' as sink_table, count(*) as n, cast(sum(o_orderkey) as bigint) as id_sum from orders
union all select 'dwd_coupon_order', count(*), cast(sum(o_orderkey) as bigint) from orders where o_orderstatus = 'F'
union all select 'dwd_coupon_pay', count(*), cast(sum(o_orderkey) as bigint) from orders where o_orderstatus = 'P'
union all select 'dwd_coupon_get', count(*), cast(sum(o_orderkey) as bigint) from orders where o_orderstatus = 'O'"""
ORACLE["json_valid"] = "select event_id, cast(case when event_id % 10 = 9 then 0 else 1 end as bigint) as valid from events"
ORACLE["log_split_counts"] = f"""
with {LOG}
select 'start' as output, count(*) as n from lg where ok and starting
union all select 'display', cast(coalesce(sum(k % 4), 0) as bigint) from lg where ok and not starting
union all select 'action', cast(coalesce(sum(k % 3), 0) as bigint) from lg where ok and not starting
union all select 'error', count(*) from lg where ok and page_id = 'error'
union all select 'page', count(*) from lg where ok and paged"""
ORACLE["explode_display"] = f"""
with {LOG}, e as (select *, unnest(range(1, k % 4 + 1)) as i from lg where ok and not starting)
select mid, vc, case when paged then page_id else 'shown' end as page_id, cast(k + i as varchar) as item,
       cast(i as varchar) as "order", cast(epoch_us(ts) // 1000 as varchar) as ts from e"""
ORACLE["explode_action"] = f"""
with {LOG}, e as (select *, unnest(range(1, k % 3 + 1)) as i from lg where ok and not starting)
select mid, case when paged then page_id else 'none' end as page_id, 'act_' || i as action_id,
       cast(epoch_us(ts) // 1000 + i as varchar) as ts from e"""
ORACLE["log_reject"] = "select event_id, 'not an object' as reason from events where event_id % 10 = 9"
ORACLE["log_outputs"] = f"""
with {LOG},
g as (select *, epoch_us(ts) // 1000 as ms, case when k % 5 = 1 then 'STRING' else 'BIGINT' end as kind,
             case when paged then last_page_id end as came, case when paged then page_id end as pg,
             case when paged then cast(during_time as varchar) end as dur, case when paged then 'BIGINT' end as spent
      from lg where ok)
select 'start' as output, event_id as seq, mid, vc, cast(null as varchar) as page_id, cast(null as varchar) as last_page_id,
       cast(null as varchar) as during_time, cast(null as varchar) as item, cast(null as varchar) as action_id,
       cast(null as varchar) as error_code, 'icon' as entry, ms as ts, kind as ts_kind, cast(null as varchar) as spent_kind
from g where starting
union all select 'display', null, mid, vc, coalesce(pg, 'shown'), came, dur, cast(k + i as varchar), null, null, null, ms, 'BIGINT', spent
from (select *, unnest(range(1, k % 4 + 1)) as i from g where not starting)
union all select 'action', null, mid, vc, coalesce(pg, 'none'), came, dur, null, 'act_' || i, null, null, ms + i, 'STRING', spent
from (select *, unnest(range(1, k % 3 + 1)) as i from g where not starting)
union all select 'error', event_id, mid, vc, pg, came, dur, null, null, cast(k + 1000 as varchar), null, ms, kind, spent
from g where page_id = 'error'
union all select 'page', event_id, mid, vc, pg, came, dur, null, null, null, null, ms, kind, spent from g where paged"""
ORACLE["page_view_from_log"] = f"""
with {LOG},
f as (select *, row_number() over (partition by mid, ts::date order by ts, event_id) as n from lg where ok and paged)
select {bounds('ts', '1 hour')}, vc, ch, ar, is_new, cast(sum(cast(n = 1 as integer)) as bigint) as uv_ct,
       cast(sum(cast(last_page_id is null as integer)) as bigint) as sv_ct, count(*) as pv_ct,
       cast(sum(during_time) as bigint) as dur_sum
from f group by all"""
ORACLE["time_columns"] = f"""
select event_id, strftime(ts, '%Y-%m-%d') as day, strftime(ts, {SECONDS}) as at,
       epoch_us(date_trunc('day', ts)) // 1000 as day_ms, cast(1 as bigint) as before_now from events"""
ORACLE["summary_version"] = f"""
select {bounds('o_orderdate', '1 day')}, cast(sum(cast(round(o_totalprice * 100) as bigint)) as bigint) as total,
       cast(1704067200000 as bigint) as ts from orders group by all"""
ORACLE["dim_missing_drop"] = """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, s_name as vendor
from lineitem join supplier on l_suppkey = s_suppkey where s_acctbal >= 0"""
ORACLE["visitor_repair"] = f"""
with {PAGES},
f as (select *, first_value(is_new) over w as opening, first_value(ts::date) over w as day from pv
      window w as (partition by mid order by ts, event_id))
select event_id, mid,
       case when is_new = '1' and ts::date <> case when opening = '1' then day else day - 1 end then '0' else is_new end
         as is_new from f"""
ORACLE["keyword_tokens"] = f"""
with w as (select unnest({WORDS.format('text')}) as keyword from documents)
select keyword, count(*) as docs from w group by all"""
ORACLE["word_count"] = """
with w as (select unnest(string_split(text, ',')) as word from conversations)
select word, count(*) as n from w group by all"""
ORACLE["parse_csv_line"] = f"""
with {EVENTS}, l as (select event_id, 'sensor_' || (user_id % 10) as id, epoch_us(ts) // 1000 as ts, k from ev)
select id, ts, k as vc from l where event_id % 7 <> 6
union all select id || ',' || ts || ',?', null, null from l where event_id % 7 = 6"""
ORACLE["window_collect"] = f"""
with b as (select *, time_bucket(interval '1 hour', ts) as b from events),
p as (select *, (row_number() over (partition by b order by ts, event_id) - 1) // 10 as chunk from b)
select strftime(b, {SECONDS}) as stt, strftime(b + interval '1 hour', {SECONDS}) as edt, cast(chunk as bigint) as chunk,
       string_agg(event_id || ':' || user_id, ',' order by ts, event_id) as items
from p group by b, chunk"""
ORACLE["watermark_trace"] = f"with {ARRIVALS} select event_id, source, seen - 3001 as watermark from mk"
ORACLE["late_split"] = f"with {ARRIVALS} select event_id, window_end, cast(late as bigint) as late from mk"
ORACLE["late_refire"] = f"""
with {ARRIVALS}
select strftime(to_timestamp((window_end - 3600000) // 1000)::timestamp, {SECONDS}) as stt,
       strftime(to_timestamp(window_end // 1000)::timestamp, {SECONDS}) as edt,
       cast(sum(cast(not closed as integer)) as bigint) as first_ct,
       cast(sum(cast(closed and not late as integer)) as bigint) as refire_ct,
       cast(sum(cast(late as integer)) as bigint) as late_ct,
       cast(sum(cast(not late as integer)) as bigint) as final_ct
from mk group by window_end"""
VALUED = EVENTS + """,
kv as (select *, '{"event_type":"' || event_type || '","k":' || k || '}' as value_text from ev)"""
ORACLE["kv_latest"] = f"""
with {VALUED}, r as (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as n from kv)
select user_id, value_text as value from r where n = 1"""
ORACLE["kv_list"] = f"""
with {VALUED},
p as (select *, (row_number() over (partition by user_id order by ts, event_id) - 1) // 100 as chunk from kv)
select user_id, cast(chunk as bigint) as chunk, string_agg(value_text, ',' order by ts, event_id) as items
from p group by user_id, chunk"""
ORACLE["kv_set"] = f"with {VALUED} select distinct value_text as value from kv"
ORACLE["kv_ranked"] = f"""
with {EVENTS},
r as (select user_id || ':' || event_type as member, cents,
             row_number() over (partition by user_id, event_type order by ts desc, event_id desc) as n from ev)
select member, cents, row_number() over (order by cents, member) - 1 as place from r where n = 1"""
ORACLE["rename_case"] = """
select event_id, user_id, event_type, cast(user_id as varchar) as user_id_text from events"""

"""The nine source tables and the pipeline-run table, derived from the given Parquet
tables. Key arithmetic only, so every engine derives the same rows.

The SQL is portable: ``{ts}`` is the zone-less timestamp type of the engine, ``{each}``
its function that makes a row of each element, ``{list}`` the one that makes an array."""

from __future__ import annotations

# State codes by nation key 0..24; XX belongs to no region.
STATE_CODES = "SP RJ MG RS PR SC BA DF GO ES PE CE PA MT MA MS PB RN PI AL AC AM SE TO XX"

_STATE = f"split_part('{STATE_CODES}', ' ', cast({{k}} as int) + 1)"
_LOADED = "cast('2002-01-01' as date) as ingest_date, {ts} '2002-01-01 00:00:00' as _ingested_at"
# An older copy of a row: what a replay or an earlier load left behind.
_OLDER = "cast('2001-12-31' as date) as ingest_date, {ts} '2001-12-31 00:00:00' as _ingested_at"

SOURCES: dict[str, tuple[tuple[str, ...], str]] = {}
SPARK_NAMES = {"ts": "timestamp_ntz", "each": "explode", "list": "array"}


def _source(name: str, needs: str, sql: str) -> None:
    SOURCES[name] = (tuple(needs.split()), sql)


_source(
    "src_orders",
    "orders",
    """
select cast(k as string) as order_id, cast(k as string) as customer_id,
  st as order_status, p as order_purchase_timestamp, ap as order_approved_at,
  sh as order_delivered_carrier_date,
  case when st = 'delivered' and k % 1000 <> 0
       then sh + (1 + k % 25) * interval '1' day end as order_delivered_customer_date,
  p + (14 + k % 29) * interval '1' day as order_estimated_delivery_date,
  cast(p as date) as ingest_date, {ts} '2002-01-01 00:00:00' as _ingested_at
from (
  select k, p, st, ap,
    case when st in ('delivered', 'shipped')
         then coalesce(ap, p) + (6 + k % 215) * interval '1' hour end as sh
  from (
    select k, p, st,
      case when (st in ('canceled', 'unavailable') and k % 10 < 6) or k % 333 = 0 then null
           else p + (8 + k % 2873) * interval '1' minute end as ap
    from (
      select o_orderkey as k, o_orderdate + (o_orderkey % 86400) * interval '1' second as p,
        case when o_orderstatus = 'F' then 'delivered' when o_orderstatus = 'O' then 'shipped'
             when o_orderkey % 3 = 0 then 'canceled' when o_orderkey % 3 = 1 then 'unavailable'
             else ' Processing ' end as st
      from {orders}) a) b) c
union all
select cast(o_orderkey as string), cast(o_orderkey as string), 'created',
  o_orderdate, null, null, null, o_orderdate + interval '14' day,
  cast(o_orderdate as date), {ts} '2001-12-31 00:00:00'
from {orders} where o_orderkey % 11 = 0
union all
select cast(o_orderkey as string), cast(o_orderkey as string), 'created',
  null, null, null, null, o_orderdate + interval '14' day,
  cast('2002-01-01' as date), {ts} '2001-12-31 00:00:00'
from {orders} where o_orderkey % 97 = 0
""",
)

_source(
    "src_customers",
    "orders customer",
    f"""
select cast(o_orderkey as string) as customer_id,
  cast(o_custkey as string) as customer_unique_id,
  cast(1000 + o_custkey % 900 as string) as customer_zip_code_prefix,
  concat(' ', lower(c_mktsegment), ' do sul ') as customer_city,
  lower({_STATE.format(k="c_nationkey")}) as customer_state, {_LOADED}
from {{orders}} join {{customer}} on o_custkey = c_custkey
""",
)

_source(
    "src_order_items",
    "lineitem",
    """
select cast(l_orderkey as string) as order_id, cast(l_linenumber as bigint) as order_item_id,
  cast(l_partkey as string) as product_id, cast(l_suppkey as string) as seller_id,
  l_shipdate as shipping_limit_date, l_extendedprice as price,
  cast(round(cast(l_extendedprice as decimal(18,2)) * cast(l_tax as decimal(4,2)), 2) as double)
    as freight_value,
  cast(l_shipdate as date) as ingest_date,
  {ts} '2002-01-01 00:00:00' + l_partkey * interval '1' second as _ingested_at
from {lineitem}
union all
select cast(l_orderkey as string), cast(l_linenumber as bigint), cast(l_partkey as string),
  cast(l_suppkey as string), null, l_extendedprice, cast(0 as double),
  cast('2001-12-31' as date), {ts} '2001-12-31 00:00:00'
from {lineitem} where l_orderkey % 89 = 0
""",
)

# Payments settle the order's deduplicated lines exactly; every twelfth order pays in
# two parts and every 300th has no payment at all. Each order is summed once and then
# taken apart into its payments.
_source(
    "src_order_payments",
    "stg_order_items",
    f"""
select cast(k as string) as order_id, cast(seq as bigint) as payment_sequential,
  case when seq = 2 then 'voucher' else case k % 4 when 0 then 'credit_card' when 1 then 'boleto'
      when 2 then 'Voucher ' else 'debit_card' end end as payment_type,
  cast(case when seq = 2 then 0 else k % 4 end as bigint) as payment_installments,
  cast(case when k % 12 <> 0 then t when seq = 1 then h else t - h end as double) as payment_value,
  {_LOADED}
from (
  select k, t, cast(round(t * cast('0.4' as decimal(2,1)), 2) as decimal(18,2)) as h,
    {{each}}(case when k % 12 = 0 then {{list}}(1, 2) else {{list}}(1) end) as seq
  from (select cast(order_id as bigint) as k, cast(sum(item_total) as decimal(18,2)) as t
        from {{stg_order_items}} group by cast(order_id as bigint)) a
  where k % 300 <> 0) z
""",
)

_source(
    "src_order_reviews",
    "orders",
    f"""
select concat('r', cast(o_orderkey as string)) as review_id,
  cast(o_orderkey as string) as order_id, 1 + o_orderkey % 5 as review_score,
  case when o_orderkey % 3 = 0 then '  ' else 'muito bom' end as review_comment_title,
  case when o_orderkey % 4 = 0 then '' else 'texto' end as review_comment_message,
  o_orderdate + (5 + o_orderkey % 20) * interval '1' day as review_creation_date,
  o_orderdate + (5 + o_orderkey % 20) * interval '1' day + (2 + o_orderkey % 239) * interval '1' hour
    as review_answer_timestamp, {_LOADED}
from {{orders}} where o_orderkey % 10 < 7
union all
select concat('s', cast(o_orderkey as string)), cast(o_orderkey as string),
  1 + o_orderkey % 4, null, 'segunda',
  o_orderdate + (4 + o_orderkey % 23) * interval '1' day,
  o_orderdate + (6 + o_orderkey % 23) * interval '1' day, {_LOADED}
from {{orders}} where o_orderkey % 13 = 0
""",
)

_source(
    "src_products",
    "part",
    f"""
select cast(p_partkey as string) as product_id,
  case when p_partkey % 64 = 0 then ' ' else lower(p_type) end as product_category_name,
  cast(length(p_name) as bigint) as product_name_lenght,
  cast(p_size * 10 as bigint) as product_description_lenght, 1 + p_partkey % 6 as product_photos_qty,
  case when p_partkey % 97 = 0 then null else cast(p_size * 250.0 as double) end as product_weight_g,
  cast(8.0 + p_size as double) as product_length_cm,
  cast(3.0 + p_partkey % 57 as double) as product_height_cm,
  cast(6.0 + p_partkey % 64 as double) as product_width_cm, {_LOADED}
from {{part}}
union all
select cast(p_partkey as string), 'outro', cast(1 as bigint), cast(1 as bigint),
  cast(1 as bigint), cast(1 as double), cast(1 as double), cast(1 as double), cast(1 as double),
  {_OLDER}
from {{part}} where p_partkey % 7 = 0
""",
)

_source(
    "src_sellers",
    "supplier",
    f"""
select cast(s_suppkey as string) as seller_id,
  cast(1000 + s_suppkey % 900 as string) as seller_zip_code_prefix,
  'sao paulo' as seller_city, {_STATE.format(k="s_nationkey")} as seller_state, {_LOADED}
from {{supplier}}
union all
select cast(s_suppkey as string), '1', 'santos', 'sp', {_OLDER}
from {{supplier}} where s_suppkey % 9 = 0
""",
)

_source(
    "src_geolocation",
    "customer",
    f"""
select cast(1000 + c_custkey % 900 as string) as geolocation_zip_code_prefix,
  case when c_custkey % 50 = 0 then cast(50 as double)
       else cast(-23.5 as double) + cast(c_custkey % 70 as double) / 100 end as geolocation_lat,
  cast(-46.6 as double) + cast(c_custkey % 90 as double) / 100 as geolocation_lng,
  lower(c_mktsegment) as geolocation_city, {_STATE.format(k="c_nationkey")} as geolocation_state,
  {_LOADED}
from {{customer}}
""",
)

# One category is left without a translation; one name is blank.
_source(
    "src_translation",
    "part",
    f"""
select product_category_name, product_category_name_english, {_LOADED}
from (
  select distinct concat(' ', lower(p_type)) as product_category_name,
    concat('en_', lower(p_type), ' ') as product_category_name_english
  from {{part}} where p_type <> 'ECONOMY'
  union all
  select distinct '  ', p_type from {{part}} where p_type = 'ECONOMY') t
""",
)

# A second look at the sellers: one in twenty moved, one in 33 left, one in ten is new.
_source(
    "src_sellers_later",
    "supplier",
    f"""
select cast(s_suppkey as string) as seller_id,
  cast(1000 + s_suppkey % 900 as string) as seller_zip_code_prefix,
  'sao paulo' as seller_city,
  case when s_suppkey % 20 = 0 then {_STATE.format(k="((s_nationkey + 1) % 25)")}
       else {_STATE.format(k="s_nationkey")} end as seller_state, {_LOADED}
from {{supplier}} where s_suppkey % 33 <> 1
union all
select concat('n', cast(s_suppkey as string)), '2000', 'campinas', 'SP', {_LOADED}
from {{supplier}} where s_suppkey % 10 = 0
""",
)

# Pipeline runs read off the event stream: an event is one task of a user's daily run.
_source(
    "src_runs",
    "events",
    """
select cast(ts as date) as run_date, 'daily' as dag_id, event_type as task_id,
  cast(user_id as string) as run_id, ts as started_at,
  case when event_id % 41 <> 0 then ts + cast(event_id % 600 as bigint) * interval '1' second end
    as finished_at,
  case when event_id % 17 <> 0 then value end as duration_seconds,
  case when event_type = 'error' then 'failed' else 'success' end as status,
  event_id % 1000 as rows_processed, props as details
from {events}
""",
)

SELLER_SNAPSHOTS = ("1995-01-01 00:00:00", "1998-01-01 00:00:00")
RAW_TABLES = {
    "customers": "src_customers",
    "geolocation": "src_geolocation",
    "order_items": "src_order_items",
    "order_payments": "src_order_payments",
    "order_reviews": "src_order_reviews",
    "orders": "src_orders",
    "products": "src_products",
    "sellers": "src_sellers",
    "product_category_translation": "src_translation",
}

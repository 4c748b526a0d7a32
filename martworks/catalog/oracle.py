"""Reference answers in SQL for the named queries, over the same test tables.

Each answer is one statement: the CTEs a query needs, then its final select."""

from __future__ import annotations

from martworks.catalog.lake import AS_OF, EARLIEST
from martworks.catalog.queries import INCREMENTAL_FROM, SUITE_BOUNDS, TIGHT_BOUNDS
from martworks.catalog.testdata import RAW_TABLES, SELLER_SNAPSHOTS, SOURCES
from martworks.functions.columns import REGION_STATES, UNKNOWN_REGION
from martworks.plans.descriptions import TABLES
from martworks.quality import declared
from martworks.quality.suites import build_suites
from martworks.sources.registry import get_table

CTES: dict[str, tuple[tuple[str, ...], str]] = {
    name: (
        needs,
        sql.format(ts="timestamp", each="unnest", list="list_value", **{n: n for n in needs}),
    )
    for name, (needs, sql) in SOURCES.items()
}
ORACLE: dict[str, str] = {}


def cte(name: str, needs: str, sql: str) -> None:
    CTES[name] = (tuple(needs.split()), sql)


def _with(needs, sql: str) -> str:
    seen: dict[str, str] = {}

    def add(name: str) -> None:
        if name in CTES and name not in seen:
            for other in CTES[name][0]:
                add(other)
            seen[name] = CTES[name][1]

    for n in needs:
        add(n)
    if not seen:
        return sql
    return "with " + ",\n".join(f"{n} as ({body})" for n, body in seen.items()) + "\n" + sql


def answer(name: str, needs: str, sql: str) -> None:
    ORACLE[name] = _with(needs.split(), sql)


def region(state: str) -> str:
    cases = " ".join(
        "when upper(trim({s})) in ({v}) then '{r}'".format(
            s=state, v=", ".join(f"'{c}'" for c in codes), r=name
        )
        for name, codes in REGION_STATES.items()
    )
    return f"(case {cases} else '{UNKNOWN_REGION}' end)"


def words(c: str) -> str:
    return (
        f"array_to_string([upper(w[1]) || w[2:] for w in string_split(lower(trim({c})), ' ')], ' ')"
    )


def zip5(c: str) -> str:
    return f"lpad(trim({c}), 5, '0')"


def n(c: str, scale: int = 2) -> str:
    return f"round(cast({c} as decimal(28,6)), {scale})"


def dbl(c: str) -> str:
    return f"cast({c} as double)"


def hours(a: str, b: str) -> str:
    return f"date_diff('hour', {a}, {b})"


def days(a: str, b: str) -> str:
    return f"date_diff('day', cast({a} as date), cast({b} as date))"


def latest(table: str, source: str, where: str = "true") -> str:
    t = get_table(table)
    rest = [c for c in [*t.columns, "ingest_date"] if c not in t.primary_key]
    order = ", ".join(f"{c} desc nulls last" for c in ["_ingested_at", *rest])
    keys = ", ".join(t.primary_key)
    return (
        f"(select distinct on ({keys}) * from {source} where {where} order by {keys}, {order})"
    )


cte(
    "stg_customers",
    "src_customers",
    f"""select customer_id, customer_unique_id, {zip5('customer_zip_code_prefix')} zip_code_prefix,
  {words('customer_city')} customer_city, upper(trim(customer_state)) customer_state,
  {region('customer_state')} customer_region, ingest_date
from {latest('customers', 'src_customers')}""",
)
cte(
    "stg_sellers",
    "src_sellers",
    f"""select seller_id, {zip5('seller_zip_code_prefix')} zip_code_prefix,
  {words('seller_city')} seller_city, upper(trim(seller_state)) seller_state,
  {region('seller_state')} seller_region, ingest_date
from {latest('sellers', 'src_sellers')}""",
)
cte(
    "stg_geolocation",
    "src_geolocation",
    f"""select {zip5('geolocation_zip_code_prefix')} zip_code_prefix,
  {words('geolocation_city')} city, upper(trim(geolocation_state)) state,
  geolocation_lat latitude, geolocation_lng longitude, ingest_date
from src_geolocation
where geolocation_lat >= -33.75 and geolocation_lat <= 5.27
  and geolocation_lng >= -73.99 and geolocation_lng <= -34.79""",
)
cte(
    "stg_orders",
    "src_orders",
    f"""select order_id, customer_id, lower(trim(order_status)) order_status,
  order_purchase_timestamp purchased_at, order_approved_at approved_at,
  order_delivered_carrier_date shipped_at, order_delivered_customer_date delivered_at,
  order_estimated_delivery_date estimated_delivery_at,
  cast(order_purchase_timestamp as date) purchased_date,
  cast(order_estimated_delivery_date as date) estimated_delivery_date,
  cast(order_delivered_customer_date as date) delivered_date, ingest_date
from {latest('orders', 'src_orders', f"order_purchase_timestamp >= timestamp '{EARLIEST}'")}""",
)
cte(
    "stg_order_items",
    "src_order_items",
    f"""select md5(order_id || '-' || cast(order_item_id as string)) order_item_key, order_id,
  order_item_id line_number, product_id, seller_id, shipping_limit_date shipping_limit_at,
  {n('price')} item_price, {n('freight_value')} freight_value,
  round(cast(price as decimal(28,6)) + cast(freight_value as decimal(28,6)), 2) item_total,
  ingest_date
from {latest('order_items', 'src_order_items', 'price >= 0 and freight_value >= 0')}""",
)
cte(
    "stg_payments",
    "src_order_payments",
    f"""select order_id, payment_sequential, lower(trim(payment_type)) payment_type,
  greatest(coalesce(payment_installments, 1), 1) payment_installments,
  {n('payment_value')} payment_value, ingest_date
from {latest('order_payments', 'src_order_payments', 'payment_value >= 0')}""",
)
cte(
    "stg_reviews",
    "src_order_reviews",
    f"""select review_id, order_id, review_score,
  nullif(trim(review_comment_title), '') review_title,
  nullif(trim(review_comment_message), '') review_message,
  review_creation_date review_created_at, review_answer_timestamp review_answered_at,
  length(trim(coalesce(review_comment_message, ''))) > 0 has_comment,
  ['detractor', 'detractor', 'passive', 'promoter', 'promoter'][review_score] review_sentiment,
  ingest_date
from {latest('order_reviews', 'src_order_reviews', 'review_score between 1 and 5')}""",
)
cte(
    "stg_translation",
    "src_translation",
    """select trim(product_category_name) category_name_pt,
  trim(max(product_category_name_english)) category_name_en, max(ingest_date) ingest_date
from src_translation where trim(product_category_name) <> '' group by 1""",
)
cte(
    "stg_products",
    "src_products stg_translation",
    f"""select product_id, coalesce(pt, 'unknown') category_name_pt,
  coalesce(category_name_en, 'unknown') category_name,
  product_name_lenght product_name_length,
  product_description_lenght product_description_length, product_photos_qty, product_weight_g,
  product_length_cm, product_height_cm, product_width_cm,
  {n('product_length_cm * product_height_cm * product_width_cm')} product_volume_cm3,
  p.ingest_date
from (select *, nullif(trim(product_category_name), '') pt
      from {latest('products', 'src_products')}) p
left join stg_translation t on t.category_name_pt = p.pt""",
)
cte(
    "payment_summary",
    "stg_payments",
    """select order_id, count(*) payment_count, count(distinct payment_type) payment_type_count,
  sum(payment_value) payment_total, max(payment_installments) max_installments,
  bool_or(payment_type = 'credit_card') used_credit_card,
  bool_or(payment_type = 'voucher') used_voucher,
  first(payment_type order by payment_value desc, payment_sequential) primary_payment_type,
  first(payment_installments order by payment_value desc, payment_sequential)
    primary_payment_installments
from stg_payments group by order_id""",
)
cte(
    "dominant_category",
    "stg_order_items stg_products",
    """select order_id, category_name, revenue from (
  select order_id, category_name, revenue,
    rank() over (partition by order_id order by revenue desc, category_name nulls last) r
  from (select order_id, category_name, sum(item_price) revenue
        from stg_order_items left join stg_products using (product_id)
        group by order_id, category_name) x) y where r = 1""",
)
cte(
    "item_summary",
    "stg_order_items dominant_category",
    """select s.*, d.category_name primary_category from (
  select order_id, count(*) item_count, count(distinct product_id) distinct_product_count,
    count(distinct seller_id) distinct_seller_count, sum(item_price) gross_item_revenue,
    sum(freight_value) freight_revenue, sum(item_total) order_item_total,
    max(item_price) max_item_price, min(item_price) min_item_price
  from stg_order_items group by order_id) s
left join dominant_category d using (order_id)""",
)
cte(
    "review_summary",
    "stg_reviews",
    f"""select order_id, count(*) review_count,
  cast(sum(review_score) as double) / count(*) avg_review_score,
  min(review_score) min_review_score, bool_or(has_comment) has_any_comment,
  first(review_score order by review_created_at, review_id) first_review_score,
  first(review_sentiment order by review_created_at, review_id) first_review_sentiment,
  min(review_created_at) first_review_created_at,
  first({hours('review_created_at', 'review_answered_at')} order by review_created_at, review_id)
    review_response_hours
from stg_reviews group by order_id""",
)
cte(
    "delivery_timeline",
    "stg_orders",
    f"""select order_id, customer_id, order_status, purchased_at, approved_at, shipped_at,
  delivered_at, estimated_delivery_at, purchased_date, estimated_delivery_date, delivered_date,
  {hours('purchased_at', 'approved_at')} hours_to_approval,
  {hours('approved_at', 'shipped_at')} hours_to_carrier,
  {days('purchased_at', 'delivered_at')} days_to_delivery,
  {days('shipped_at', 'delivered_at')} days_in_transit,
  delivered_date - estimated_delivery_date delivery_vs_promise_days,
  estimated_delivery_date - purchased_date promised_lead_days,
  delivered_at is not null is_delivered, order_status = 'canceled' is_canceled,
  delivered_date > estimated_delivery_date is_late,
  case when order_status = 'canceled' then 'canceled'
       when delivered_date > estimated_delivery_date then 'delivered_late'
       when delivered_date is not null then 'delivered_on_time'
       when shipped_at is not null then 'in_transit'
       when approved_at is not null then 'approved' else 'pending' end delivery_status,
  order_status = 'delivered' and delivered_at is null is_missing_delivery_timestamp
from stg_orders""",
)
cte(
    "line_context",
    "stg_order_items delivery_timeline stg_customers stg_products stg_sellers",
    """select i.* exclude (ingest_date), i.ingest_date, d.* exclude (order_id),
  c.customer_unique_id, c.customer_state, c.customer_region,
  p.category_name, p.category_name_pt, p.product_weight_g, p.product_volume_cm3,
  s.seller_state, s.seller_region, s.seller_state = c.customer_state is_intrastate_shipment
from stg_order_items i join delivery_timeline d using (order_id)
left join stg_customers c on c.customer_id = d.customer_id
left join stg_products p on p.product_id = i.product_id
left join stg_sellers s on s.seller_id = i.seller_id""",
)
cte(
    "items_enriched",
    "line_context",
    """select order_item_key, order_id, line_number, product_id, seller_id, customer_id,
  customer_unique_id, purchased_at, purchased_date, shipping_limit_at, order_status,
  category_name, category_name_pt, seller_state, seller_region, customer_state, customer_region,
  is_intrastate_shipment, product_weight_g, product_volume_cm3, item_price, freight_value,
  item_total, ingest_date from line_context""",
)
cte(
    "fct_order_items",
    "line_context",
    """select order_item_key, order_id order_key, line_number, product_id product_key,
  seller_id seller_key, customer_id customer_key, customer_unique_id,
  purchased_date purchased_date_key, order_status, delivery_status, category_name, seller_state,
  seller_region, customer_state, customer_region, is_intrastate_shipment, purchased_at,
  shipping_limit_at, item_price, freight_value, item_total,
  round(cast(freight_value as double) / cast(nullif(item_price, 0) as double), 4) freight_ratio,
  product_weight_g, product_volume_cm3, is_delivered, is_late, days_to_delivery, purchased_date
from line_context""",
)
cte(
    "fct_orders",
    "delivery_timeline stg_customers item_summary payment_summary review_summary",
    f"""select d.order_id order_key, d.customer_id customer_key, customer_unique_id,
  purchased_date purchased_date_key, estimated_delivery_date estimated_delivery_date_key,
  delivered_date delivered_date_key, order_status, delivery_status, customer_state,
  customer_region, zip_code_prefix customer_zip_code_prefix, primary_category,
  primary_payment_type, purchased_at, approved_at, shipped_at, delivered_at,
  estimated_delivery_at, ifnull(item_count, 0) item_count,
  ifnull(distinct_product_count, 0) distinct_product_count,
  ifnull(distinct_seller_count, 0) distinct_seller_count,
  ifnull(gross_item_revenue, 0) gross_item_revenue, ifnull(freight_revenue, 0) freight_revenue,
  ifnull(order_item_total, 0) order_total, ifnull(payment_total, 0) payment_total,
  ifnull(payment_count, 0) payment_count, max_installments, ifnull(review_count, 0) review_count,
  {n('avg_review_score', 3)} avg_review_score, first_review_score, first_review_sentiment,
  hours_to_approval, days_to_delivery, days_in_transit, promised_lead_days,
  delivery_vs_promise_days, is_delivered, is_canceled, is_late,
  ifnull(payment_total, 0) - ifnull(order_item_total, 0) payment_variance,
  is_missing_delivery_timestamp, payment_count is null is_missing_payment,
  item_count is null is_missing_items, purchased_date
from delivery_timeline d left join stg_customers c on c.customer_id = d.customer_id
left join item_summary i on i.order_id = d.order_id
left join payment_summary p on p.order_id = d.order_id
left join review_summary r on r.order_id = d.order_id""",
)
cte(
    "modal_place",
    "stg_geolocation",
    """select distinct on (zip_code_prefix) zip_code_prefix, city, state, observations
from (select zip_code_prefix, city, state, count(*) observations
      from stg_geolocation group by all) g
order by zip_code_prefix, observations desc, city, state""",
)
cte(
    "dim_geography",
    "stg_geolocation modal_place",
    f"""select zip_code_prefix, any_value(m.city) city, any_value(m.state) state,
  {region('any_value(m.state)')} region, {n('avg(latitude)', 6)} latitude,
  {n('avg(longitude)', 6)} longitude, count(*) observation_count
from stg_geolocation g join modal_place m using (zip_code_prefix) group by zip_code_prefix""",
)
cte(
    "person",
    "stg_customers stg_orders item_summary",
    """select customer_unique_id, count(*) lifetime_order_count,
  sum(ifnull(order_item_total, 0)) lifetime_gross_value, min(purchased_date) first_order_date,
  max(purchased_date) most_recent_order_date
from stg_orders o join stg_customers c on c.customer_id = o.customer_id
left join item_summary i on i.order_id = o.order_id group by customer_unique_id""",
)
cte(
    "dim_customers",
    "stg_customers person dim_geography",
    """select customer_id customer_key, c.customer_unique_id, c.zip_code_prefix,
  ifnull(g.city, customer_city) customer_city, customer_state, customer_region, latitude,
  longitude, lifetime_order_count, lifetime_gross_value, first_order_date,
  most_recent_order_date, lifetime_order_count > 1 is_repeat_customer,
  g.city is null is_missing_geography
from stg_customers c left join person p on p.customer_unique_id = c.customer_unique_id
left join dim_geography g on g.zip_code_prefix = c.zip_code_prefix""",
)
cte(
    "dim_products",
    "stg_products stg_order_items",
    f"""select p.product_id product_key, category_name, category_name_pt, product_name_length,
  product_description_length, product_photos_qty, product_weight_g, product_length_cm,
  product_height_cm, product_width_cm, product_volume_cm3,
  case when product_weight_g >= 10000 then 'oversized' when product_weight_g >= 2000 then 'heavy'
       when product_weight_g >= 500 then 'medium' when product_weight_g is not null then 'light'
       else 'unknown' end weight_class,
  count(order_id) units_sold, count(distinct order_id) orders_containing_product,
  count(distinct seller_id) seller_count, ifnull(sum(item_price), 0) gross_revenue,
  {n('cast(sum(item_price) as double) / nullif(count(item_price), 0)')} avg_selling_price,
  category_name = 'unknown' is_uncategorised, count(order_id) = 0 is_never_sold
from stg_products p left join stg_order_items i on i.product_id = p.product_id group by all""",
)
cte(
    "dim_sellers",
    "stg_sellers line_context dim_geography",
    f"""select s.seller_id seller_key, ifnull(g.city, s.seller_city) seller_city, s.seller_state,
  s.seller_region, s.zip_code_prefix, latitude, longitude, count(distinct order_id) order_count,
  count(order_id) items_sold, ifnull(sum(item_price), 0) gross_revenue,
  ifnull(sum(freight_value), 0) freight_charged, min(purchased_date) first_sale_date,
  max(purchased_date) most_recent_sale_date,
  count(distinct order_id) filter (is_delivered) delivered_order_count,
  count(distinct order_id) filter (is_late) late_order_count,
  round(cast(late_order_count as double) / nullif(delivered_order_count, 0), 4)
    late_delivery_rate,
  {n('avg(days_to_delivery)')} avg_days_to_delivery
from stg_sellers s left join line_context l on l.seller_id = s.seller_id
left join dim_geography g on g.zip_code_prefix = s.zip_code_prefix
group by s.seller_id, g.city, s.seller_city, s.seller_state, s.seller_region,
  s.zip_code_prefix, latitude, longitude""",
)
cte(
    "dim_date",
    "",
    """select d date_key, cast(d - (isodow(d) - 1) * interval 1 day as date) week_start_date,
  make_date(year(d), month(d), 1) month_start_date,
  make_date(year(d), quarter(d) * 3 - 2, 1) quarter_start_date,
  make_date(year(d), 1, 1) year_start_date, year(d) calendar_year,
  quarter(d) calendar_quarter, month(d) calendar_month, day(d) day_of_month,
  isodow(d) iso_day_of_week, isodow(d) > 5 is_weekend,
  printf('%d-Q%d', year(d), quarter(d)) year_quarter, year(d) * 100 + month(d) year_month_key
from (select cast(unnest(range(make_date(cast(min(year(o_orderdate)) as int), 1, 1),
        make_date(cast(max(year(o_orderdate)) + 1 as int), 1, 1), interval 1 day)) as date) d
      from orders) x""",
)
cte(
    "agg_daily_performance",
    "fct_order_items fct_orders",
    f"""select i.*, orders_placed, orders_delivered, orders_late,
  round(cast(orders_late as double) / nullif(orders_delivered, 0), 4) late_delivery_rate,
  avg_days_to_delivery, avg_review_score
from (
  select purchased_date, customer_state, customer_region, category_name, count(*) item_count,
    count(distinct order_key) order_count, count(distinct seller_key) seller_count,
    sum(item_price) gross_item_revenue, sum(freight_value) freight_revenue,
    sum(item_total) total_revenue,
    {n('cast(sum(cast(freight_ratio as decimal(18,4))) as double) / nullif(count(freight_ratio), 0)', 4)}
      avg_freight_ratio
  from fct_order_items group by all) i
left join (
  select purchased_date, customer_state, count(*) orders_placed,
    count(*) filter (is_delivered) orders_delivered, count(*) filter (is_late) orders_late,
    {n('avg(days_to_delivery)')} avg_days_to_delivery,
    {n('cast(sum(cast(avg_review_score as decimal(18,3))) as double) / nullif(count(avg_review_score), 0)', 3)}
      avg_review_score
  from fct_orders group by all) o
on o.purchased_date = i.purchased_date and o.customer_state = i.customer_state""",
)
_t1, _t2 = (f"timestamp '{t}'" for t in SELLER_SNAPSHOTS)
cte(
    "stg_sellers_later",
    "src_sellers_later",
    CTES["stg_sellers"][1].replace("src_sellers", "src_sellers_later"),
)
# Three kinds of rows: what the first load opened (closed at the second load where it
# changed or went missing), and what the second load opened.
cte(
    "seller_snapshot",
    "stg_sellers stg_sellers_later",
    f"""select a.seller_id, a.zip_code_prefix, a.seller_city, a.seller_state, a.seller_region,
  {_t1} valid_from,
  case when b.seller_id is null or (a.zip_code_prefix, a.seller_city, a.seller_state)
            is distinct from (b.zip_code_prefix, b.seller_city, b.seller_state)
       then {_t2} end valid_to
from stg_sellers a left join stg_sellers_later b using (seller_id)
union all
select b.seller_id, b.zip_code_prefix, b.seller_city, b.seller_state, b.seller_region,
  {_t2}, null
from stg_sellers_later b where not exists (
  select 1 from stg_sellers a where a.seller_id = b.seller_id
    and (a.zip_code_prefix, a.seller_city, a.seller_state)
        is not distinct from (b.zip_code_prefix, b.seller_city, b.seller_state))""",
)
cte(
    "dim_sellers_history",
    "seller_snapshot",
    """select md5(seller_id || '-' || strftime(valid_from, '%Y-%m-%d %H:%M:%S')) seller_version_key,
  seller_id seller_key, seller_city, seller_state, seller_region, zip_code_prefix, valid_from,
  valid_to, valid_to is null is_current,
  1 + (select count(*) from seller_snapshot e
       where e.seller_id = s.seller_id and e.valid_from < s.valid_from) version_number
from seller_snapshot s""",
)

# Columns that are exact decimals in a model and doubles in a result.
_MONEY = {
    "stg_order_items": "item_price freight_value item_total",
    "stg_payments": "payment_value",
    "stg_products": "product_volume_cm3",
    "payment_summary": "payment_total",
    "item_summary": "gross_item_revenue freight_revenue order_item_total max_item_price "
    "min_item_price",
    "items_enriched": "item_price freight_value item_total product_volume_cm3",
    "fct_orders": "gross_item_revenue freight_revenue order_total payment_total "
    "avg_review_score payment_variance",
    "fct_order_items": "item_price freight_value item_total product_volume_cm3",
    "dim_customers": "lifetime_gross_value latitude longitude",
    "dim_products": "product_volume_cm3 gross_revenue avg_selling_price",
    "dim_sellers": "gross_revenue freight_charged latitude longitude avg_days_to_delivery",
    "dim_geography": "latitude longitude",
    "agg_daily_performance": "gross_item_revenue freight_revenue total_revenue "
    "avg_freight_ratio avg_days_to_delivery avg_review_score",
    "dominant_category": "revenue",
}
_BIGINT = {
    "dim_date": "calendar_year calendar_quarter calendar_month day_of_month iso_day_of_week "
    "year_month_key",
    "stg_products": "product_photos_qty",
}


def _shared_types(name: str) -> str:
    casts = [f"cast({c} as double) as {c}" for c in _MONEY.get(name, "").split()]
    casts += [f"cast({c} as bigint) as {c}" for c in _BIGINT.get(name, "").split()]
    return f"select * replace ({', '.join(casts)}) from {name}" if casts else f"select * from {name}"


for _name in (
    "stg_customers stg_orders stg_order_items stg_payments stg_reviews stg_geolocation "
    "stg_translation stg_products stg_sellers payment_summary item_summary review_summary "
    "delivery_timeline items_enriched fct_orders fct_order_items dim_customers dim_products "
    "dim_sellers dim_geography dim_date agg_daily_performance dim_sellers_history "
    "dominant_category modal_place"
).split():
    answer(_name, _name, _shared_types(_name))

# sources and landing

answer(
    "typed_csv_scan",
    "src_orders",
    f"select {', '.join(get_table('orders').columns)} from src_orders",
)
answer(
    "land_window_rows",
    "src_order_items",
    f"""select {', '.join(get_table('order_items').columns)} from src_order_items
where shipping_limit_date is null or (shipping_limit_date >= timestamp '1997-03-01'
  and shipping_limit_date < timestamp '1997-04-01')""",
)
answer(
    "landed_by_day",
    "src_orders",
    """select coalesce(cast(order_purchase_timestamp as date), date '2002-01-01') ingest_date,
  count(*) row_count from src_orders group by 1""",
)
answer(
    "landing_roundtrip",
    "src_runs src_sellers",
    """select 'runs' as "table", cast(started_at as date) ingest_date, count(*) row_count
from src_runs group by 2
union all select 'sellers', date '2024-01-09', count(*) from src_sellers""",
)
answer(
    "landed_lineage",
    "src_orders src_sellers",
    """select "table", row_count, source_file, cast(1 as bigint) files, cast(1 as bigint) "days",
  cast(0 as bigint) without_time, cast(1 as bigint) runs from (
  select 'orders' as "table", count(*) row_count, 'orders.csv' source_file from src_orders
  where order_purchase_timestamp is null
    or cast(order_purchase_timestamp as date) = date '1999-03-03'
  union all select 'sellers', count(*), 'sellers.csv' from src_sellers) t""",
)
answer(
    "widened_files",
    "src_orders",
    """select channel, count(*) row_count, count(distinct d) "days" from (
  select null as channel, cast(d as date) d
  from src_orders, range(date '1999-03-01', date '1999-03-11', interval 1 day) days(d)
  where d <> date '1999-03-04' and (order_purchase_timestamp is null
    or cast(order_purchase_timestamp as date) = cast(d as date))
  union all
  select case when order_status = 'delivered' then 'shop' else 'app' end, date '1999-03-04'
  from src_orders where order_purchase_timestamp is null
    or cast(order_purchase_timestamp as date) = date '1999-03-03') x group by 1""",
)
answer(
    "load_results",
    "src_order_items src_sellers",
    """select 'all' step, 'order_items' as "table", count(*) row_count, cast(null as string) as "day"
from src_order_items, range(5) days(d) where shipping_limit_date is null
  or cast(shipping_limit_date as date) = date '1999-03-01' + cast(d as int)
union all select 'all', 'sellers', 5 * count(*), null from src_sellers
union all select 'day', 'order_items', count(*), '1999-03-03' from src_order_items
  where shipping_limit_date is null or cast(shipping_limit_date as date) = date '1999-03-03'
union all select 'day', 'sellers', count(*), null from src_sellers""",
)
answer(
    "stored_descriptions",
    "dim_sellers",
    """select 'seller_key' as "column", 'Seller id of the source' as comment,
  count(seller_key) as "values" from dim_sellers
union all select 'order_count', 'Orders with a line of the seller', count(order_count) from dim_sellers
union all select 'late_delivery_rate', 'Late orders per delivered order; NULL without any',
  count(late_delivery_rate) from dim_sellers""",
)
answer(
    "landing_metrics",
    "src_runs src_sellers",
    """select 'runs' as "table", count(distinct cast(started_at as date)) partitions,
  count(*) row_count from src_runs
union all select 'sellers', 1, count(*) from src_sellers""",
)
answer(
    "backfill_days",
    "src_order_items",
    """select cast(d as date) ingest_date, count(*) row_count
from src_order_items, range(date '1996-01-10', date '1996-02-09', interval 1 day) days(d)
where shipping_limit_date is null or cast(shipping_limit_date as date) = cast(d as date)
group by 1""",
)
answer(
    "window_intersection",
    "src_orders",
    "select distinct order_id from src_orders where order_purchase_timestamp is null",
)
answer(
    "seller_key_drift",
    "src_sellers src_sellers_later",
    """select seller_id, 'left' only_in from src_sellers
where seller_id not in (select seller_id from src_sellers_later)
union select seller_id, 'right' from src_sellers_later
where seller_id not in (select seller_id from src_sellers)""",
)

# history

answer("scd2_snapshot_two_loads", "seller_snapshot", "select * from seller_snapshot")
answer(
    "scd2_point_in_time_revenue",
    "line_context dim_sellers_history",
    """select h.seller_state historic_state, h.seller_region historic_region, count(*) lines,
  cast(sum(item_total) as double) revenue
from line_context l join dim_sellers_history h on h.seller_key = l.seller_id
  and l.purchased_at >= h.valid_from
  and l.purchased_at < coalesce(h.valid_to, timestamp '9999-12-31') group by 1, 2""",
)
cte(
    "part_versions",
    "",
    """select l_partkey part_key, concat(l_orderkey, '-', l_linenumber) version_key,
  l_shipdate valid_from, case when l_quantity < 49
    then l_shipdate + (l_suppkey % 40 - 3) * interval '1' day end valid_to from lineitem""",
)
cte(
    "seller_versions",
    "dim_sellers_history",
    """select seller_key, seller_version_key version_key, valid_from, valid_to
from dim_sellers_history""",
)


def _violations(relation: str, key: str) -> str:
    return f"""select {key}, 'expected exactly one open version' violation from {relation}
where valid_to is null group by {key} having count(*) > 1
union all select distinct {key}, 'valid_to precedes valid_from' from {relation}
where valid_to <= valid_from
union all select distinct a.{key}, 'versions overlap in time'
from {relation} a join {relation} b on a.{key} = b.{key} and a.version_key <> b.version_key
  and a.valid_from < coalesce(b.valid_to, timestamp '9999-12-31')
  and coalesce(a.valid_to, timestamp '9999-12-31') > b.valid_from"""


answer("scd2_overlap_violations", "part_versions", _violations("part_versions", "part_key"))
answer("scd2_seller_violations", "seller_versions", _violations("seller_versions", "seller_key"))
answer(
    "scd2_summary",
    "dim_sellers_history",
    """select count(*) versions, count(distinct seller_key) sellers,
  count(*) filter (is_current) current_versions,
  count(*) filter (version_number > 1) superseding_versions from dim_sellers_history""",
)
answer(
    "scd2_changed_sellers",
    "dim_sellers_history",
    """select seller_key, version_number, seller_city, seller_state, valid_from, valid_to,
  is_current from dim_sellers_history where seller_key in (
  select seller_key from dim_sellers_history group by 1 having count(*) > 1
  order by 1 limit 3)""",
)
# The order fact as the later raw rows give it: first payments and first reviews only.
_LATER = {"stg_payments": "payment_sequential = 1", "stg_reviews": "review_id not like 's%'"}
for _name, _where in _LATER.items():
    cte(f"{_name}_later", _name, f"select * from {_name} where {_where}")
for _name, _from in (("payment_summary", "stg_payments"), ("review_summary", "stg_reviews")):
    cte(f"{_name}_later", f"{_from}_later", CTES[_name][1].replace(_from, f"{_from}_later"))
cte(
    "fct_orders_later",
    "delivery_timeline stg_customers item_summary payment_summary_later review_summary_later",
    CTES["fct_orders"][1]
    .replace("join payment_summary", "join payment_summary_later")
    .replace("join review_summary", "join review_summary_later"),
)
cte(
    "fct_orders_twice",
    "fct_orders fct_orders_later",
    f"""select f.* from fct_orders f, (select max(purchased_date) - 7 s from fct_orders
    where purchased_date < date '{INCREMENTAL_FROM}') x where purchased_date < s
  union all
  select f.* from fct_orders_later f, (select max(purchased_date) - 7 s from fct_orders
    where purchased_date < date '{INCREMENTAL_FROM}') x where purchased_date >= s""",
)
_MONEY["fct_orders_twice"] = _MONEY["fct_orders"]
answer("incremental_equals_full", "fct_orders_twice", _shared_types("fct_orders_twice"))
answer("incremental_late_lines", "fct_orders", _shared_types("fct_orders"))
answer(
    "incremental_dimensions",
    "dim_customers dim_sellers dim_products",
    """select distinct 'customer' as dimension, customer_unique_id as key,
  cast(lifetime_order_count as bigint) as orders, cast(null as bigint) as units,
  cast(lifetime_gross_value as double) as value, first_order_date as first_day,
  most_recent_order_date as last_day
from dim_customers
union all
select 'seller', seller_key, order_count, items_sold, cast(gross_revenue as double), first_sale_date,
  most_recent_sale_date
from dim_sellers
union all
select 'product', product_key, orders_containing_product, units_sold, cast(gross_revenue as double), null, null
from dim_products""",
)
answer(
    "incremental_added_column",
    "stg_orders",
    f"""select case when purchased_date < date '{INCREMENTAL_FROM}' then null
    when order_status = 'delivered' then 'shop' else 'app' end as channel,
  count(*) as row_count, count(distinct date_trunc('month', purchased_date)) as months
from stg_orders group by 1""",
)
answer(
    "published_marts",
    "dim_geography dim_products",
    "select target, mart, row_count, comment from (select unnest(['dev', 'ci']) as target) t, ("
    + " union all ".join(
        f"select '{name}' as mart, count(*) as row_count, '{TABLES[name][0]}' as comment from {name}"
        for name in ("dim_geography", "dim_products")
    )
    + ") m",
)
answer(
    "index_partitions",
    "src_order_items src_orders",
    """select ingest_date, count(*) as row_count, count(distinct order_id) as orders,
  count(*) over () as partitions
from src_order_items
where order_id in (select order_id from src_orders where order_purchase_timestamp >= timestamp '1997-12-01'
  and order_purchase_timestamp < timestamp '1997-12-08')
group by ingest_date""",
)
answer(
    "incremental_partitions",
    "stg_orders",
    f"""select cast(case when purchased_date < s and cast(order_id as bigint) % 50 = 0
    then date_trunc('month', purchased_date) + interval 1 month
    else date_trunc('month', purchased_date) end as date) purchased_month,
  count(*) row_count, count(distinct order_id) orders
from stg_orders, (select max(purchased_date) - 7 s from stg_orders
  where purchased_date < date '{INCREMENTAL_FROM}') x group by 1""",
)

# data tests


def _check_sql(check, alias) -> str:
    column, source = check.columns[0], alias(check.model)
    if check.kind == "not_null":
        failures = f"(select count(*) from {source} where {column} is null)"
    elif check.kind == "accepted_values":
        values = ", ".join(repr(v) for v in check.values)
        failures = f"(select count(*) from {source} where {column} not in ({values}))"
    elif check.kind == "value_length":
        failures = f"(select count(*) from {source} where length({column}) <> {check.length})"
    elif check.kind == "between":
        bad = [f"{column} < {check.low}"] if check.low is not None else []
        bad += [f"{column} > {check.high}"] if check.high is not None else []
        failures = f"(select count(*) from {source} where {' or '.join(bad)})"
    elif check.kind == "relationship":
        parent = alias(check.parent)
        failures = (
            f"(select count(*) from {source} c where {column} is not null and not exists "
            f"(select 1 from {parent} p where p.{check.parent_column} = c.{column}))"
        )
    else:
        some = "true" if check.kind == "unique_combination" else f"{column} is not null"
        failures = (
            f"(select count(*) from (select 1 from {source} where {some} "
            f"group by {', '.join(check.columns)} having count(*) > 1) g)"
        )
    return (
        f"select '{check.model}' model, '{check.kind}' as \"check\", "
        f"'{check.column}' as \"column\", cast({failures} as bigint) failures"
    )


def _checks(name: str, wanted, alias=lambda m: m) -> None:
    needs = {alias(c.model) for c in wanted} | {alias(c.parent) for c in wanted if c.parent}
    answer(name, " ".join(sorted(needs)), "\nunion all ".join(_check_sql(c, alias) for c in wanted))


_checks("checks_sources", declared.SOURCE_CHECKS, lambda m: RAW_TABLES[m[len("raw_"):]])
_checks("checks_staging", declared.STAGING_CHECKS)
_checks("checks_intermediate", declared.INTERMEDIATE_CHECKS)
_checks("checks_marts", declared.MART_CHECKS)
_checks(
    "null_counts",
    [c for c in declared.MART_CHECKS if c.model == "fct_order_items" and c.kind == "not_null"],
)
answer(
    "duplicate_keys",
    "src_order_items",
    """select order_id, order_item_id, count(*) n from src_order_items
group by all having count(*) > 1""",
)
answer(
    "duplicate_order_ids",
    "src_orders",
    "select order_id, count(*) n from src_orders group by 1 having count(*) > 1",
)
answer(
    "length_and_range_violations",
    "src_products",
    """select product_id, product_category_name, cast(rules_broken as bigint) rules_broken from (
  select *, ifnull(cast(product_photos_qty not between 2 and 5 as int), 0)
    + ifnull(cast(product_weight_g < 500 as int), 0)
    + ifnull(cast(length(product_category_name) <> 8 as int), 0) rules_broken
  from src_products) p where rules_broken > 0""",
)
answer(
    "accepted_values_violations",
    "src_order_payments",
    f"""select {', '.join(get_table('order_payments').columns)} from src_order_payments
where payment_type <> trim(payment_type) or payment_type <> lower(payment_type)""",
)
answer(
    "stored_violations",
    "src_order_payments",
    """select payment_type, count(*) row_count, count(distinct order_id) orders
from src_order_payments
where payment_type <> trim(payment_type) or payment_type <> lower(payment_type) group by 1""",
)
answer(
    "orphan_lines",
    "stg_order_items stg_orders",
    """select order_id, count(*) n from stg_order_items
where order_id not in (select order_id from stg_orders) group by 1""",
)
answer(
    "checks_with_severity",
    "fct_orders",
    """select flag as "check", failures, case when failures > 250 then 'error'
  when failures > 0 then 'warn' else 'pass' end status from (
  unpivot (select count(*) filter (is_missing_payment) is_missing_payment,
    count(*) filter (is_missing_items) is_missing_items,
    count(*) filter (is_missing_delivery_timestamp) is_missing_delivery_timestamp
    from fct_orders) on columns(*) into name flag value failures) u""",
)
answer(
    "freshness",
    "src_orders src_order_items src_sellers",
    """select name as "table", max_loaded_at, case
  when epoch(timestamp '2002-01-02 12:00:00') - epoch(max_loaded_at) > 48 * 3600 then 'error'
  when epoch(timestamp '2002-01-02 12:00:00') - epoch(max_loaded_at) > 24 * 3600 then 'warn'
  else 'pass' end status
from (select 'orders' as name, max(_ingested_at) max_loaded_at from src_orders
  union all select 'order_items', max(_ingested_at) from src_order_items
  union all select 'sellers', max(_ingested_at) from src_sellers) m""",
)

# invariants

answer(
    "agg_vs_fact",
    "fct_order_items agg_daily_performance",
    """select * from (select
  (select count(*) from fct_order_items) fact_item_count,
  (select cast(sum(item_count) as bigint) from agg_daily_performance) agg_item_count,
  (select cast(sum(item_price) as double) from fct_order_items) fact_revenue,
  (select cast(sum(gross_item_revenue) as double) from agg_daily_performance) agg_revenue,
  (select cast(sum(item_total) as double) from fct_order_items) fact_total,
  (select cast(sum(total_revenue) as double) from agg_daily_performance) agg_total) t
where fact_item_count <> agg_item_count or abs(fact_revenue - agg_revenue) > 0.01
   or abs(fact_total - agg_total) > 0.01""",
)
answer(
    "agg_vs_fact_broken",
    "fct_order_items",
    """select count(*) fact_item_count,
  count(*) filter (order_status <> 'shipped') agg_item_count,
  cast(sum(item_price) as double) fact_revenue,
  cast(sum(item_price) filter (order_status <> 'shipped') as double) agg_revenue,
  cast(sum(item_total) as double) fact_total,
  cast(sum(item_total) filter (order_status <> 'shipped') as double) agg_total
from fct_order_items""",
)


def _rollup_gap(lines: str) -> str:
    return f"""select order_key, item_count order_item_count,
  cast(gross_item_revenue as double) order_revenue, cast(order_total as double) order_total,
  rolled_item_count, cast(rolled_revenue as double) rolled_revenue,
  cast(rolled_total as double) rolled_total
from fct_orders join (select order_key, count(*) rolled_item_count,
    sum(item_price) rolled_revenue, sum(item_total) rolled_total
  from {lines} group by 1) r using (order_key)
where item_count <> rolled_item_count or abs(gross_item_revenue - rolled_revenue) > 0.01
   or abs(order_total - rolled_total) > 0.01"""


answer("lines_vs_orders", "fct_orders fct_order_items", _rollup_gap("fct_order_items"))
answer(
    "lines_vs_orders_broken",
    "fct_orders fct_order_items",
    _rollup_gap(
        "(select * from fct_order_items union all "
        "select * from fct_order_items where product_key = '7') x"
    ),
)
_UNSETTLED = """select order_key, cast(order_total as double) order_total,
  cast({paid} as double) payment_total, cast({paid} - order_total as double) payment_variance
from fct_orders f where not is_missing_payment and not is_missing_items
  and abs({paid} - order_total) > 0.01"""
answer("payments_vs_orders", "fct_orders", _UNSETTLED.format(paid="payment_total"))
answer(
    "payments_vs_orders_broken",
    "fct_orders stg_payments",
    """select order_key, cast(order_total as double) order_total,
  cast(payment_value as double) payment_total,
  cast(payment_value - order_total as double) payment_variance
from fct_orders join stg_payments on order_id = order_key and payment_sequential = 1
where not is_missing_items and abs(payment_value - order_total) > 0.01""",
)
answer(
    "impossible_dates",
    "stg_orders",
    """select order_id order_key, purchased_at, delivered_at, violation from (
  select *, unnest(['purchased in the future', 'delivered before purchase',
    'purchased before the business existed']) violation from stg_orders) o
where case violation when 'purchased in the future' then purchased_at > timestamp '2001-01-01'
  when 'delivered before purchase' then delivered_at < purchased_at
  else purchased_at < timestamp '1995-06-01' end""",
)
answer(
    "completeness_rows",
    "fct_orders",
    """select order_key, order_status, delivery_status, is_missing_payment, is_missing_items,
  is_missing_delivery_timestamp from fct_orders
where is_missing_payment or is_missing_items or is_missing_delivery_timestamp""",
)
_SLA = """select count(*) delivered_orders, count(*) filter (is_late) late_orders,
  cast(count(*) filter (is_late) as double) / count(*) late_rate
from delivery_timeline where is_delivered"""
answer("sla_rate", "delivery_timeline", _SLA)
answer(
    "sla_implausible",
    "delivery_timeline",
    f"select * from ({_SLA}) s where late_rate <= 0 or late_rate >= 0.05",
)

# distributions


def _expectation_sql(suite: str, table: str, e) -> str:
    low, high, c = e.low, e.high, e.column
    name = e.kind if e.probability is None else f"{e.kind}[{e.probability}]"
    inside = lambda v: " and ".join(
        [f"{v} >= {low}"] * (low is not None) + [f"{v} <= {high}"] * (high is not None)
    )
    observed = considered = bad = "cast(null as double)"
    if e.kind == "row_count_between":
        low, high = (f"(select count(*) from orders) * {f}" for f in _SCALE[table])
        low, high = f"floor({low})", f"floor({high})"
        observed = considered = "count(*)"
        ok = inside("count(*)")
    elif e.kind == "mean_between":
        observed, considered = f"avg({c})", f"count({c})"
        ok = inside(f"avg({c})")
    elif e.kind == "quantile_between":
        observed = f"quantile_disc({c}, {e.probability})"
        ok = inside(observed)
    elif e.kind == "values_unique":
        considered = f"count({c})"
        bad = f"(select ifnull(sum(k), 0) from (select count(*) k from {table} where {c} is not null group by {c} having count(*) > 1) g)"
        ok = f"{bad} = 0"
    else:
        met = {
            "values_not_null": f"{c} is not null",
            "values_in_set": f"{c} in ({', '.join(repr(v) for v in e.values)})",
            "values_between": inside(c),
            "lengths_equal": f"length({c}) = {e.length}",
            "at_least_other": f"{c} >= {e.other}",
        }[e.kind]
        considered = "count(*)" if e.kind == "values_not_null" else f"count({c})"
        bad = f"count(*) filter (not ({met}))"
        ok = f"{bad} <= {round(1 - e.mostly, 6)} * {considered}"
    return f"""select '{suite}' suite, '{name}' expectation,
  {f"'{c}'" if c else 'cast(null as string)'} as "column",
  round(cast({observed} as double), 4) observed_value,
  cast({considered} as bigint) element_count, cast({bad} as bigint) unexpected_count,
  round(100.0 * cast({bad} as double) / cast({considered} as double), 6) unexpected_percent,
  {ok} success from {table}"""


_SCALE = {"fct_orders": (0.6, 1.4), "fct_order_items": (0.72, 2.8)}
answer(
    "expectation_summary",
    "fct_orders fct_order_items agg_daily_performance",
    "\nunion all ".join(
        _expectation_sql(s.name, s.table, e)
        for s in build_suites(1, SUITE_BOUNDS)
        for e in s.expectations
    ),
)
cte(
    "suite_results",
    "fct_order_items agg_daily_performance",
    "\nunion all ".join(
        _expectation_sql(s.name, s.table, e)
        for s in build_suites(1, TIGHT_BOUNDS)
        for e in s.expectations
        if s.table != "fct_orders"
    ),
)
answer(
    "suite_outcomes",
    "suite_results",
    """select suite, count(*) evaluated, count(*) filter (success) passed,
  count(*) filter (not success) failed, bool_and(success) success,
  case suite when 'fct_order_items' then (select count(*) from fct_order_items)
    else (select count(*) from agg_daily_performance) end rows_validated,
  (select bool_and(success) from suite_results) all_suites_passed
from suite_results group by suite""",
)
answer(
    "quantiles_with_nan",
    "",
    """select p, case when isnan(v) then 'nan' when isinf(v) then 'inf'
    else cast(round(v, 2) as string) end v from (
  select unnest([0.0, 0.1, 0.5, 0.85, 0.93, 0.99, 1.0]::double[]) p,
    unnest(quantile_disc(case l_orderkey % 20 when 3 then 'nan'::double when 4 then 'inf'::double
      else l_extendedprice end, [0.0, 0.1, 0.5, 0.85, 0.93, 0.99, 1.0])) v
  from lineitem) q""",
)
answer(
    "order_quantiles",
    "stg_orders item_summary stg_customers",
    """select p, cast(v as double) order_total from (
  select unnest([0.01, 0.25, 0.5, 0.75, 0.95, 0.99]::double[]) p,
    unnest(quantile_disc(ifnull(order_item_total, 0), [0.01, 0.25, 0.5, 0.75, 0.95, 0.99])) v
  from stg_orders left join item_summary using (order_id)) q""",
)

# reports

_MONTHLY = """select month_start_date, customer_region, cast(sum(total_revenue) as double) revenue,
  cast(sum(gross_item_revenue) as double) product_revenue,
  cast(sum(freight_revenue) as double) shipping_revenue, {orders} orders
from agg_daily_performance join dim_date on date_key = purchased_date group by 1, 2"""
answer(
    "monthly_revenue_region",
    "agg_daily_performance dim_date",
    _MONTHLY.format(orders="cast(sum(orders_placed) as bigint)"),
)
answer(
    "monthly_revenue_region_orders_once",
    "agg_daily_performance dim_date",
    f"""select m.* exclude (orders), cast(o.orders as bigint) orders
from ({_MONTHLY.format(orders="count(*)")}) m join (
  select cast(date_trunc('month', purchased_date) as date) month_start_date, customer_region,
    sum(orders_placed) orders
  from (select distinct purchased_date, customer_state, customer_region, orders_placed
        from agg_daily_performance) d group by 1, 2) o using (month_start_date, customer_region)""",
)
_WEEKLY = """select week_start_date, customer_state, cast(sum(orders_late) as bigint) late_orders,
  cast(sum(orders_delivered) as bigint) delivered_orders,
  cast(sum(orders_late) as double) / cast(sum(orders_delivered) as double) late_rate
from {daily} join dim_date on date_key = purchased_date
group by 1, 2 having sum(orders_delivered) >= {floor}"""
answer(
    "weekly_late_rate",
    "agg_daily_performance dim_date",
    _WEEKLY.format(daily="agg_daily_performance", floor=20),
)
answer(
    "weekly_late_rate_orders_once",
    "agg_daily_performance dim_date",
    _WEEKLY.format(
        daily="(select distinct purchased_date, customer_state, orders_late, orders_delivered "
        "from agg_daily_performance) x",
        floor=4,
    ),
)
answer(
    "worst_sellers",
    "dim_sellers",
    """select seller_key, seller_city, seller_state, delivered_order_count, late_order_count,
  late_delivery_rate, cast(avg_days_to_delivery as double) avg_days_to_delivery
from dim_sellers where delivered_order_count >= 50
order by late_delivery_rate desc nulls last, seller_key limit 25""",
)
answer(
    "top_categories_region",
    "agg_daily_performance",
    f"""select customer_region, category_name, cast(rev as double) revenue,
  cast(units as bigint) units, review_score, freight_ratio from (
  select customer_region, category_name, sum(total_revenue) rev, sum(item_count) units,
    cast(sum(cast(avg_review_score as decimal(18,3))) as double)
      / nullif(count(avg_review_score), 0) review_score,
    cast(sum(cast(avg_freight_ratio as decimal(18,4))) as double)
      / nullif(count(avg_freight_ratio), 0) freight_ratio,
    rank() over (partition by customer_region order by sum(total_revenue) desc, category_name) r
  from agg_daily_performance where purchased_date >= date '{AS_OF}' - 365 group by 1, 2) t
where r <= 10""",
)
for _grain in ("fact", "agg"):
    for _report, _sql in {
        "monthly_trend": """select cast(date_trunc('month', purchased_date) as date)
  month_start_date, cast(sum(item_total) as double) revenue from fct_order_items group by 1""",
        "region_category": """select customer_region, category_name,
  cast(sum(item_total) as double) revenue from fct_order_items group by 1, 2""",
        "top_states": """select customer_state, cast(sum(item_total) as double) revenue
from fct_order_items where year(purchased_date) = 2000 group by 1
order by sum(item_total) desc, 1 limit 10""",
    }.items():
        answer(f"{_report}_{_grain}", "fct_order_items", _sql)
answer(
    "headline_metrics",
    "delivery_timeline fct_order_items dim_sellers_history",
    """select orders, first_date, last_date, late_delivery_rate, order_lines, gross_revenue,
  scd2_versions, scd2_sellers
from (select count(*) orders, min(purchased_date) first_date, max(purchased_date) last_date,
    cast(count(*) filter (is_late) as double) / count(*) filter (is_delivered)
      late_delivery_rate from delivery_timeline) a,
  (select count(*) order_lines, cast(sum(item_total) as double) gross_revenue
   from fct_order_items) b,
  (select count(*) scd2_versions, count(distinct seller_key) scd2_sellers
   from dim_sellers_history) c""",
)
answer(
    "load_volume",
    "src_order_items",
    """select ingest_date, count(*) row_count from src_order_items group by 1
order by 1 desc limit 10""",
)
answer(
    "run_durations",
    "src_runs",
    """select run_date, task_id, round(avg(duration_seconds), 6) avg_seconds from src_runs
where run_date >= date '2024-01-11' group by 1, 2""",
)
_SECONDS = """round(coalesce(duration_seconds,
    cast(epoch_us(finished_at) - epoch_us(started_at) as double) / 1e6), 2)"""
answer(
    "run_summary",
    "src_runs",
    f"""select run_date, dag_id, run_id,
  cast(sum(cast("seconds" as decimal(18,2))) as double) total_seconds, count(*) tasks,
  count(*) filter ("seconds" is null) tasks_without_timing,
  cast(sum(rows_processed) as bigint) rows_processed
from (select *, {_SECONDS} as "seconds" from src_runs) r group by 1, 2, 3""",
)
answer(
    "slowest_tasks",
    "src_runs",
    f"""select run_date, run_id, task_id, started_at, {_SECONDS} as "seconds" from src_runs
where {_SECONDS} is not null order by "seconds" desc, run_date, run_id, task_id limit 5""",
)
answer(
    "table_row_counts",
    " ".join(RAW_TABLES.values()),
    "\nunion all ".join(
        f"select '{t}' as \"table\", count(*) row_count from {s}" for t, s in RAW_TABLES.items()
    ),
)

"""Expected results as DuckDB SQL over the same sample tables.

Written apart from the Spark code, in DuckDB's own idiom, so that the two can disagree. The staging
tables are common table expressions; warehouse tables are added where a query reads them.
"""

from __future__ import annotations

from tallyhouse.schemas import STAGING, WAREHOUSE

STAGED = """
raw_customers as (
  select c_custkey as customer_id, c_custkey - c_custkey % 3 as customer_unique_id,
         (c_custkey % 100)::int as customer_zip_code_prefix,
         'city_' || (c_custkey % 37) as customer_city, n_name as customer_state
  from customer join nation on n_nationkey = c_nationkey),
raw_orders as (
  select o_orderkey as order_id,
         if(o_custkey % 50 = 7, -1 - o_custkey, o_custkey) as customer_id,
         case when o_orderkey % 50 = 0 then 'canceled' when o_orderkey % 97 = 0 then 'unavailable'
              when o_orderstatus = 'F' then 'delivered' when o_orderstatus = 'P' then 'shipped'
              else 'created' end as order_status,
         o_orderdate as order_purchase_timestamp,
         if(o_orderkey % 61 = 0, null,
            o_orderdate + to_minutes(((o_orderkey % 72 - 2) * 60 + o_orderkey % 60)::int))
           as order_approved_at,
         if(o_orderstatus in ('F', 'P'),
            o_orderdate + to_minutes(((o_orderkey % 72 + o_custkey % 120) * 60
                                      + o_orderkey % 60)::int), null)
           as order_delivered_carrier_date,
         if(o_orderstatus = 'F',
            o_orderdate + to_minutes((if(o_orderkey % 211 = 5, -90 - o_orderkey % 600,
              (o_orderkey % 72 + o_custkey % 120 + o_orderkey * 7 % 500) * 60
              + o_orderkey % 60))::int), null)
           as order_delivered_customer_date,
         o_orderdate + to_minutes(((14 + o_orderkey % 10) * 1440)::int)
           as order_estimated_delivery_date
  from orders),
raw_order_items as (
  select if(l_orderkey % 331 = 1, -1 - l_orderkey, l_orderkey) as order_id,
         l_linenumber as order_item_id,
         if(l_partkey % 200 = 199, -1 - l_partkey, l_partkey) as product_id,
         if(l_suppkey % 10 = 9, -1 - l_suppkey, l_suppkey) as seller_id,
         l_shipdate as shipping_limit_date,
         (case when l_partkey % 500 = 0 then 0 when l_partkey % 977 = 3 then -l_extendedprice
               else l_extendedprice end)::decimal(12,2) as price,
         l_quantity::decimal(12,2) as freight_value
  from lineitem),
raw_order_payments as (
  select if(l_orderkey % 337 = 1, -1 - l_orderkey, l_orderkey) as order_id,
         l_linenumber as payment_sequential,
         case l_returnflag when 'A' then 'credit_card' when 'N' then 'boleto' else 'voucher' end
           as payment_type,
         l_quantity::int as payment_installments,
         if(l_partkey % 997 = 5, -l_extendedprice, l_extendedprice)::decimal(12,2)
           as payment_value
  from lineitem),
raw_order_reviews as (
  select if(event_id % 30 = 1, event_id - 1, event_id) as review_id,
         if(event_id % 97 = 3, -1 - (event_id - event_id % 2), event_id - event_id % 2)
           as order_id,
         if(event_id % 211 = 0, 0, 1 + (user_id + event_id) % 5)::int as review_score,
         case when event_id % 10 = 0 then event_type when event_id % 10 = 1 then '' end
           as review_comment_title,
         case event_id % 4 when 0 then '' when 1 then '  ' when 2 then props end
           as review_comment_message,
         if(event_id % 25 = 0, null, ts) as review_creation_date,
         if(event_id % 7 = 0, null, ts + to_minutes((event_id % 200 * 60)::int))
           as review_answer_timestamp
  from events),
raw_products as (
  select p_partkey as product_id,
         case p_partkey % 50 when 0 then null when 1 then '' when 2 then 'unlisted'
              else lower(p_type) end as product_category_name,
         length(p_name)::decimal(8,2) as product_name_lenght,
         (length(p_name) * 7)::decimal(8,2) as product_description_lenght,
         (p_size % 6)::decimal(8,2) as product_photos_qty,
         p_retailprice::decimal(12,2) as product_weight_g,
         if(p_partkey % 40 = 0, null, p_size)::decimal(12,2) as product_length_cm,
         (p_size + 1)::decimal(12,2) as product_height_cm,
         (p_size + 2)::decimal(12,2) as product_width_cm
  from part),
raw_sellers as (
  select s_suppkey as seller_id, (s_suppkey % 100)::int as seller_zip_code_prefix,
         'city_' || (s_suppkey % 37) as seller_city, n_name as seller_state
  from supplier join nation on n_nationkey = s_nationkey),
raw_product_category_translation as (
  select distinct lower(p_type) as product_category_name,
         if(p_type = 'ECONOMY', '', 'en_' || lower(p_type)) as product_category_name_english
  from part),
raw_geolocation as (
  select label as geolocation_zip_code_prefix,
         embedding[1]::decimal(10,7) as geolocation_lat,
         embedding[2]::decimal(10,7) as geolocation_lng,
         'city_' || label as geolocation_city, 'XX' as geolocation_state
  from embeddings)"""

MODEL = {
    "dim_date": """
dim_date as (
  with days as (
    select unnest([order_purchase_timestamp, order_approved_at, order_delivered_carrier_date,
                   order_delivered_customer_date, order_estimated_delivery_date])::date as d
    from raw_orders
    union select shipping_limit_date::date from raw_order_items
    union select review_creation_date::date from raw_order_reviews)
  select strftime(d, '%Y%m%d')::int as date_key, d as full_date, year(d)::int as year_number,
         quarter(d)::int as quarter_number, month(d)::int as month_number,
         monthname(d) as month_name, weekofyear(d)::int as week_number,
         day(d)::int as day_of_month, (dayofweek(d) + 1)::int as day_of_week,
         dayname(d) as day_name, dayofweek(d) in (0, 6) as is_weekend
  from days where d is not null)""",
    "dim_customer": """
dim_customer as (
  select customer_unique_id,
         first(customer_id order by placed nulls first, customer_id) as first_customer_id,
         first(customer_city order by placed desc nulls last, customer_id desc) as customer_city,
         first(customer_state order by placed desc nulls last, customer_id desc)
           as customer_state,
         first(customer_zip_code_prefix order by placed desc nulls last, customer_id desc)
           as customer_zip_code_prefix,
         min(placed) as first_order_date, max(placed) as last_order_date,
         count(placed) as total_orders
  from (from raw_customers left join
        (select customer_id, order_purchase_timestamp as placed from raw_orders)
        using (customer_id))
  group by all)""",
    "dim_product": """
dim_product as (
  select product_id,
         if(coalesce(p.product_category_name, '') = '', 'unknown', p.product_category_name)
           as product_category_name,
         if(coalesce(product_category_name_english, '') = '', 'unknown',
            product_category_name_english) as product_category_name_english,
         product_name_lenght as product_name_length,
         product_description_lenght as product_description_length,
         product_photos_qty, product_weight_g,
         (product_length_cm * product_height_cm * product_width_cm)::decimal(18,2)
           as product_volume_cm3
  from raw_products p left join raw_product_category_translation using (product_category_name))""",
    "dim_seller": """
dim_seller as (
  select seller_id, seller_city, seller_state, seller_zip_code_prefix from raw_sellers)""",
    "fact_order": """
fact_order as (
  select order_id, customer_id, customer_unique_id, order_status, order_purchase_timestamp,
         order_approved_at, order_delivered_carrier_date, order_delivered_customer_date,
         order_estimated_delivery_date,
         strftime(order_purchase_timestamp, '%Y%m%d')::int as purchase_date_key,
         strftime(order_approved_at, '%Y%m%d')::int as approved_date_key,
         strftime(order_delivered_carrier_date, '%Y%m%d')::int as delivered_carrier_date_key,
         strftime(order_delivered_customer_date, '%Y%m%d')::int as delivered_customer_date_key,
         strftime(order_estimated_delivery_date, '%Y%m%d')::int as estimated_delivery_date_key,
         coalesce((select sum(payment_value) from raw_order_payments x
                   where x.order_id = o.order_id), 0)::decimal(22,2) as payment_value,
         (select count(*) from raw_order_payments x where x.order_id = o.order_id)
           as payment_count,
         coalesce((select sum(price) from raw_order_items x
                   where x.order_id = o.order_id), 0)::decimal(22,2) as merchandise_value,
         coalesce((select sum(freight_value) from raw_order_items x
                   where x.order_id = o.order_id), 0)::decimal(22,2) as freight_value,
         (select count(*) from raw_order_items x where x.order_id = o.order_id)
           as item_count,
         (select count(distinct seller_id) from raw_order_items x
          where x.order_id = o.order_id) as seller_count,
         (date_sub('hour', order_purchase_timestamp, order_approved_at) / 24::double)
           ::decimal(10,2) as approval_days,
         (date_sub('hour', order_approved_at, order_delivered_carrier_date) / 24::double)
           ::decimal(10,2) as carrier_handling_days,
         (date_sub('hour', order_purchase_timestamp, order_delivered_customer_date) / 24::double)
           ::decimal(10,2) as delivery_days,
         (date_sub('hour', order_purchase_timestamp, order_estimated_delivery_date) / 24::double)
           ::decimal(10,2) as estimated_delivery_days,
         order_delivered_customer_date > order_estimated_delivery_date as late_delivery_flag
  from raw_orders o join raw_customers using (customer_id))""",
    "fact_order_item": """
fact_order_item as (
  select order_id, order_item_id, product_id, seller_id, shipping_limit_date,
         strftime(shipping_limit_date, '%Y%m%d')::int as shipping_limit_date_key,
         price, freight_value, (price + freight_value)::decimal(12,2) as line_total_value,
         -- rounded half up in whole numbers: ten-thousandths of cents over cents
         if(price = 0, null,
            sign(price) * ((2 * (freight_value * 100)::bigint * 10000 + abs(price * 100)::bigint)
                           // (2 * abs(price * 100)::bigint)) / 10000)::decimal(10,4)
           as freight_rate
  from raw_order_items
  where order_id in (select order_id from raw_orders
                     where customer_id in (select customer_id from raw_customers))
    and product_id in (select product_id from raw_products)
    and seller_id in (select seller_id from raw_sellers))""",
    "fact_review": """
fact_review as (
  select review_id, order_id, review_score,
         if(review_comment_title = '', null, review_comment_title) as review_comment_title,
         if(review_comment_message = '', null, review_comment_message) as review_comment_message,
         review_creation_date, review_answer_timestamp,
         strftime(review_creation_date, '%Y%m%d')::int as review_creation_date_key,
         (date_sub('hour', review_creation_date, review_answer_timestamp) / 24::double)
           ::decimal(10,2) as review_response_days,
         length(trim(coalesce(review_comment_message, ''))) > 0 as has_review_comment,
         review_score < 3 as is_negative_review, review_score > 3 as is_positive_review
  from raw_order_reviews
  where review_creation_date is not null
    and order_id in (select order_id from raw_orders
                     where customer_id in (select customer_id from raw_customers)))""",
}

# Orders and items as the exploration reports see them.
VIEWS = """
paid as (select order_id, sum(payment_value)::decimal(22,2) as payment_value
         from raw_order_payments group by order_id),
sold as (select order_id, sum(price)::decimal(22,2) as merchandise_value,
                sum(freight_value)::decimal(22,2) as freight_value,
                count(*) as item_count, count(distinct seller_id) as seller_count
         from raw_order_items group by order_id),
enriched as (
  select o.*, c.* exclude (customer_id), payment_value, merchandise_value, freight_value,
         item_count, seller_count,
         floor((epoch_us(order_delivered_customer_date) - epoch_us(order_purchase_timestamp))
               / 86400000000)::int as delivery_days,
         floor((epoch_us(order_estimated_delivery_date) - epoch_us(order_purchase_timestamp))
               / 86400000000)::int as estimated_delivery_days,
         coalesce(order_delivered_customer_date > order_estimated_delivery_date, false)
           as late_delivery
  from raw_orders o left join raw_customers c using (customer_id)
       left join paid using (order_id) left join sold using (order_id)),
catalogued as (
  select i.*, p.* exclude (product_id), product_category_name_english,
         s.* exclude (seller_id),
         coalesce(nullif(product_category_name_english, ''), nullif(product_category_name, ''),
                  'unknown') as category
  from raw_order_items i left join raw_products p using (product_id)
       left join raw_product_category_translation using (product_category_name)
       left join raw_sellers s using (seller_id)),
zips as (
  select geolocation_zip_code_prefix as zip_code_prefix,
         median(geolocation_lat::double) as latitude, median(geolocation_lng::double) as longitude
  from raw_geolocation group by 1)"""

# Column types as Spark names them, for the type listing.
TYPE_NAMES = {
    "raw_customers": "bigint bigint int string string",
    "raw_geolocation": "int decimal(10,7) decimal(10,7) string string",
    "raw_orders": "bigint bigint string" + 5 * " timestamp_ntz",
    "raw_order_items": "bigint int bigint bigint timestamp_ntz decimal(12,2) decimal(12,2)",
    "raw_order_payments": "bigint int string int decimal(12,2)",
    "raw_order_reviews": "bigint bigint int string string timestamp_ntz timestamp_ntz",
    "raw_products": "bigint string" + 3 * " decimal(8,2)" + 4 * " decimal(12,2)",
    "raw_sellers": "bigint int string string",
    "raw_product_category_translation": "string string",
}


def _union(parts) -> str:
    return "\nunion all\n".join(parts)


def _counts(tables) -> str:
    return _union(f"select '{t}' as table_name, count(*) as row_count from {t}" for t in tables)


def _failing(*checks: tuple[str, str, str]) -> str:
    """Rows of a table meeting a condition, per (check name, table, condition)."""
    return _union(
        f"select '{name}' as check_name, count(*) filter ({condition})::bigint as failed_rows "
        f"from {table}"
        for name, table, condition in checks
    )


def _repeated(column: str, *checks: tuple[str, str, str]) -> str:
    """Keys occurring more than once, per (check name, table, key columns)."""
    return _union(
        f"select '{name}' as check_name, count(*) as {column} from "
        f"(select 1 from {table} group by {key} having count(*) > 1)"
        for name, table, key in checks
    )


def _orphans(*checks: tuple[str, str, str, str]) -> str:
    """Rows without their parent, per (check name, child, parent, key); NULL keys count."""
    return _union(
        f"select '{name}' as check_name, count(*) as failed_rows from {child} c "
        f"where not exists (from {parent} p where p.{key} = c.{key})"
        for name, child, parent, key in checks
    )


def _dangling(*checks: tuple[str, str, str, str]) -> str:
    """Foreign keys without a row, per (child, foreign key, parent, key); NULL is fine."""
    return _union(
        f"select '{child}.{fk} unknown' as check_name, count(*) as failed_rows from {child} "
        f"where {fk} not in (select {key} from {parent} where {key} is not null)"
        for child, fk, parent, key in checks
    )


def _gaps() -> str:
    """dataset, position, column, rows, missing_count of every staging column."""
    return _union(
        f"select '{name}' as dataset, '{column}' as \"column\", '{dtype}' as dtype, "
        f'count(*) as "rows", count(*) - count({column}) as missing_count from {name}'
        for name, contract in STAGING.items()
        for column, dtype in zip(contract.columns, TYPE_NAMES[name].split(), strict=True)
    )


def _profile() -> str:
    def line(name: str, columns: list[str]) -> str:
        gaps = " + ".join(f"count(*) - count({c})" for c in columns)
        return (
            f"select '{name}' as dataset, count(*) as \"rows\", {len(columns)} as \"columns\", "
            f"count(*) - (select count(*) from (select distinct * from {name})) "
            f"as duplicate_rows, {gaps} as missing_cells, "
            f'round(({gaps})::double / (count(*) * {len(columns)}), 6) as missing_pct from {name}'
        )

    return _union(line(name, contract.columns) for name, contract in STAGING.items())


def _nulls(contracts) -> list[tuple[str, str, str]]:
    return [
        (f"{name}.{column} missing", name, f"{column} is null")
        for name, contract in contracts.items()
        for column in contract.required
    ]


def _negative(**columns: str) -> list[tuple[str, str, str]]:
    return [
        (f"{table}.{column} negative", table, f"{column} < 0")
        for table, names in columns.items()
        for column in names.split()
    ]


def _describe(values: str) -> str:
    quantiles = ", ".join(
        f"round(quantile_cont(x::double, {q}), 4) as {name}"
        for name, q in (("p50", 0.5), ("p75", 0.75), ("p90", 0.9), ("p95", 0.95), ("p99", 0.99))
    )
    return (
        "select count(x) as count, round(sum(x)::double / count(x), 4) as mean, "
        "round(stddev_samp(x::double), 4) as std, round(min(x)::double, 4) as min, "
        f"{quantiles}, round(max(x)::double, 4) as max from ({values})"
    )


def _histogram(values: str) -> str:
    return f"""
select bin, round(low + (bin - 1) * ((high - low) / 80), 6) as bin_start,
       round(low + bin * ((high - low) / 80), 6) as bin_end, count(*) as n
from (select low, high,
             least(floor((x - low) / (high - low) * 80)::bigint + 1, 80) as bin
      from (select x::double as x, min(x::double) over () as low, max(x::double) over () as high
            from ({values}) where x is not null))
group by low, high, bin"""


NOT_REVENUE = "coalesce(lower(order_status), '') in ('canceled', 'cancelled', 'unavailable')"
MONTH = "strftime(order_purchase_timestamp, '%Y-%m')"


def _monthly(orders: str = "fact_order", amount: str = "payment_value") -> str:
    return f"""
select {MONTH} as order_month, count(distinct order_id) as orders,
       coalesce(sum({amount}) filter (not {NOT_REVENUE}), 0)::decimal(38,2) as revenue
from {orders} group by 1"""


def _growth(orders: str = "fact_order") -> str:
    return f"""
select order_month, revenue, before as previous_revenue,
       if(before = 0, null, round((revenue - before)::double / before::double * 100, 6))
         as growth_pct
from (select order_month, revenue, lag(revenue) over (order by order_month) as before
      from ({_monthly(orders)}))"""


PRIMARY_KEYS = {
    "raw_customers": "customer_id",
    "raw_orders": "order_id",
    "raw_order_items": "order_id, order_item_id",
    "raw_order_payments": "order_id, payment_sequential",
    "raw_order_reviews": "review_id",
    "raw_products": "product_id",
    "raw_sellers": "seller_id",
    "raw_product_category_translation": "product_category_name",
}


def _deduped(table: str, key: str, dated: tuple[str, ...]) -> str:
    """The earliest copy of each key, undated ones last; then the least by the other columns."""
    from tallyhouse.schemas import STAGING

    rest = [c for c in STAGING[table].columns if c not in key.split(", ") and c not in dated]
    order = [f"{c} nulls last" for c in dated] + [f"{c} nulls first" for c in rest]
    return (
        f"from {table} qualify row_number() over "
        f"(partition by {key} order by {', '.join(order)}) = 1"
    )


def _customer_growth(orders: str = "fact_order") -> str:
    return f"""
with firsts as (
  select customer_unique_id, min(order_purchase_timestamp) as debut
  from raw_orders join raw_customers using (customer_id) group by 1),
visits as (
  select customer_unique_id, order_purchase_timestamp as placed, {MONTH} as order_month, debut
  from {orders} join firsts using (customer_unique_id)),
months as (
  select order_month, count(distinct customer_unique_id) as buyers,
         count(distinct customer_unique_id) filter (strftime(debut, '%Y-%m') = order_month)
           as new_customers,
         count(distinct customer_unique_id) filter (placed > debut) as repeat_customers
  from visits group by 1)
select *, (sum(new_customers) over (order by order_month))::bigint as cumulative_customers
from months"""


def _board(orders: str, reviews: str | None = None) -> str:
    scores = "".join(
        f"""(select count(*) from {reviews} join {orders} using (order_id)
        where review_score = {k} and {MONTH} = m.order_month)::bigint as score_{k}, """
        for k in (range(1, 6) if reviews else ())
    )
    return f"""
with m as (
  select {MONTH} as order_month, count(*) as orders,
         coalesce(sum(payment_value) filter (not {NOT_REVENUE}), 0)::decimal(38,2) as revenue,
         count(*) filter (not {NOT_REVENUE}
                          and order_id in (select order_id from raw_order_payments)) as paid_orders,
         sum(delivery_days)::decimal(38,2) as delivery_days, count(delivery_days) as delivered,
         count(*) filter (late_delivery_flag) as late, count(late_delivery_flag) as judged
  from {orders} group by 1),
persons as (
  select customer_unique_id, min({MONTH}) as order_month, count(*) as n from {orders} group by 1),
people as (
  select order_month, count(*) as customers, count(*) filter (n >= 2) as repeaters
  from persons group by 1)
select m.*, {scores}coalesce(customers, 0) as customers, coalesce(repeaters, 0) as repeaters,
       buyers, new_customers, repeat_customers
from m left join people using (order_month)
left join ({_customer_growth(orders)}) using (order_month)"""


def _delivery_trend(orders: str = "fact_order") -> str:
    return f"""
select {MONTH} as order_month, count(*) as delivered_orders,
       round(sum(delivery_days)::double / count(*), 6) as average_delivery_days
from {orders} where delivery_days is not null group by 1"""


def _late_trend(orders: str = "fact_order") -> str:
    return f"""
select {MONTH} as order_month, count(*) as delivered_orders,
       round(count(*) filter (late_delivery_flag)::double / count(*) * 100, 6)
         as late_delivery_rate
from {orders} where late_delivery_flag is not null group by 1"""


def _scores(reviews: str = "fact_review") -> str:
    return f"""
select review_score, count(*) as reviews from {reviews}
where review_score between 1 and 5 group by 1"""


def _cards(orders: str, buyers: str, reviews: str) -> str:
    return f"""
select (select coalesce(sum(payment_value), 0)::decimal(38,2) from {orders}
        where not {NOT_REVENUE}) as total_revenue,
       (select arg_max(growth_pct, order_month) from ({_growth(orders)})) as revenue_growth_pct,
       (select count(*) from {orders}) as orders,
       (select round(sum(payment_value)::double / count(*) filter (payment_count > 0), 6)
        from {orders} where not {NOT_REVENUE}) as average_order_value,
       (select round(sum(delivery_days)::double / count(delivery_days), 6) from {orders})
         as average_delivery_days,
       (select round(count(*) filter (late_delivery_flag)::double
                     / count(late_delivery_flag) * 100, 6) from {orders}) as late_delivery_rate,
       (select count(*) from {buyers}) as customers,
       (select round(count(*) filter (total_orders > 1)::double / count(*) * 100, 6)
        from {buyers}) as repeat_purchase_rate,
       (select round(sum(review_score)::double / count(*), 6) from {reviews}
        where review_score between 1 and 5) as average_review_score"""


SELECTED = """
chosen as (
  from fact_order
  where order_purchase_timestamp::date between '1996-01-01' and '2000-06-30'
    and order_status in ('delivered', 'shipped')
    and customer_unique_id in (
      select customer_unique_id from dim_customer
      where customer_state in ('NATION_1', 'NATION_2', 'NATION_3', 'NATION_5', 'NATION_8',
                               'NATION_13'))
    and order_id in (
      select order_id
      from fact_order_item join dim_product using (product_id) join dim_seller using (seller_id)
      where product_category_name_english in ('en_small', 'en_promo', 'en_large')
        and seller_state in ('NATION_0', 'NATION_4', 'NATION_7', 'NATION_15', 'NATION_16',
                             'NATION_20'))),
chosen_buyers as (
  select customer_unique_id, count(*) as total_orders from chosen group by 1),
chosen_reviews as (
  from fact_review where order_id in (select order_id from chosen))"""

STATE_SALES = """
select customer_state, count(distinct order_id) as orders,
       coalesce(sum(payment_value), 0)::decimal(38,2) as revenue,
       count(distinct customer_unique_id) as customers
from enriched where customer_state is not null group by 1"""

CITY_SALES = """
select customer_state, customer_city, count(distinct order_id) as orders,
       coalesce(sum(payment_value), 0)::decimal(38,2) as revenue
from enriched where customer_state is not null and customer_city is not null group by 1, 2"""

CATEGORY_SALES = """
select category, count(order_item_id) as order_items, sum(price)::decimal(38,2) as revenue,
       sum(freight_value)::decimal(38,2) as freight, count(distinct seller_id) as sellers
from catalogued group by 1"""

SELLER_SALES = """
select seller_id, seller_state, seller_city, count(order_item_id) as order_items,
       sum(price)::decimal(38,2) as revenue, sum(freight_value)::decimal(38,2) as freight,
       count(distinct category) as categories
from catalogued where seller_state is not null and seller_city is not null group by 1, 2, 3"""

LATE_BY_STATE = """
select customer_state, count(distinct order_id) as orders,
       round(avg(late_delivery::int), 6) as late_delivery_rate,
       round(median(delivery_days), 6) as median_delivery_days
from enriched where order_delivered_customer_date is not null and customer_state is not null
group by 1"""

MONTHLY_ORDERS = f"""
select {MONTH} as order_month, count(distinct order_id) as orders,
       coalesce(sum(payment_value), 0)::decimal(38,2) as revenue
from enriched where order_purchase_timestamp is not null group by 1"""


def _blank(column: str) -> str:
    return f"coalesce({column}::varchar, '') = ''"


BODIES: dict[str, str] = {
    "raw_row_counts": _counts(STAGING),
    "warehouse_row_counts": _counts(WAREHOUSE),
    "check_required_keys": _failing(
        *[
            (f"{table}.{column} nulls", table, _blank(column))
            for table, column in (
                ("raw_customers", "customer_id"),
                ("raw_orders", "order_id"),
                ("raw_order_items", "order_id"),
                ("raw_order_items", "product_id"),
                ("raw_order_items", "seller_id"),
                ("raw_order_payments", "order_id"),
                ("raw_order_reviews", "review_id"),
                ("raw_products", "product_id"),
                ("raw_sellers", "seller_id"),
            )
        ]
    ),
    "check_duplicate_grain": _repeated(
        "failed_groups",
        ("duplicate raw customer_id", "raw_customers", "customer_id"),
        ("duplicate raw order_id", "raw_orders", "order_id"),
        ("duplicate raw order item grain", "raw_order_items", "order_id, order_item_id"),
        ("duplicate raw payment grain", "raw_order_payments", "order_id, payment_sequential"),
        ("duplicate raw review_id", "raw_order_reviews", "review_id"),
        ("duplicate raw product_id", "raw_products", "product_id"),
        ("duplicate raw seller_id", "raw_sellers", "seller_id"),
    ),
    "check_relationships": _orphans(
        ("orders missing customer", "raw_orders", "raw_customers", "customer_id"),
        ("order items missing order", "raw_order_items", "raw_orders", "order_id"),
        ("payments missing order", "raw_order_payments", "raw_orders", "order_id"),
        ("reviews missing order", "raw_order_reviews", "raw_orders", "order_id"),
        ("order items missing product", "raw_order_items", "raw_products", "product_id"),
        ("order items missing seller", "raw_order_items", "raw_sellers", "seller_id"),
    ),
    "check_business_rules": _failing(
        ("negative item price", "raw_order_items", "price < 0"),
        ("negative freight value", "raw_order_items", "freight_value < 0"),
        ("negative payment value", "raw_order_payments", "payment_value < 0"),
        ("invalid review score", "raw_order_reviews", "review_score < 1 or review_score > 5"),
        (
            "delivered before purchase",
            "raw_orders",
            "order_purchase_timestamp > order_delivered_customer_date",
        ),
        ("approved before purchase", "raw_orders", "order_purchase_timestamp > order_approved_at"),
    ),
    "check_datetime_hygiene": _failing(
        ("zero review creation date", "raw_order_reviews", "false"),
        ("zero review answer timestamp", "raw_order_reviews", "false"),
        ("missing review creation date", "raw_order_reviews", "review_creation_date is null"),
        (
            "missing review answer timestamp",
            "raw_order_reviews",
            "review_answer_timestamp is null",
        ),
    ),
    "check_raw_constraints": _union(
        (
            _failing(*_nulls(STAGING), *_negative(raw_order_payments="payment_installments")),
            _repeated(
                "failed_rows",
                (
                    "raw_product_category_translation key repeated",
                    "raw_product_category_translation",
                    "product_category_name",
                ),
            ),
        )
    ),
    "check_warehouse_keys": _repeated(
        "failed_groups",
        *[(f"{n} key repeated", n, ", ".join(c.key)) for n, c in WAREHOUSE.items()],
        ("dim_date.full_date repeated", "dim_date", "full_date"),
    ),
    "check_warehouse_rules": _failing(
        *_nulls(WAREHOUSE),
        *_negative(
            dim_customer="total_orders",
            fact_order="payment_value merchandise_value freight_value item_count seller_count",
            fact_order_item="price freight_value line_total_value",
        ),
        (
            "fact_review.review_score out of range",
            "fact_review",
            "review_score not in (1, 2, 3, 4, 5)",
        ),
    ),
    "check_warehouse_fks": _dangling(
        ("fact_order", "customer_unique_id", "dim_customer", "customer_unique_id"),
        ("fact_order", "purchase_date_key", "dim_date", "date_key"),
        ("fact_order", "approved_date_key", "dim_date", "date_key"),
        ("fact_order", "delivered_carrier_date_key", "dim_date", "date_key"),
        ("fact_order", "delivered_customer_date_key", "dim_date", "date_key"),
        ("fact_order", "estimated_delivery_date_key", "dim_date", "date_key"),
        ("fact_order_item", "order_id", "fact_order", "order_id"),
        ("fact_order_item", "product_id", "dim_product", "product_id"),
        ("fact_order_item", "seller_id", "dim_seller", "seller_id"),
        ("fact_order_item", "shipping_limit_date_key", "dim_date", "date_key"),
        ("fact_review", "order_id", "fact_order", "order_id"),
        ("fact_review", "review_creation_date_key", "dim_date", "date_key"),
    ),
    "dedupe_customers": _deduped("raw_customers", "customer_id", ()),
    "dedupe_orders": _deduped(
        "raw_orders", "order_id", ("order_purchase_timestamp", "order_approved_at")
    ),
    "dedupe_order_items": _deduped(
        "raw_order_items", "order_id, order_item_id", ("shipping_limit_date",)
    ),
    "surplus_keys": " union all ".join(
        f"select '{table} copies of a key' as check_name, count(*) - "
        f"(select count(*) from (select distinct {key} from {table})) as failed_rows from {table}"
        for table, key in PRIMARY_KEYS.items()
    ),
    "dedupe_reviews": """
from raw_order_reviews
qualify row_number() over (
  partition by review_id
  order by review_creation_date nulls last, review_answer_timestamp nulls last,
           order_id nulls first, review_score nulls first, review_comment_title nulls first,
           review_comment_message nulls first) = 1""",
    "dataset_profile": _profile(),
    "missing_summary": f"""
select dataset, "column", missing_count, round(missing_count::double / "rows", 6) as missing_pct
from ({_gaps()}) where missing_count > 0""",
    "dtype_summary": f'select dataset, "column", dtype, missing_count as missing from ({_gaps()})',
    "preview_orders": "from raw_orders order by order_id limit 5",
    "payment_summary": "from paid",
    "item_summary": "from sold",
    "customer_order_ranks": """
select customer_unique_id, customer_id, order_purchase_timestamp, first_order_rank,
       count(*) over (partition by customer_unique_id) + 1 - first_order_rank
         as latest_order_rank
from (select customer_unique_id, customer_id, order_purchase_timestamp,
             row_number() over (partition by customer_unique_id
                                order by order_purchase_timestamp nulls first, customer_id)
               as first_order_rank
      from raw_customers left join raw_orders using (customer_id))""",
    "orders_enriched": "from enriched",
    "items_products": "from catalogued",
    "kpis": """
select (select count(distinct order_id) from raw_orders) as unique_orders,
       (select count(distinct customer_unique_id) from raw_customers) as unique_customers,
       (select count(distinct seller_id) from raw_sellers) as unique_sellers,
       (select count(distinct product_id) from raw_products) as unique_products,
       (select sum(payment_value)::decimal(38,2) from raw_order_payments) as payment_value,
       (select sum(price)::decimal(38,2) from raw_order_items) as merchandise_value,
       (select sum(freight_value)::decimal(38,2) from raw_order_items) as freight_value,
       (select round(sum(payment_value)::double / count(*), 6) from paid)
         as avg_payment_per_order,
       (select round(avg(review_score), 6) from raw_order_reviews) as avg_review_score,
       (select median(delivery_days) from enriched) as median_delivery_days,
       (select round(avg(late_delivery::int), 6) from enriched
        where order_delivered_customer_date is not null) as late_delivery_rate""",
    "monthly_orders": MONTHLY_ORDERS,
    "monthly_orders_last12": f"from ({MONTHLY_ORDERS}) order by order_month desc limit 12",
    "order_status_mix": """
select order_status, round(count(*)::double / sum(count(*)) over (), 6) as share,
       count(*) as orders
from raw_orders where order_status is not null group by 1""",
    "state_sales": STATE_SALES,
    "top_states": f"from ({STATE_SALES}) order by orders desc, customer_state limit 15",
    "city_sales": CITY_SALES,
    "top_cities": (
        f"from ({CITY_SALES}) order by orders desc, customer_state, customer_city limit 20"
    ),
    "category_sales": CATEGORY_SALES,
    "top_categories": f"from ({CATEGORY_SALES}) order by revenue desc, category limit 15",
    "seller_sales": SELLER_SALES,
    "top_sellers": f"from ({SELLER_SALES}) order by revenue desc, seller_id limit 20",
    "payment_mix": """
select payment_type, count(order_id) as transactions,
       sum(payment_value)::decimal(38,2) as payment_value,
       round(sum(payment_value)::double / count(payment_value), 6) as avg_payment,
       round(avg(payment_installments), 6) as avg_installments
from raw_order_payments where payment_type is not null group by 1""",
    "order_payment_describe": _describe("select payment_value as x from paid"),
    "payment_histogram": _histogram("select payment_value as x from paid"),
    "items_per_order_histogram": "select item_count, count(*) as orders from sold group by 1",
    "delivery_summary": _describe("select delivery_days as x from enriched"),
    "delivery_histogram": _histogram("select delivery_days as x from enriched"),
    "late_by_state": LATE_BY_STATE,
    "top_late_states": (
        f"from ({LATE_BY_STATE}) order by late_delivery_rate desc, customer_state limit 15"
    ),
    "review_distribution": """
select review_score, count(*) as reviews
from raw_order_reviews where review_score is not null group by 1""",
    "review_summary": """
select review_score, count(review_id) as reviews,
       round(avg(delivery_days), 6) as avg_delivery_days,
       round(avg(late_delivery::int), 6) as late_delivery_rate,
       round(sum(payment_value)::double / count(payment_value), 6) as avg_payment_value
from raw_order_reviews left join
     (select order_id, delivery_days, late_delivery, payment_value from enriched)
     using (order_id)
where review_score is not null group by 1""",
    "geo_by_zip": """
select zip_code_prefix, round(latitude, 8) as latitude, round(longitude, 8) as longitude
from zips""",
    "customer_geo": """
select c.*, round(latitude, 8) as customer_latitude, round(longitude, 8) as customer_longitude
from raw_customers c left join zips on zip_code_prefix = customer_zip_code_prefix""",
    "seller_geo": """
select s.*, round(latitude, 8) as seller_latitude, round(longitude, 8) as seller_longitude
from raw_sellers s left join zips on zip_code_prefix = seller_zip_code_prefix""",
    "seller_customer_distance": """
with spots as (
  select i.order_id, order_item_id, product_id, i.seller_id, seller_zip_code_prefix,
         customer_zip_code_prefix, radians(a.latitude) as la, radians(a.longitude) as ga,
         radians(b.latitude) as lb, radians(b.longitude) as gb
  from raw_order_items i left join raw_sellers using (seller_id)
       left join raw_orders using (order_id) left join raw_customers using (customer_id)
       left join zips a on a.zip_code_prefix = seller_zip_code_prefix
       left join zips b on b.zip_code_prefix = customer_zip_code_prefix)
select order_id, order_item_id, product_id, seller_id, seller_zip_code_prefix,
       customer_zip_code_prefix,
       if(la + ga + lb + gb is null, null,
          round(6371 * 2 * asin(least(1, sqrt(pow(sin((la - lb) / 2), 2)
                + cos(la) * cos(lb) * pow(sin((ga - gb) / 2), 2)))), 3)) as distance_km
from spots""",
    "revenue_valid_orders": f"""
select order_id, order_status, payment_value,
       (merchandise_value + freight_value)::decimal(23,2) as item_value
from fact_order where not {NOT_REVENUE}""",
    "total_revenue_payment": f"""
select sum(payment_value)::decimal(38,2) as total_revenue from fact_order
where not {NOT_REVENUE}""",
    "total_revenue_item": f"""
select sum(merchandise_value + freight_value)::decimal(38,2) as total_revenue from fact_order
where not {NOT_REVENUE}""",
    "total_revenue_all_orders": (
        "select sum(payment_value)::decimal(38,2) as total_revenue from fact_order"
    ),
    "average_order_value": f"""
select round(sum(payment_value)::double
             / count(*) filter (order_id in (select order_id from raw_order_payments)), 6)
         as average_order_value
from fact_order where not {NOT_REVENUE}""",
    "average_order_value_per_order": f"""
select round(sum(payment_value)::double / count(distinct order_id), 6)
         as average_order_value_per_order
from fact_order where not {NOT_REVENUE}""",
    "items_per_order": """
select round(sum(item_count)::double / count(distinct order_id), 6) as items_per_order
from fact_order""",
    "monthly_revenue": _monthly(),
    "monthly_revenue_item": _monthly(amount="merchandise_value + freight_value"),
    "revenue_growth_monthly": _growth(),
    "kpi_cards": _cards("fact_order", "dim_customer", "fact_review"),
    "month_board": _board("fact_order"),
    "total_orders": "select count(distinct order_id) as orders from fact_order",
    "total_customers": "select count(distinct customer_unique_id) as customers from raw_customers",
    "repeat_purchase_rate": """
select round(count(*) filter (total_orders > 1)::double / count(*) * 100, 6)
         as repeat_purchase_rate
from dim_customer""",
    "avg_delivery_time": """
select round(sum(delivery_days)::double / count(delivery_days), 6) as average_delivery_days
from fact_order""",
    "late_delivery_rate": """
select round(count(*) filter (late_delivery_flag)::double / count(late_delivery_flag) * 100, 6)
         as late_delivery_rate
from fact_order""",
    "avg_review_score": """
select round(avg(review_score), 6) as average_review_score
from fact_review where review_score between 1 and 5""",
    "customer_growth_monthly": _customer_growth(),
    "delivery_time_trend": _delivery_trend(),
    "late_rate_trend": _late_trend(),
    "review_score_distribution": _scores(),
    "dashboard_filtered": _cards("chosen", "chosen_buyers", "chosen_reviews"),
    "dashboard_filtered_board": _board("chosen", "chosen_reviews"),
    "dashboard_filtered_revenue": _monthly("chosen"),
    "dashboard_filtered_growth": _growth("chosen"),
    "dashboard_filtered_customers": _customer_growth("chosen"),
    "dashboard_filtered_delivery": _delivery_trend("chosen"),
    "dashboard_filtered_late": _late_trend("chosen"),
    "dashboard_filtered_reviews": _scores("chosen_reviews"),
}


LATE_BUY = "order_delivered_customer_date < order_purchase_timestamp"


def _gate() -> str:
    relationships, rules = BODIES["check_relationships"], BODIES["check_business_rules"]
    rule_of = {
        "orders missing customer": "Customer IDs join from orders to customers",
        "order items missing order": "Order items join to orders",
        "payments missing order": "Payments join to orders",
        "reviews missing order": "Reviews join to orders",
        "order items missing product": "Product IDs join from items to products",
        "order items missing seller": "Seller IDs join from items to sellers",
        "delivered before purchase": "Delivered date is after purchase date",
        "negative item price": "Negative prices or freight values",
        "negative freight value": "Negative prices or freight values",
        "negative payment value": "Negative prices or freight values",
    }
    cases = " ".join(f"when '{check}' then '{rule}'" for check, rule in rule_of.items())
    keys = _failing(
        *[
            ("Primary keys are non-null", name, " or ".join(_blank(c) for c in contract.key))
            for name, contract in STAGING.items()
            if contract.key
        ]
    )
    rest = _failing(
        (
            "Missing review comments",
            "raw_order_reviews",
            f"{_blank('review_comment_title')} or {_blank('review_comment_message')}",
        ),
        ("Missing product categories", "raw_products", _blank("product_category_name")),
    )
    unique = _repeated("failed_rows", ("Order IDs are unique in orders", "raw_orders", "order_id"))
    return f"""
with mapped as (
  select case check_name {cases} end as rule, failed_rows
  from ({_union((relationships, rules))})
  union all from ({_union((keys, rest, unique))})),
summed as (
  select rule, sum(failed_rows)::bigint as failed from mapped where rule is not null group by 1)
select rule, severity, failed,
       case when failed = 0 then 'passed' when severity = 'Error' then 'blocked'
            else 'reported' end as outcome
from (select *, case
        when rule in ('Primary keys are non-null', 'Order IDs are unique in orders',
                      'Customer IDs join from orders to customers',
                      'Negative prices or freight values') then 'Error'
        when rule = 'Missing review comments' then 'Info' else 'Warning' end as severity
      from summed)"""


def _rejected() -> str:
    """Rows rejected by rules of severity Error or Warning, and those whose parent is rejected."""

    def rows(table: str, rule: str, detail: str, broken: str, source: str = "") -> str:
        return f"""select '{table}' as table_name, '{rule}' as rule, '{detail}' as detail,
       count(*) as failed_rows from {source or table} where {broken}"""

    parts = [
        rows(name, "Primary keys are non-null", "condition 1", " or ".join(_blank(c) for c in contract.key))
        for name, contract in STAGING.items()
        if contract.key
    ]
    negative = "Negative prices or freight values"
    parts += [
        rows("raw_order_items", negative, "condition 1", "price < 0"),
        rows("raw_order_items", negative, "condition 2", "freight_value < 0"),
        rows("raw_order_payments", negative, "condition 1", "payment_value < 0"),
        rows("raw_orders", "Delivered date is after purchase date", "condition 1", LATE_BUY),
        rows("raw_products", "Missing product categories", "condition 1", _blank("product_category_name")),
    ]
    for table, rule, key, parents in (
        ("raw_orders", "Customer IDs join from orders to customers", "customer_id", "customers"),
        ("raw_order_items", "Order items join to orders", "order_id", "orders"),
        ("raw_order_payments", "Payments join to orders", "order_id", "orders"),
        ("raw_order_reviews", "Reviews join to orders", "order_id", "orders"),
        ("raw_order_items", "Product IDs join from items to products", "product_id", "products"),
        ("raw_order_items", "Seller IDs join from items to sellers", "seller_id", "sellers"),
    ):
        both = f"{table} left join kept_{parents} using ({key})"
        parts.append(rows(table, rule, "not delivered", "stays is null", both))
        parts.append(rows(table, rule, "rejected", "not stays", both))
    return f"""
with kept_customers as (
  select customer_id, bool_or(not ({_blank("customer_id")})) as stays from raw_customers group by 1),
kept_sellers as (
  select seller_id, bool_or(not ({_blank("seller_id")})) as stays from raw_sellers group by 1),
kept_products as (
  select product_id, bool_or(not ({_blank("product_id")}) and not ({_blank("product_category_name")}))
           as stays
  from raw_products group by 1),
kept_orders as (
  select order_id, bool_or(not ({_blank("order_id")}) and not coalesce({LATE_BUY}, false)
                           and coalesce(stays, false)) as stays
  from raw_orders left join kept_customers using (customer_id) group by 1)
select * from ({_union(parts)}) where failed_rows > 0"""


def oracle_queries() -> dict[str, str]:
    """Complete SQL statements by query name."""
    bodies = {**{name: f"from {name}" for name in MODEL}, **BODIES, "quality_gate": _gate(), "rejected_rows": _rejected()}
    prelude = ",".join([STAGED, *MODEL.values(), VIEWS, SELECTED])
    return {name: f"with {prelude}\n{_nested(body)}" for name, body in bodies.items()}


def _nested(body: str) -> str:
    """A body that starts with its own WITH becomes a subquery."""
    return f"select * from ({body})" if body.lstrip().startswith("with ") else body

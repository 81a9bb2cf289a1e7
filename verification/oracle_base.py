"""The model once more as plain SQL over the given tables.

Written for an engine with a single node: ranks, running sums and medians are
window and ordered-set functions here, whatever the Spark side does.
"""

from __future__ import annotations

import re


def ratio(num: str, den: str, digits: int) -> str:
    """round(num / den, digits), half away from zero, on integers."""
    n = f"cast(cast({num} as decimal(28,2)) * 100 as hugeint)"
    d = f"cast(cast({den} as decimal(28,2)) * 100 as hugeint)"
    size = f"((2 * abs({n}) * {10**digits} + abs({d})) // (2 * abs({d})))"
    return (
        f"(case when {d} <> 0 then cast(sign({n}) * sign({d}) * {size} as double)"
        f" / cast({10**digits} as double) end)"
    )


def pct(num: str, den: str, digits: int) -> str:
    return ratio(f"100 * ({num})", den, digits)


def mean(value: str, digits: int = 2, where: str = "true") -> str:
    f = f"filter (where {where})"
    return ratio(f"sum({value}) {f}", f"count({value}) {f}", digits)


def plain(num: str, den: str) -> str:
    return f"(cast({num} as double) / nullif(cast({den} as double), 0))"


def avg(value: str, where: str = "true") -> str:
    f = f"filter (where {where})"
    return plain(f"sum({value}) {f}", f"count({value}) {f}")


VALID = "order_status not in ('canceled', 'unavailable')"

INITCAP = (
    "array_to_string(list_transform(regexp_extract_all({0}, '[\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+'),"
    " lambda w: upper(w[1]) || lower(w[2:])), '')"
)

SPEED = (
    "case when delivery_days <= 3 then '1. 0-3 days' when delivery_days <= 7 then '2. 4-7 days'"
    " when delivery_days <= 14 then '3. 8-14 days' when delivery_days <= 30 then '4. 15-30 days'"
    " else '5. 30+ days' end"
)

CTES: dict[str, str] = {}

CTES["src_orders"] = """
  select o_orderkey as k, cast(o_orderkey as varchar) as order_id, 'c' || o_orderkey as customer_id,
         case o_orderstatus when 'F' then 'delivered' when 'O' then 'shipped' else 'canceled' end as order_status,
         o_orderdate as purchase_ts, cast(o_orderdate as date) as purchase_date,
         o_orderdate + to_hours(o_orderkey % 48) as approved_ts,
         cast(o_orderkey % 48 as double) as approval_hours,
         case when o_orderstatus = 'F' then o_orderdate + interval 1 day end as shipped_ts,
         case when o_orderstatus = 'F' then o_orderdate + to_days(cast(o_orderkey % 40 as integer)) end as delivered_ts,
         o_orderdate + interval 20 day as estimated_delivery_ts,
         case when o_orderstatus = 'F' then o_orderkey % 40 end as delivery_days,
         o_custkey, cast(left(o_orderpriority, 1) as integer) as score
  from orders"""

CTES["src_people"] = """
  select o.*, case when k % 5 = 0 then 'p' || o_custkey else 'n' || k end as customer_unique_id,
         lpad(cast(c_nationkey * 4 + c_custkey % 4 as varchar), 5, '0') as zip_code_prefix,
         'Sao Nation-' || c_nationkey || ' D''Oeste' as city, cast(c_nationkey as varchar) as state_code
  from src_orders o join customer on c_custkey = o_custkey"""

CTES["src_items"] = """
  select cast(l_orderkey as varchar) as order_id, l_orderkey as k, l_linenumber as order_item_id,
         cast(l_partkey as varchar) as product_id, cast(l_suppkey as varchar) as seller_id,
         l_shipdate as shipping_limit_date, l_returnflag,
         cast(cast(l_extendedprice as decimal(12,2)) * (1 - cast(l_discount as decimal(4,2)))
              * cast(0.001 as decimal(4,3)) as decimal(12,2)) as price,
         cast(cast(l_extendedprice as decimal(12,2)) * cast(l_tax as decimal(4,2))
              * cast(0.001 as decimal(4,3)) as decimal(12,2)) as freight_value
  from lineitem
  qualify row_number() over (partition by l_orderkey, l_linenumber order by l_partkey, l_suppkey,
      l_extendedprice, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) = 1"""

CTES["stg_items"] = f"""
  select *, price + freight_value as item_total,
         case when price > 0 then {ratio("freight_value", "price", 4)} end as freight_ratio
  from src_items"""

CTES["src_payments"] = """
  select order_id, payment_type, sum(price + freight_value) as payment_value,
         max(order_item_id) as payment_installments,
         row_number() over (partition by order_id order by payment_type) as payment_sequential
  from (select *, case l_returnflag when 'R' then 'credit_card' when 'A' then 'boleto' else 'voucher' end
               as payment_type from src_items)
  group by order_id, payment_type"""

CTES["pay"] = """
  select order_id, sum(payment_value) as payment_total, count(*) as payment_line_count,
         count(distinct payment_type) as payment_method_count, max(payment_installments) as max_installments,
         max(payment_type) filter (where spot = 1) as primary_payment_type,
         max(payment_installments) filter (where spot = 1) as primary_installments
  from (select *, row_number() over (partition by order_id
                                     order by payment_value desc, payment_sequential) as spot
        from src_payments)
  group by order_id"""

CTES["src_reviews"] = """
  select 'r-' || k || '-1' as review_id, k, order_id, score as review_score,
         purchase_ts + interval 30 day as created from src_orders
  union all
  select 'r-' || k || '-2', k, order_id, 6 - score, purchase_ts + interval 35 day
  from src_orders where k % 20 = 0"""

CTES["rev"] = """
  select order_id, review_id, review_score, k % 3 = 0 as has_comment,
         case when k % 3 = 0 then k % 200 + 1 else 0 end as comment_length,
         created as review_creation_date, k % 7 as response_days,
         case when review_score >= 4 then 'Promoter (4-5)' when review_score = 3 then 'Passive (3)'
              else 'Detractor (1-2)' end as review_band
  from src_reviews
  qualify row_number() over (partition by order_id order by created desc, review_id) = 1"""

CTES["states"] = """
  select cast(n_nationkey as varchar) as state_code, n_name as state_name, r_name as region
  from nation join region on r_regionkey = n_regionkey"""

CTES["stg_products"] = f"""
  select cast(p_partkey as varchar) as product_id,
         case when p_size <> 50 then lower(p_type || '_' || replace(p_brand, '#', '_')) end as category_pt,
         case when p_size = 50 then 'unknown'
              else case when p_type <> 'SMALL' then 'en_' else '' end
                   || lower(p_type || '_' || replace(p_brand, '#', '_')) end as category_key,
         case when p_size = 50 or p_type = 'SMALL' then 'Other' else p_type end as category_group,
         length(p_name) as name_length, p_size * 3 as description_length, p_size % 5 as photos_qty,
         cast(p_size * 250 as double) as weight_g, cast(p_size as double) as length_cm,
         cast(nullif(p_size % 7, 0) as double) as height_cm, p_size % 11 + 1.5::double as width_cm,
         round(cast(p_size * (p_size % 7) * (cast(p_size % 11 as decimal(4,1)) + 1.5) as decimal(18,2))
               / case when p_size % 7 = 0 then null else 1 end, 1)::double as volume_cm3
  from part"""

CTES["dim_product"] = f"""
  select product_id, category_key, {INITCAP.format("replace(category_key, '_', ' ')")} as category,
         category_group, category_pt as category_portuguese, photos_qty, name_length, description_length,
         weight_g, round(cast(weight_g as decimal(18,3)) / 1000, 3)::double as weight_kg,
         length_cm, height_cm, width_cm, volume_cm3,
         case when weight_g < 500 then '1. Under 0.5kg' when weight_g < 2000 then '2. 0.5-2kg'
              when weight_g < 10000 then '3. 2-10kg' else '4. Over 10kg' end as weight_band,
         case when photos_qty = 0 then 'No photo' when photos_qty = 1 then '1 photo'
              when photos_qty <= 3 then '2-3 photos' else '4+ photos' end as photo_band
  from stg_products"""

CTES["dim_seller"] = """
  select cast(s_suppkey as varchar) as seller_id, 'Sao Nation-' || s_nationkey as seller_city,
         cast(s_nationkey as varchar) as seller_state_code, state_name as seller_state, region as seller_region
  from supplier left join states on state_code = cast(s_nationkey as varchar)"""

CTES["geo_points"] = """
  select lpad(cast(c_nationkey * 4 + c_custkey % 4 as varchar), 5, '0') as zip,
         cast(-30 as decimal(10,2)) + cast((c_custkey * 7 % 400) * 5 as decimal(10,2)) * 0.01
           + case when c_nationkey = 24 then 40 else 0 end as lat,
         cast(-70 as decimal(10,2)) + cast((c_custkey * 13 % 400) * 5 as decimal(10,2)) * 0.01 as lng,
         'cidade ' || c_custkey % 3 as city, cast(c_nationkey as varchar) as state
  from customer"""

CTES["geo_modes"] = """
  select zip, city from (select zip, city, count(*) as n from geo_points group by all)
  qualify row_number() over (partition by zip order by n desc, city) = 1"""

CTES["geo_zip"] = """
  select p.zip as zip_code_prefix, quantile_cont(lat::double, 0.5) as lat, quantile_cont(lng::double, 0.5) as lng,
         any_value(m.city) as city, any_value(p.state) as state, count(*) as sample_count
  from geo_points p join geo_modes m on m.zip = p.zip group by p.zip"""

CTES["dim_geo"] = """
  select s.state_code, state_name, region, state_name || ', World' as map_location, 'World' as country,
         round(sum(cast(lat as decimal(12,6)) * sample_count)::decimal(24,6)::double / sum(sample_count), 6) as latitude,
         round(sum(cast(lng as decimal(12,6)) * sample_count)::decimal(24,6)::double / sum(sample_count), 6) as longitude
  from states s
  left join (select * from geo_zip where lat between -34.0 and 5.5 and lng between -74.0 and -34.0) g
    on g.state = s.state_code
  group by all"""

CTES["dim_date"] = """
  select cast(strftime(d, '%Y%m%d') as integer) as date_key, d as date, year(d) as year, quarter(d) as quarter,
         'Q' || quarter(d) as quarter_name, year(d) || ' Q' || quarter(d) as year_quarter,
         month(d) as month_number, monthname(d) as month_name, strftime(d, '%b') as month_short,
         cast(strftime(d, '%Y%m') as integer) as year_month, strftime(d, '%b %Y') as year_month_label,
         cast(date_trunc('month', d) as date) as month_start, last_day(d) as month_end,
         weekofyear(d) as iso_week, strftime(d, '%G-W%V') as iso_year_week,
         cast(date_trunc('week', d) as date) as week_start, day(d) as day_of_month, dayofyear(d) as day_of_year,
         isodow(d) as day_of_week, dayname(d) as day_name, strftime(d, '%a') as day_short,
         isodow(d) >= 6 as is_weekend, d = last_day(d) as is_month_end,
         month(d) = 1 and day(d) = 1 as is_year_start, cast(d - interval 1 year as date) as date_ly
  from (select cast(unnest(generate_series(date_trunc('year', min(o_orderdate)),
                      date_trunc('year', max(o_orderdate)) + interval 1 year - interval 1 day,
                      interval 1 day)) as date) as d from orders)"""

CTES["seq"] = """
  select order_id, customer_unique_id,
         row_number() over (partition by customer_unique_id order by purchase_ts, order_id) as order_seq
  from src_people"""

CTES["dim_customer"] = f"""
  select l.customer_unique_id, city as customer_city, l.state_code as customer_state_code,
         state_name as customer_state, region as customer_region, zip_code_prefix as customer_zip_prefix,
         first_order_date, last_order_date, cast(date_trunc('month', first_order_date) as date) as cohort_month,
         strftime(first_order_date, '%b %Y') as cohort_month_label,
         cast(strftime(first_order_date, '%Y%m') as integer) as cohort_month_key,
         coalesce(n, 0) as lifetime_orders, coalesce(n, 0) > 1 as is_repeat_customer
  from (select * from src_people qualify row_number() over (
            partition by customer_unique_id order by purchase_date desc, order_id desc) = 1) l
  left join (select customer_unique_id, min(purchase_date) as first_order_date,
                    max(purchase_date) as last_order_date, count(*) as n
             from src_people where {VALID} group by 1) a using (customer_unique_id)
  left join states s on s.state_code = l.state_code"""

CTES["fact_orders"] = f"""
  select o.order_id, o.customer_unique_id, o.customer_id, purchase_date,
         cast(strftime(purchase_date, '%Y%m%d') as integer) as date_key,
         cast(delivered_ts as date) as delivered_date, state_code as customer_state_code,
         coalesce(primary_payment_type, 'unknown') as payment_type, order_status,
         order_status = 'delivered' as is_delivered, not ({VALID}) as is_cancelled, {VALID} as is_valid_sale,
         order_seq, order_seq = 1 as is_first_order,
         case when order_seq = 1 then 'New' else 'Returning' end as customer_type,
         coalesce(items_in_order, 0) as items_in_order, coalesce(distinct_products, 0) as distinct_products,
         coalesce(distinct_sellers, 0) as distinct_sellers, coalesce(order_revenue, 0) as order_revenue,
         coalesce(order_freight, 0) as order_freight, coalesce(order_total, 0) as order_total,
         payment_total, payment_method_count, coalesce(primary_installments, 1) as installments,
         coalesce(payment_total, 0) - coalesce(order_total, 0) as payment_gap,
         review_score, review_band, has_comment, comment_length, approval_hours, delivery_days,
         20 as promised_days, delivery_days - 20 as days_vs_promise,
         delivered_ts > estimated_delivery_ts as is_late
  from src_people o
  join seq on seq.order_id = o.order_id
  left join (select order_id, count(*) as items_in_order, count(distinct product_id) as distinct_products,
                    count(distinct seller_id) as distinct_sellers, sum(price) as order_revenue,
                    sum(freight_value) as order_freight, sum(item_total) as order_total
             from stg_items group by 1) i on i.order_id = o.order_id
  left join pay on pay.order_id = o.order_id
  left join rev on rev.order_id = o.order_id"""

_PAID = "cast(coalesce(payment_total, w.order_item_total) * 100 as hugeint)"
_ITEM = "cast(w.item_total * 100 as hugeint)"
_TOTAL = "cast(w.order_item_total * 100 as hugeint)"
_ALLOCATED = (
    f"case when {_TOTAL} <> 0 then cast((2 * {_PAID} * {_ITEM} + {_TOTAL}) // (2 * {_TOTAL}) as double)"
    " / 100 end"
)

CTES["fact_sales"] = f"""
  select w.order_id || '-' || w.order_item_id as order_item_key, w.order_id, w.order_item_id,
         f.customer_unique_id, f.customer_id, w.product_id, w.seller_id, f.purchase_date, f.date_key,
         f.delivered_date, f.customer_state_code, f.payment_type, f.order_status, f.is_delivered,
         f.is_valid_sale, w.n as items_in_order, f.order_seq, f.is_first_order, w.price, w.freight_value,
         w.item_total, w.freight_ratio, {_ALLOCATED} as allocated_payment,
         f.installments, f.review_score as review_score_oa, f.review_band as review_band_oa
  from (select *, sum(item_total) over (partition by order_id) as order_item_total,
               count(*) over (partition by order_id) as n from stg_items) w
  join fact_orders f on f.order_id = w.order_id"""

CTES["valid_orders"] = "select * from fact_orders where is_valid_sale"

CTES["as_of"] = """
  select max(purchase_date) as as_of_date, min(purchase_date) as data_start_date,
         cast(date_trunc('month', max(purchase_date)) as date) as as_of_month from valid_orders"""

CTES["rfm_scores"] = f"""
  select customer_unique_id, min(purchase_date) as first_order_date, max(purchase_date) as last_order_date,
         (select as_of_date from as_of) - max(purchase_date) as recency_days, count(*) as frequency,
         sum(order_total) as monetary, {mean("order_total")} as avg_order_value,
         {mean("review_score")} as avg_review_score,
         ntile(5) over (order by max(purchase_date), customer_unique_id) as r_score,
         case when count(*) = 1 then 1 when count(*) = 2 then 3 when count(*) = 3 then 4 else 5 end as f_score,
         ntile(5) over (order by sum(order_total), customer_unique_id) as m_score
  from valid_orders group by customer_unique_id"""

CTES["rfm"] = """
  select s.*, cast(r_score as varchar) || f_score || m_score as rfm_cell, seg.name as rfm_segment,
         seg.rank as segment_rank, seg.action as recommended_action
  from (select *, (f_score + m_score + 1) // 2 as fm_score,
          case when r_score >= 4 and (f_score + m_score + 1) // 2 >= 4 then 1
               when r_score <= 2 and (f_score + m_score + 1) // 2 = 5 then 2
               when r_score <= 2 and (f_score + m_score + 1) // 2 >= 3 then 3
               when r_score >= 3 and (f_score + m_score + 1) // 2 >= 3 then 4
               when r_score = 5 then 5 when r_score = 4 then 6 when r_score = 3 then 7
               when r_score = 2 then 8 else 9 end as rk
        from rfm_scores) s
  join (values (1, 'Champions', 'Reward. Early access, referral asks.'),
               (2, 'Cannot Lose Them', 'Win back now. Personal outreach, high-value offer.'),
               (3, 'At Risk', 'Reactivation campaign before they lapse for good.'),
               (4, 'Loyal Customers', 'Upsell and cross-sell. They already trust you.'),
               (5, 'New Customers', 'Onboard. Second-purchase nudge within 30 days.'),
               (6, 'Promising', 'Build the habit. Category recommendations.'),
               (7, 'Needs Attention', 'Re-engage with a reason to return.'),
               (8, 'Hibernating', 'Low-cost automated win-back only.'),
               (9, 'Lost', 'Do not spend. Suppress from paid targeting.')) seg(rank, name, action)
    on seg.rank = s.rk"""

CTES["cohort"] = f"""
  select f.cohort_month, a.activity_month,
         date_diff('month', f.cohort_month, a.activity_month) as month_index, z.cohort_size,
         count(distinct a.customer_unique_id) as active_customers, sum(a.spent) as cohort_revenue
  from (select customer_unique_id, cast(date_trunc('month', purchase_date) as date) as activity_month,
               sum(order_total) as spent from valid_orders group by 1, 2) a
  join (select customer_unique_id, cast(date_trunc('month', min(purchase_date)) as date) as cohort_month
        from valid_orders group by 1) f on f.customer_unique_id = a.customer_unique_id
  join (select cohort_month, count(*) as cohort_size
        from (select cast(date_trunc('month', min(purchase_date)) as date) as cohort_month
              from valid_orders group by customer_unique_id) group by 1) z on z.cohort_month = f.cohort_month
  group by 1, 2, 3, 4"""

CTES["ltv_ranked"] = f"""
  select customer_unique_id, count(*) as total_orders, sum(items_in_order) as total_items,
         sum(order_revenue) as product_revenue, sum(order_freight) as freight_paid,
         sum(order_total) as lifetime_value, {mean("order_total")} as avg_order_value,
         min(purchase_date) as first_order_date, max(purchase_date) as last_order_date,
         max(purchase_date) - min(purchase_date) as lifespan_days, {mean("review_score")} as avg_review_score,
         count(*) filter (where is_late) as late_deliveries
  from valid_orders group by customer_unique_id"""

CTES["ltv"] = f"""
  select *, {pct("running", "total", 4)} as cumulative_revenue_pct,
         {pct("revenue_rank", "people", 4)} as customer_percentile,
         case when ltv_decile = 1 then '1. Top 10%' when ltv_decile = 2 then '2. 10-20%'
              when ltv_decile <= 5 then '3. 20-50%' else '4. Bottom 50%' end as ltv_tier,
         case when lifetime_value < 50 then '1. Under R$50' when lifetime_value < 100 then '2. R$50-100'
              when lifetime_value < 250 then '3. R$100-250' when lifetime_value < 500 then '4. R$250-500'
              else '5. R$500+' end as ltv_band
  from (select *, row_number() over best as revenue_rank, ntile(10) over best as ltv_decile,
               sum(lifetime_value) over (order by lifetime_value desc, customer_unique_id
                                         rows unbounded preceding) as running,
               sum(lifetime_value) over () as total, count(*) over () as people
        from ltv_ranked window best as (order by lifetime_value desc, customer_unique_id))"""

CTES["pareto"] = f"""
  select *, {pct("freight_cost", "product_revenue", 2)} as freight_pct_of_product_revenue,
         {pct("gross_revenue", "total", 3)} as pct_of_total_revenue,
         {pct("running", "total", 3)} as cumulative_pct_of_revenue,
         {pct("running", "total", 3)} <= 80 as is_vital_few
  from (select *, row_number() over (order by gross_revenue desc, category, category_group) as revenue_rank,
               sum(gross_revenue) over (order by gross_revenue desc, category, category_group
                                        rows unbounded preceding) as running,
               sum(gross_revenue) over () as total
        from (select category, category_group, sum(price) as product_revenue,
                     sum(freight_value) as freight_cost, sum(item_total) as gross_revenue,
                     count(*) as items_sold, count(distinct order_id) as orders
              from fact_sales join dim_product using (product_id)
              where is_valid_sale group by 1, 2))"""

CTES["labels_pay"] = """
  select * from (values ('credit_card', 'Credit card', 1), ('boleto', 'Boleto', 2),
                        ('voucher', 'Voucher', 3), ('debit_card', 'Debit card', 4))
    t(payment_type, payment_type_label, sort_order)"""

CTES["bi_orders"] = f"""
  select f.* exclude (customer_state_code, date_key, customer_id, comment_length, approval_hours,
                      payment_method_count, payment_type),
         d.year as purchase_year, d.quarter as purchase_quarter, d.year_quarter, d.month_name as purchase_month_name,
         d.month_start as purchase_month, d.year_month, d.year_month_label, d.week_start as purchase_week,
         d.day_name as purchase_day_name, d.is_weekend, c.customer_city, c.customer_state,
         c.customer_state_code, c.customer_region, g.latitude as customer_latitude,
         g.longitude as customer_longitude, c.cohort_month, c.cohort_month_label,
         coalesce(payment_type_label, 'Unknown') as payment_method,
         case when delivery_days is null then 'Not delivered' else {SPEED} end as delivery_speed_band
  from fact_orders f join dim_date d on d.date = f.purchase_date
  join dim_customer c on c.customer_unique_id = f.customer_unique_id
  left join dim_geo g on g.state_code = f.customer_state_code
  left join labels_pay t on t.payment_type = f.payment_type"""

CTES["bi_sales"] = """
  select f.order_item_key, f.order_id, f.order_item_id, f.customer_unique_id, f.product_id, f.seller_id,
         f.purchase_date, d.year as purchase_year, d.quarter as purchase_quarter, d.year_quarter,
         d.month_number as purchase_month_number, d.month_name as purchase_month_name,
         d.month_start as purchase_month, d.year_month, d.year_month_label, d.week_start as purchase_week,
         d.day_name as purchase_day_name, d.day_of_week as purchase_day_of_week, d.is_weekend,
         c.customer_city, c.customer_state, c.customer_state_code, c.customer_region,
         g.latitude as customer_latitude, g.longitude as customer_longitude, c.cohort_month,
         c.cohort_month_label, c.is_repeat_customer, p.category as product_category,
         p.category_group as product_category_group, p.weight_band as product_weight_band,
         p.photo_band as product_photo_band, p.weight_g as product_weight_g, p.volume_cm3 as product_volume_cm3,
         s.seller_state, s.seller_region, coalesce(payment_type_label, 'Unknown') as payment_method,
         f.installments, f.order_status, f.is_valid_sale, f.is_delivered, f.items_in_order, f.order_seq,
         f.is_first_order, case when f.is_first_order then 'New' else 'Returning' end as customer_type,
         f.price, f.freight_value, f.item_total, f.allocated_payment, f.review_score_oa as order_review_score,
         f.review_band_oa as order_review_band
  from fact_sales f join dim_date d on d.date = f.purchase_date
  join dim_customer c on c.customer_unique_id = f.customer_unique_id
  join dim_product p on p.product_id = f.product_id
  left join dim_seller s on s.seller_id = f.seller_id
  left join dim_geo g on g.state_code = f.customer_state_code
  left join labels_pay t on t.payment_type = f.payment_type"""

CTES["bi_customer"] = """
  select c.* exclude (cohort_month_key, customer_zip_prefix), g.latitude as customer_latitude,
         g.longitude as customer_longitude, r.recency_days, r.frequency, r.monetary, r.r_score, r.f_score,
         r.m_score, r.fm_score, r.rfm_cell, r.rfm_segment, r.segment_rank, r.recommended_action,
         l.total_orders, l.total_items, l.product_revenue, l.freight_paid, l.lifetime_value,
         l.avg_order_value, l.avg_review_score, l.lifespan_days, l.late_deliveries, l.revenue_rank,
         l.ltv_decile, l.ltv_tier, l.ltv_band, l.cumulative_revenue_pct, l.customer_percentile
  from dim_customer c left join rfm r on r.customer_unique_id = c.customer_unique_id
  left join ltv l on l.customer_unique_id = c.customer_unique_id
  left join dim_geo g on g.state_code = c.customer_state_code"""

CTES["months"] = "select distinct month_start from dim_date"

CTES["monthly"] = """
  select m.month_start, sum(item_total) as revenue
  from months m left join fact_sales f
    on f.is_valid_sale and cast(date_trunc('month', f.purchase_date) as date) = m.month_start
  group by 1"""

CTES["daily"] = """
  select d.date, sum(item_total) as revenue
  from dim_date d left join fact_sales f on f.is_valid_sale and f.purchase_date = d.date
  group by 1"""

CTES["order_months"] = """
  select cast(date_trunc('month', purchase_date) as date) as month_start, sum(order_total) as revenue
  from valid_orders group by 1"""


def _uses(text: str) -> list[str]:
    words = set(re.findall(r"[a-z_]+", text))
    return [name for name in CTES if name in words]


def query(final: str) -> str:
    """`final` with the named queries it needs in front."""
    needed: set[str] = set()
    todo = _uses(final)
    while todo:
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            todo += [n for n in _uses(CTES[name]) if n != name]
    if not needed:
        return final.strip()
    parts = ",\n".join(f"{name} as ({CTES[name]}\n)" for name in CTES if name in needed)
    return f"with {parts}\n{final.strip()}"

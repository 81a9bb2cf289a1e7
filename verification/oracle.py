"""The SQL each registered query is checked against."""

from __future__ import annotations

import re

from verification.oracle_base import CTES, SPEED, avg, mean, pct, plain, query, ratio, INITCAP

ORDERS_WHERE = (
    "purchase_date between date '1996-03-15' and date '1999-06-30' and customer_region in ('ASIA', 'EUROPE')"
)
SALES_WHERE = ORDERS_WHERE + " and product_category_group in ('ECONOMY', 'STANDARD', 'Other')"


def out(source: str, *, text: str = "", dates: str = "", nums: str = "", ints: str = "") -> str:
    """Select columns in portable types: `text` as it is, the rest cast."""
    columns = text.split()
    columns += [f"cast({c} as varchar) as {c}" for c in dates.split()]
    columns += [f"cast({c} as double) as {c}" for c in nums.split()]
    columns += [f"cast({c} as bigint) as {c}" for c in ints.split()]
    return query(f"select {', '.join(columns)} from {source}")


# Letters without a base letter under an accent are spelled out.
SPELLED = "trim(lower(text), ' ')"
for _letter, _plain in {"æ": "ae", "ß": "ss", "œ": "oe", "ø": "o", "đ": "d", "ł": "l", "ı": "i"}.items():
    SPELLED = f"replace({SPELLED}, '{_letter}', '{_plain}')"

SALES_TEXT = "order_item_key order_id customer_unique_id product_id seller_id order_status is_delivered is_valid_sale is_first_order"

# What a dirty order, item or review is refused for.
ORDER_VERDICT = (
    "case when k % 109 = 0 then 'bad_timestamp' when k % 113 = 0 then 'missing_fk'"
    " when k % 127 = 0 then 'null_required' else 'ok' end"
)
ITEM_VERDICT = (
    "case when k % 101 = 0 then 'bad_numeric' when k % 103 = 0 then 'negative_price'"
    " when k % 107 = 0 then 'missing_fk' else 'ok' end"
)
REVIEW_VERDICT = "case when k % 131 = 0 then 'bad_score' else 'ok' end"
GOOD = "(k % 109 <> 0 and k % 113 <> 0 and k % 127 <> 0)"

LOADED = f"""
  select 'raw.customers' as subject, count(*) as row_count from src_orders where {GOOD}
  union all select 'raw.orders', count(*) from src_orders where {GOOD}
  union all select 'raw.order_items', count(*) from src_items where {GOOD} and {ITEM_VERDICT} = 'ok'
  union all select 'raw.order_payments', count(*) from src_payments
            where order_id in (select order_id from src_orders where {GOOD})
  union all select 'raw.order_reviews', count(*) from src_reviews where {GOOD} and {REVIEW_VERDICT} = 'ok'"""
REFUSED = f"""
  select 'seed.orders' as source_table, {ORDER_VERDICT} as error_type, count(*) as rows
  from src_orders where not {GOOD} group by 2
  union all select 'seed.order_items', {ITEM_VERDICT}, count(*) from src_items
            where {GOOD} and {ITEM_VERDICT} <> 'ok' group by 2
  union all select 'seed.order_reviews', {REVIEW_VERDICT}, count(*) from src_reviews
            where {GOOD} and {REVIEW_VERDICT} <> 'ok' group by 2"""
COUNTS = query(f"""
  select subject, row_count from ({LOADED})
  union all select source_table || ' ' || error_type, rows from ({REFUSED})""")

ROWS = query(f"""
  select 'raw.orders' as table_name, order_id, null::bigint as number, customer_id as other,
         null::double as amount, order_status as text from src_orders where {GOOD}
  union all select 'raw.customers', null, null, customer_id, null, customer_unique_id from src_people where {GOOD}
  union all select 'raw.order_items', order_id, order_item_id, product_id, cast(price as double), seller_id
            from src_items where {GOOD} and {ITEM_VERDICT} = 'ok'
  union all select 'raw.order_payments', order_id, payment_sequential, null, cast(payment_value as double), payment_type
            from src_payments where order_id in (select order_id from src_orders where {GOOD})
  union all select 'raw.order_reviews', order_id, review_score, review_id, null, null
            from src_reviews where {GOOD} and {REVIEW_VERDICT} = 'ok'""")

# Measures over the flat relations s (items) and o (orders).
SALES_CORE = """sum(item_total) filter (where is_valid_sale) as total_revenue,
  sum(price) filter (where is_valid_sale) as product_revenue,
  sum(freight_value) filter (where is_valid_sale) as freight_cost,
  count(*) filter (where is_valid_sale) as total_items,
  coalesce(sum(item_total) filter (where is_valid_sale and is_first_order), 0) as new_customer_revenue"""
ORDERS_CORE = """count(distinct order_id) filter (where is_valid_sale) as total_orders,
  count(distinct customer_unique_id) filter (where is_valid_sale) as total_customers,
  count(distinct customer_unique_id) filter (where is_valid_sale and is_first_order) as new_customers,
  count(distinct order_id) filter (where is_cancelled) / count(distinct order_id)::double as cancellation_rate,
  sum(order_freight) filter (where is_valid_sale) as order_freight"""
CORE = f"""cast(total_revenue as double) as total_revenue, cast(product_revenue as double) as product_revenue,
  cast(freight_cost as double) as freight_cost, total_orders, total_items, total_customers,
  {plain("total_revenue", "total_orders")} as avg_order_value,
  {plain("total_items", "total_orders")} as avg_items_per_order,
  {plain("total_revenue", "total_customers")} as revenue_per_customer, cancellation_rate"""


def core(by: dict[str, str], sales_where: str = "true", orders_where: str = "true") -> str:
    names = "".join(f"{expr} as {name}, " for name, expr in by.items())
    keys = ", ".join(by)
    group = "group by all" if by else ""
    join = f"full join o using ({keys})" if by else "cross join o"
    head = "".join(f"{name}, " for name in by)
    return query(f"""
  select {head}{CORE}
  from (select {names}{SALES_CORE} from bi_sales where {sales_where} {group}) s
  {join.replace(" o", f" (select {names}{ORDERS_CORE} from bi_orders where {orders_where} {group}) o")}""")


# Whole years around the test tables' purchases.
CALENDAR_MONTHS = 84

YEAR = {"purchase_year": "year(purchase_date)"}

COHORT_OUT = f"""
  select cast(cohort_month as varchar) as cohort_month, strftime(cohort_month, '%b %Y') as cohort_month_label,
         cast(strftime(cohort_month, '%Y%m') as bigint) as cohort_month_key, month_index,
         'M' || case when month_index < 10 then '0' else '' end || month_index as month_index_label,
         cast(activity_month as varchar) as activity_month, cohort_size, active_customers,
         {pct("active_customers", "cohort_size", 2)} as retention_pct,
         cast(cohort_revenue as double) as cohort_revenue,
         {ratio("cohort_revenue", "cohort_size", 2)} as revenue_per_cohort_customer from """

COHORT_METRICS = f"""
  {plain("sum(active)", "sum(size)")} as retention_pct, cast(sum(size) as bigint) as cohort_customers,
  {plain("sum(a1)", "sum(s1)")} as m1_retention_pct, {plain("sum(a3)", "sum(s3)")} as m3_retention_pct,
  {plain("sum(a6)", "sum(s6)")} as m6_retention_pct, {plain("sum(rev)", "sum(size)")} as revenue_per_cohort_customer
  from (select cohort_month, sum(active_customers) as active, max(cohort_size) as size, sum(cohort_revenue) as rev,
          sum(active_customers) filter (where month_index = 1) as a1, max(cohort_size) filter (where month_index = 1) as s1,
          sum(active_customers) filter (where month_index = 3) as a3, max(cohort_size) filter (where month_index = 3) as s3,
          sum(active_customers) filter (where month_index = 6) as a6, max(cohort_size) filter (where month_index = 6) as s6
        from cohort group by 1)"""

EXPERIENCE_SQL = f"""
  {avg("review_score", "is_valid_sale")} as avg_review_score,
  count(distinct order_id) filter (where is_valid_sale and review_score is not null) as reviewed_orders,
  count(distinct order_id) filter (where review_band = 'Detractor (1-2)')::double
    / count(distinct order_id) filter (where is_valid_sale and review_score is not null) as detractor_pct,
  count(distinct order_id) filter (where review_band = 'Promoter (4-5)')::double
    / count(distinct order_id) filter (where is_valid_sale and review_score is not null) as promoter_pct,
  cast(sum(order_total) filter (where is_valid_sale and review_band = 'Detractor (1-2)') as double) as revenue_at_risk,
  {avg("delivery_days")} as avg_delivery_days, {avg("promised_days")} as avg_promised_days,
  {plain("count(*) filter (where is_late)", "count(*) filter (where is_delivered)")} as late_delivery_pct,
  {avg("days_vs_promise")} as avg_days_vs_promise,
  {plain("sum(order_freight) filter (where is_valid_sale)", "count(*) filter (where is_valid_sale)")} as avg_freight_per_order,
  cast(max(purchase_date) as varchar) as data_as_of"""

DQ = f"""
  select * from (values
    ('orphan_items_no_product', 'error', 0.0::double, 'order items whose product_id is missing from dim_product',
      (select count(*) from fact_sales where product_id not in (select product_id from dim_product))::double),
    ('orphan_orders_no_customer', 'error', 0.0, 'orders whose customer_id is missing from raw.customers',
      (select count(*) from src_orders where customer_id not in (select customer_id from src_people))),
    ('negative_amounts', 'error', 0.0, 'order items with negative price or freight',
      (select count(*) from src_items where price < 0 or freight_value < 0)),
    ('fact_revenue_reconciliation', 'error', 0.05, 'absolute difference between fact_sales and fact_orders revenue',
      (select abs((select sum(item_total) from fact_sales where is_valid_sale)
                  - (select sum(order_total) from valid_orders)))),
    ('fact_sales_grain_unique', 'error', 0.0, 'duplicate order_item_key values in fact_sales',
      (select count(*) from (select 1 from fact_sales group by order_item_key having count(*) > 1))),
    ('dates_outside_dim_date', 'error', 0.0, 'orders whose purchase_date falls outside dim_date',
      (select count(*) from fact_orders where purchase_date not in (select date from dim_date))),
    ('review_score_out_of_range', 'error', 0.0, 'reviews outside the 1-5 scale',
      (select count(*) from src_reviews where review_score not between 1 and 5)),
    ('batch_reject_rate_pct', 'warn', 1.0, 'share of rows rejected by the latest drip batch', null),
    ('orders_with_payment_gap_pct', 'warn', 5.0, 'share of orders where payments differ from item totals by more than R$1',
      (select {pct("count(*) filter (where abs(payment_gap) > 1)", "count(*)", 2)} from valid_orders)),
    ('unknown_category_pct', 'warn', 3.0, 'share of products that fell through the category translation',
      (select {pct("count(*) filter (where category_key = 'unknown')", "count(*)", 2)} from dim_product)),
    ('customer_grain_collapsed', 'error', 0.0, '1 means customer_unique_id is not deduplicating -- retention metrics invalid',
      (select case when count(distinct customer_unique_id) >= count(distinct customer_id) then 1 else 0 end from src_people)),
    ('orders_skipped_silently', 'error', 0.0, 'orders the watermark has passed that are in neither raw.orders nor ops.load_errors', null),
    ('ingest_completeness_pct', 'info', 100.0, 'raw.orders as a share of seed.orders', null)
  ) t(check_name, severity, threshold, detail, observed)"""



def loaded_only(sql: str) -> str:
    """The same over what an ingest of the dirty feed loads; the feed itself becomes all_*."""
    verdicts = {"orders": GOOD, "items": f"{GOOD} and {ITEM_VERDICT} = 'ok'", "reviews": f"{GOOD} and {REVIEW_VERDICT} = 'ok'"}
    verdicts["payments"] = f"order_id in (select order_id from all_orders where {GOOD})"
    for name, accepted in verdicts.items():
        whole = CTES[f"src_{name}"]
        fed = re.sub(r"\bsrc_(orders|items|payments|reviews)\b", r"all_\1", whole)
        sql = sql.replace(
            f"src_{name} as ({whole}\n)", f"all_{name} as ({fed}\n),\nsrc_{name} as (select * from all_{name} where {accepted}\n)"
        )
    return sql


def dq_after_ingest() -> str:
    def fed(sql: str) -> str:
        return sql.replace("src_", "all_")

    every = f"(select sum(row_count) from ({fed(LOADED)}))"
    refused = f"(select sum(rows) from ({fed(REFUSED)}))"
    observed = {
        "batch_reject_rate_pct": pct(refused, f"{every} + {refused}", 2),
        "orders_skipped_silently": "0.0::double",
        "ingest_completeness_pct": pct("(select count(*) from src_orders)", "(select count(*) from all_orders)", 2),
    }
    checks = DQ
    for name, value in observed.items():
        before, after = checks.split(f"('{name}'", 1)
        checks = f"{before}('{name}'" + after.replace(" null)", f" {value})", 1)
    named = "src_orders, src_items, src_payments, src_reviews"
    return loaded_only(
        query(
            f"""select check_name, severity, detail, threshold, cast(observed as double) as observed,
                  case when severity <> 'info' and observed > threshold then 'fail' else 'pass' end as status
                from ({checks}) /* {named} */"""
        )
    )


SEEN = """select customer_region, count(*) as people, cast(sum(lifetime_value) as double) as total_ltv
  from bi_customer where {0} group by 1"""


def oracle_sql() -> dict[str, str]:
    sales = dict(
        text=SALES_TEXT + " customer_id customer_state_code payment_type review_band_oa",
        dates="purchase_date delivered_date",
        nums="price freight_value item_total freight_ratio allocated_payment",
        ints="order_item_id date_key items_in_order order_seq installments review_score_oa",
    )
    return {
        "landing_row_counts": query(
            """select 'orders' as table_name, count(*) as row_count from src_orders
               union all select 'customers', count(*) from src_orders where k % 113 <> 0
               union all select 'order_items', count(*) from src_items
               union all select 'order_payments', count(*) from src_payments
               union all select 'order_reviews', count(*) from src_reviews
               union all select 'products', count(*) from part
               union all select 'sellers', count(*) from supplier
               union all select 'category_translation', count(*) from (
                 select distinct p_type, p_brand from part where p_type <> 'SMALL')
               union all select 'geolocation', count(distinct zip) from geo_points"""
        ),
        "csv_landing": query(
            """select case when k % 109 <> 0 then strftime(purchase_ts, '%Y-%m') end as purchase_month,
                 count(*) as orders, cast(sum(n) as bigint) as items
               from src_orders left join (select order_id, count(*) as n from src_items group by 1) using (order_id)
               where k % 113 <> 0 group by 1"""
        ),
        "geolocation_aggregate": query(
            """select zip_code_prefix, round(lat, 6) as lat, round(lng, 6) as lng, city, state, sample_count
               from geo_zip"""
        ),
        "safe_cast_rejects": query(
            """select count(*) as items, count(*) filter (where k % 101 = 0) as bad_prices,
                 count(*) filter (where k % 101 <> 0 and k % 103 = 0) as negative_prices,
                 cast(sum(case when k % 101 = 0 then null when k % 103 = 0 then -price else price end) as double)
                   as parsed_total,
                 (select count(*) from src_orders where k % 109 = 0) as bad_timestamps,
                 (select cast(max(purchase_ts) as varchar) from src_orders where k % 109 <> 0) as last_ts
               from src_items"""
        ),
        "clean_place_text": query(
            f"""select doc_id, cleaned, length(cleaned) as n_chars from (
                 select doc_id, nullif({INITCAP.format("plain")}, '') as cleaned from (
                   select doc_id, regexp_replace(strip_accents({SPELLED}), '\\s+', ' ', 'g') as plain
                   from documents))"""
        ),
        "customers_staged": out("src_people", text="customer_id customer_unique_id zip_code_prefix city state_code"),
        "orders_staged": query(
            """select order_id, customer_id, order_status, cast(purchase_ts as varchar) as purchase_ts,
                 cast(purchase_date as varchar) as purchase_date, cast(approved_ts as varchar) as approved_ts,
                 cast(shipped_ts as varchar) as shipped_ts, cast(delivered_ts as varchar) as delivered_ts,
                 cast(estimated_delivery_ts as varchar) as estimated_delivery_ts,
                 order_status = 'delivered' as is_delivered, order_status = 'canceled' as is_cancelled,
                 approval_hours, delivery_days, 20::bigint as promised_days,
                 delivery_days - 20 as days_vs_promise, delivered_ts > estimated_delivery_ts as is_late
               from src_orders"""
        ),
        "items_deduped": out(
            "stg_items",
            text="order_id product_id seller_id",
            dates="shipping_limit_date",
            nums="price freight_value item_total freight_ratio",
            ints="order_item_id",
        ),
        "payments_staged": out(
            "src_payments",
            text="order_id payment_type",
            nums="payment_value",
            ints="payment_sequential payment_installments",
        ),
        "payments_summary": out(
            "pay",
            text="order_id primary_payment_type",
            nums="payment_total",
            ints="payment_line_count payment_method_count max_installments primary_installments",
        ),
        "payments_summary_legacy": query(
            """select p.order_id, max(r.payment_type) filter (where spot = 1) as primary_payment_type,
                 cast(sum(p.payment_value) as double) as payment_total, count(*) as payment_line_count,
                 count(distinct p.payment_type) as payment_method_count,
                 cast(max(p.payment_installments) as bigint) as max_installments,
                 cast(max(r.payment_installments) filter (where spot = 1) as bigint) as primary_installments
               from src_payments p
               join (select *, row_number() over (partition by order_id
                       order by payment_value desc, payment_sequential) as spot from src_payments) r
                 on r.order_id = p.order_id
               group by p.order_id"""
        ),
        "latest_review": out(
            "rev",
            text="order_id review_id has_comment review_band",
            dates="review_creation_date",
            ints="review_score comment_length response_days",
        ),
        "products_staged": query(
            f"""select product_id, category_pt, category_key,
                  {INITCAP.format("replace(category_key, '_', ' ')")} as category_en, category_group,
                  cast(name_length as bigint) as name_length, cast(description_length as bigint) as description_length,
                  cast(photos_qty as bigint) as photos_qty, weight_g, length_cm, height_cm, width_cm, volume_cm3
                from stg_products"""
        ),
        "sellers_staged": query(
            """select cast(s_suppkey as varchar) as seller_id,
                 lpad(cast(s_nationkey * 4 + s_suppkey % 4 as varchar), 5, '0') as zip_code_prefix,
                 'Sao Nation-' || s_nationkey as city, cast(s_nationkey as varchar) as state_code from supplier"""
        ),
        "geolocation_staged": query(
            f"""select zip_code_prefix, round(lat, 6) as lat, round(lng, 6) as lng,
                  {INITCAP.format("city")} as city, state as state_code, sample_count
                from geo_zip where lat between -34.0 and 5.5 and lng between -74.0 and -34.0"""
        ),
        "dim_date": out(
            "dim_date",
            text="quarter_name year_quarter month_name month_short year_month_label iso_year_week day_name "
            "day_short is_weekend is_month_end is_year_start",
            dates="date month_start month_end week_start date_ly",
            ints="date_key year quarter month_number year_month iso_week day_of_month day_of_year day_of_week",
        ),
        "dim_customer": out(
            "dim_customer",
            text="customer_unique_id customer_city customer_state_code customer_state customer_region "
            "customer_zip_prefix cohort_month_label is_repeat_customer",
            dates="first_order_date last_order_date cohort_month",
            ints="cohort_month_key lifetime_orders",
        ),
        "product_bands": out(
            "dim_product",
            text="product_id category_key category category_group category_portuguese weight_band photo_band",
            nums="weight_g weight_kg length_cm height_cm width_cm volume_cm3",
            ints="photos_qty name_length description_length",
        ),
        "dim_seller": out(
            "dim_seller", text="seller_id seller_city seller_state_code seller_state seller_region"
        ),
        "dim_geo_centroid": out(
            "dim_geo", text="state_code state_name region map_location country latitude longitude"
        ),
        "order_sequence": out("seq", text="order_id customer_unique_id", ints="order_seq"),
        "fact_orders": out(
            "fact_orders",
            text="order_id customer_unique_id customer_id customer_state_code payment_type order_status "
            "is_delivered is_cancelled is_valid_sale is_first_order customer_type review_band has_comment is_late",
            dates="purchase_date delivered_date",
            nums="order_revenue order_freight order_total payment_total payment_gap approval_hours",
            ints="date_key order_seq items_in_order distinct_products distinct_sellers payment_method_count "
            "installments review_score comment_length delivery_days promised_days days_vs_promise",
        ),
        "fact_sales": out("fact_sales", **sales),
        "payment_allocation": query(
            """select payment_type, cast(sum(cast(allocated_payment as decimal(18,2))) as double) as allocated,
                 cast(sum(item_total) as double) as items from fact_sales group by 1"""
        ),
        "analysis_date": out("as_of", dates="as_of_date data_start_date as_of_month"),
        "rfm": out(
            "rfm",
            text="customer_unique_id rfm_cell rfm_segment recommended_action",
            dates="first_order_date last_order_date",
            nums="monetary avg_order_value avg_review_score",
            ints="recency_days frequency r_score f_score m_score fm_score segment_rank",
        ),
        "cohort_retention": query(COHORT_OUT + "cohort"),
        "cohort_dense": query(
            COHORT_OUT
            + """(select c.cohort_month, m.activity_month, date_diff('month', c.cohort_month, m.activity_month)
                    as month_index, c.cohort_size, coalesce(x.active_customers, 0) as active_customers,
                    coalesce(x.cohort_revenue, 0) as cohort_revenue
                  from (select distinct cohort_month, cohort_size from cohort) c
                  join (select cast(unnest(generate_series(min(cohort_month), max(activity_month),
                          interval 1 month)) as date) as activity_month from cohort) m
                    on m.activity_month >= c.cohort_month
                  left join cohort x on x.cohort_month = c.cohort_month and x.activity_month = m.activity_month)"""
        ),
        "customer_ltv": out(
            "ltv",
            text="customer_unique_id ltv_tier ltv_band",
            dates="first_order_date last_order_date",
            nums="product_revenue freight_paid lifetime_value avg_order_value avg_review_score "
            "cumulative_revenue_pct customer_percentile",
            ints="total_orders total_items lifespan_days late_deliveries revenue_rank ltv_decile",
        ),
        "category_pareto": out(
            "pareto",
            text="category category_group is_vital_few",
            nums="product_revenue freight_cost gross_revenue freight_pct_of_product_revenue "
            "pct_of_total_revenue cumulative_pct_of_revenue",
            ints="revenue_rank items_sold orders",
        ),
        "headline_kpis": query(
            f"""select count(distinct order_id) as orders, count(distinct customer_unique_id) as customers,
                  cast(sum(order_total) as double) as revenue, {mean("order_total")} as aov,
                  cast(sum(items_in_order) as bigint) as items, cast(min(purchase_date) as varchar) as first_day,
                  cast(max(purchase_date) as varchar) as last_day from valid_orders"""
        ),
        "concentration": query(
            """select cast(top as bigint) as top_pct,
                 (select max(cumulative_revenue_pct) from ltv where customer_percentile <= top) as share_of_revenue
               from (values (1), (5), (10), (20), (50)) t(top)"""
        ),
        "repeat_rate": query(
            f"""select count(*) as customers, count(*) filter (where total_orders > 1) as repeat_customers,
                  {pct("count(*) filter (where total_orders > 1)", "count(*)", 2)} as repeat_pct,
                  {ratio("sum(total_orders)", "count(*)", 3)} as avg_orders_per_customer,
                  {mean("lifetime_value")} as mean_ltv,
                  {ratio("min(mid) + max(mid)", "2", 2)} as median_ltv
                from (select *, case when abs(2 * row_number() over (order by lifetime_value) - count(*) over () - 1) <= 1
                                     then lifetime_value end as mid from ltv)"""
        ),
        "retention_pooled": query(
            f"""select month_index, count(*) as cohorts_old_enough, cast(sum(cohort_size) as bigint) as base_customers,
                  cast(sum(active_customers) as bigint) as still_active,
                  {pct("sum(active_customers)", "sum(cohort_size)", 2)} as retention_pct
                from cohort where month_index in (1, 3, 6, 12) group by 1"""
        ),
        "categories_to_80": query(
            f"""select count(*) filter (where is_vital_few) as categories_to_80pct, count(*) as categories_total,
                  {pct("count(*) filter (where is_vital_few)", "count(*)", 1)} as pct_of_categories from pareto"""
        ),
        "top_categories": query(
            """select cast(revenue_rank as bigint) as revenue_rank, category, category_group,
                 cast(gross_revenue as double) as revenue, pct_of_total_revenue as pct_of_total,
                 cumulative_pct_of_revenue as cumulative_pct, freight_pct_of_product_revenue as freight_pct
               from pareto order by revenue_rank limit 10"""
        ),
        "freight_erosion": query(
            """select category, category_group, cast(gross_revenue as double) as revenue,
                 freight_pct_of_product_revenue as freight_pct_of_revenue, items_sold from pareto
               where gross_revenue > (select quantile_cont(gross_revenue::double, 0.75) from pareto)
               order by freight_pct_of_product_revenue desc nulls first, category limit 10"""
        ),
        "late_vs_review": query(
            f"""select case when is_late is null then 'Unknown' when is_late then 'Late' else 'On time' end as delivery,
                  count(*) as orders, {mean("review_score")} as avg_review,
                  {pct("count(*) filter (where review_score <= 2)", "count(*)", 1)} as detractor_pct,
                  {mean("order_total")} as aov
                from valid_orders where is_delivered and review_score is not null group by 1"""
        ),
        "speed_bands": query(
            f"""select {SPEED} as speed_band, count(*) as orders, {mean("review_score")} as avg_review,
                  {mean("order_total")} as aov
                from valid_orders where is_delivered and review_score is not null group by 1"""
        ),
        "geo_share": query(
            f"""select *, {pct("cast(revenue as decimal(18,2))", "cast(all_revenue as decimal(18,2))", 2)} as pct_of_revenue
                from (select state_name, region, count(distinct order_id) as orders,
                        cast(sum(order_total) as double) as revenue, sum(sum(order_total)) over () as all_revenue,
                        {mean("order_total")} as aov, {mean("delivery_days", 1)} as avg_delivery_days,
                        {mean("review_score")} as avg_review
                      from valid_orders join states on state_code = customer_state_code group by 1, 2)
                order by revenue desc, state_name limit 12"""
        ).replace("select *, (case", "select * exclude (all_revenue), (case"),
        "payment_mix": query(
            f"""select * exclude (n), {pct("orders", "n", 1)} as pct_of_orders
                from (select payment_type_label, count(*) as orders, {mean("order_total")} as aov,
                        {mean("installments")} as avg_installments, {mean("review_score")} as avg_review,
                        sum(count(*)) over () as n
                      from valid_orders join labels_pay using (payment_type) group by 1)"""
        ),
        "rfm_segments": query(
            f"""select rfm_segment, cast(segment_rank as bigint) as segment_rank, customers,
                  cast(spent as double) as revenue, avg_value, avg_recency_days,
                  {pct("customers", "n", 1)} as pct_of_customers, {pct("spent", "all_spent", 1)} as pct_of_revenue
                from (select rfm_segment, segment_rank, count(*) as customers, sum(monetary) as spent,
                        {mean("monetary")} as avg_value, {mean("recency_days", 0)} as avg_recency_days,
                        sum(count(*)) over () as n, sum(sum(monetary)) over () as all_spent
                      from rfm group by 1, 2)"""
        ),
        "reject_reasons": query(f"select source_table, error_type, rows from ({REFUSED})"),
        "recent_batches": query(
            f"""select 1::bigint as batch_id, 'partial' as status,
                  (select count(*) from src_orders where k % 109 <> 0) as orders_attempted,
                  cast(loaded as bigint) as rows_loaded, cast(refused as bigint) as rows_rejected,
                  {pct("refused", "loaded + refused", 3)} as reject_rate_pct,
                  (select cast(max(purchase_ts) as varchar) from src_orders where k % 109 <> 0) as watermark_to
                from (select (select sum(row_count) from ({LOADED})) as loaded,
                             (select sum(rows) from ({REFUSED})) as refused)
                union all
                select 2, 'succeeded', 0, 0, 0, null,
                  (select cast(max(purchase_ts) as varchar) from src_orders where k % 109 <> 0)"""
        ),
        "core_metrics": core({}),
        "core_metrics_by_region_year": core({"customer_region": "customer_region", "purchase_year": "purchase_year"}),
        "core_metrics_filtered": core({"customer_state": "customer_state"}, SALES_WHERE, ORDERS_WHERE),
        "experience_metrics": query(
            f"""select purchase_year, o.* exclude (purchase_year), {plain("freight", "product")} as freight_pct_of_product_revenue
                from (select year(purchase_date) as purchase_year, {EXPERIENCE_SQL} from fact_orders group by 1) o
                join (select year(purchase_date) as purchase_year, sum(freight_value) as freight, sum(price) as product
                      from fact_sales where is_valid_sale group by 1) using (purchase_year)"""
        ),
        "new_vs_returning_metrics": query(
            f"""select purchase_year, new_customers, people - new_customers as returning_customers,
                  cast(fresh as double) as new_customer_revenue, cast(total - fresh as double) as returning_customer_revenue,
                  {plain("total - fresh", "total")} as returning_revenue_pct
                from (select year(purchase_date) as purchase_year,
                        count(distinct customer_unique_id) as people,
                        count(distinct customer_unique_id) filter (where is_first_order) as new_customers
                      from valid_orders group by 1)
                join (select year(purchase_date) as purchase_year, sum(item_total) as total,
                        sum(item_total) filter (where order_id in (select order_id from fact_orders where is_first_order))
                          as fresh
                      from fact_sales where is_valid_sale group by 1) using (purchase_year)"""
        ),
        "repeat_customer_pct": query(
            f"""select customer_region, {plain("count(*) filter (where is_repeat_customer)",
                  "count(*) filter (where lifetime_orders >= 1)")} as repeat_customer_pct
                from dim_customer group by 1"""
        ),
        "value_metrics": query(
            f"""select {plain("sum(lifetime_value) filter (where customer_percentile <= 20)", "sum(lifetime_value)")}
                    as top_20_pct_customer_revenue_share,
                  {avg("lifetime_value")} as avg_customer_ltv,
                  quantile_cont(lifetime_value::double, 0.5) as median_customer_ltv,
                  {avg("cast(lifespan_days::double / nullif(total_orders - 1, 0) as decimal(20,10))", "total_orders > 1")}
                    as avg_days_between_orders from ltv"""
        ),
        "ltv_by_band": query(
            f"""select ltv_band, {avg("lifetime_value")} as avg_customer_ltv,
                  quantile_cont(lifetime_value::double, 0.5) as median_customer_ltv from ltv group by 1"""
        ),
        "ltv_by_region": query(
            f"""select customer_region, {avg("lifetime_value")} as avg_customer_ltv,
                  quantile_cont(lifetime_value::double, 0.5) as median_customer_ltv
                from bi_customer where total_orders is not null group by 1"""
        ),
        "ltv_filtered": query(
            f"""select customer_state,
                  {plain("sum(lifetime_value) filter (where customer_percentile <= 20)", "sum(lifetime_value)")}
                    as top_20_pct_customer_revenue_share,
                  {avg("lifetime_value")} as avg_customer_ltv,
                  quantile_cont(lifetime_value::double, 0.5) as median_customer_ltv,
                  {avg("cast(lifespan_days::double / nullif(total_orders - 1, 0) as decimal(20,10))", "total_orders > 1")}
                    as avg_days_between_orders
                from bi_customer where total_orders is not null and customer_region in ('ASIA', 'EUROPE') group by 1"""
        ),
        "segments_filtered": query(
            """select rfm_segment, count(*) as customers_in_segment, cast(sum(monetary) as double) as segment_revenue
               from bi_customer where total_orders is not null and customer_region in ('ASIA', 'EUROPE') group by 1"""
        ),
        "retention_weighted": query(f"select {COHORT_METRICS}"),
        "retention_by_cohort": query(f"select cast(cohort_month as varchar) as cohort_month, {COHORT_METRICS} group by 1"),
        "categories_to_80_metric": query(
            "select count(distinct category) filter (where is_vital_few) as categories_to_80_pct from pareto"
        ),
        "segment_share": query(
            f"""select rfm_segment, count(*) as customers_in_segment, cast(sum(monetary) as double) as segment_revenue,
                  {plain("sum(monetary)", "(select sum(monetary) from rfm)")} as segment_revenue_pct
                from rfm group by 1"""
        ),
        "cumulative_share_ties": query(
            f"""select product_category, cast(revenue as double) as total_revenue,
                  {plain("revenue", "sum(revenue) over ()")} as pct_of_total_revenue,
                  {plain("sum(revenue) over (order by revenue desc range unbounded preceding)",
                         "sum(revenue) over ()")} as cumulative_revenue_pct
                from (select product_category, sum(item_total) as revenue from bi_sales where is_valid_sale group by 1)"""
        ),
        "pipeline_metrics": query(
            f"""select 0::bigint as rows_rejected_last_batch, {plain("refused", "loaded + refused")} as pipeline_reject_rate,
                  0::bigint as failed_batches,
                  (select cast(max(purchase_date) as varchar) from src_orders where {GOOD}) as data_as_of
                from (select (select sum(row_count) from ({LOADED})) as loaded,
                             (select sum(rows) from ({REFUSED})) as refused)"""
        ),
        "yoy_mom": query(
            """select cast(a.month_start as varchar) as month_start, cast(a.revenue as double) as revenue,
                 cast(y.revenue as double) as revenue_ly, cast(m.revenue as double) as revenue_pm,
                 (a.revenue::double - y.revenue::double) / nullif(y.revenue::double, 0) as revenue_yoy_pct,
                 (a.revenue::double - m.revenue::double) / nullif(m.revenue::double, 0) as revenue_mom_pct
               from monthly a left join monthly y on y.month_start = a.month_start - interval 1 year
               left join monthly m on m.month_start = a.month_start - interval 1 month"""
        ),
        "yoy_mom_by_region": query(
            """with r as (
                 select c.customer_region, m.month_start, sum(s.item_total) as revenue
                 from (select distinct customer_region from bi_sales where is_valid_sale) c cross join months m
                 left join bi_sales s on s.is_valid_sale and s.customer_region = c.customer_region
                   and s.purchase_month = m.month_start group by all)
               select a.customer_region, cast(a.month_start as varchar) as month_start, cast(a.revenue as double) as revenue,
                 cast(y.revenue as double) as revenue_ly, cast(m.revenue as double) as revenue_pm,
                 (a.revenue::double - y.revenue::double) / nullif(y.revenue::double, 0) as revenue_yoy_pct,
                 (a.revenue::double - m.revenue::double) / nullif(m.revenue::double, 0) as revenue_mom_pct
               from r a
               left join r y on y.customer_region = a.customer_region and y.month_start = a.month_start - interval 1 year
               left join r m on m.customer_region = a.customer_region and m.month_start = a.month_start - interval 1 month"""
        ).replace("\nwith r as", ",\nr as"),
        "mtd_qtd_ytd": query(
            """select cast(date as varchar) as date, cast(revenue as double) as revenue,
                 cast(sum(revenue) over (partition by date_trunc('month', date) order by date) as double) as revenue_mtd,
                 cast(sum(revenue) over (partition by date_trunc('quarter', date) order by date) as double) as revenue_qtd,
                 cast(sum(revenue) over (partition by year(date) order by date) as double) as revenue_ytd
               from daily"""
        ),
        "running_total": query(
            f"""select cast(d.date as varchar) as date, cast(revenue as double) as revenue,
                  cast(sum(revenue) over (order by d.date) as double) as running_revenue
                from (select date from dim_date where date between date '1996-03-15' and date '1999-06-30') d
                left join (select purchase_date, sum(item_total) as revenue from bi_sales
                           where is_valid_sale and {SALES_WHERE} group by 1) r on r.purchase_date = d.date"""
        ),
        "moving_avg_3m": query(
            """select cast(a.month_start as varchar) as month_start, cast(a.revenue as double) as revenue,
                 (select sum(b.revenue)::double / count(*) from monthly b
                  where b.month_start <= a.month_start and b.month_start > a.month_start - interval 3 month
                    and b.month_start >= (select min(month_start) from monthly where revenue is not null)) as moving_avg
               from monthly a"""
        ),
        "rolling_mean_3": query(
            f"""select cast(month_start as varchar) as month_start, cast(revenue as double) as revenue,
                  {plain("sum(revenue) over (order by month_start rows 2 preceding)",
                         "count(*) over (order by month_start rows 2 preceding)")} as rolling_mean from order_months"""
        ),
        "time_shift_yoy": query(
            """select cast(a.month_start as varchar) as month_start, cast(a.revenue as double) as revenue,
                 cast(b.revenue as double) as shifted_revenue,
                 (a.revenue::double - b.revenue::double) / nullif(b.revenue::double, 0) as pct_change
               from order_months a left join order_months b on b.month_start = a.month_start - interval 12 month"""
        ),
        "bi_sales_metrics": query(
            f"""select product_category_group, cast(sum(item_total) as double) as total_revenue,
                  cast(sum(price) as double) as product_revenue, cast(sum(freight_value) as double) as freight_cost,
                  count(*) as total_items, count(distinct order_id) as total_orders,
                  count(distinct customer_unique_id) as total_customers,
                  {plain("sum(item_total)", "count(distinct order_id)")} as avg_order_value,
                  {plain("sum(freight_value)", "sum(price)")} as freight_pct_of_revenue
                from bi_sales where is_valid_sale group by 1"""
        ),
        "bi_orders_metrics": query(
            f"""select customer_region, cast(sum(order_total) filter (where is_valid_sale) as double) as total_revenue,
                  count(*) filter (where is_valid_sale) as total_orders,
                  {avg("order_total", "is_valid_sale")} as avg_order_value,
                  {avg("review_score", "is_valid_sale")} as avg_review_score,
                  {plain("count(*) filter (where review_band = 'Detractor (1-2)')", "count(review_score)")} as detractor_pct,
                  {plain("count(*) filter (where review_band = 'Promoter (4-5)')", "count(review_score)")} as promoter_pct,
                  {plain("count(*) filter (where is_late)", "count(*) filter (where is_delivered)")} as late_delivery_pct,
                  {avg("delivery_days")} as avg_delivery_days, {avg("days_vs_promise")} as avg_days_vs_promise,
                  {plain("count(*) filter (where is_cancelled)", "count(*)")} as cancellation_rate,
                  cast(sum(order_total) filter (where is_valid_sale and is_first_order) as double) as new_customer_revenue,
                  {plain("sum(order_total) filter (where is_valid_sale and not is_first_order)",
                         "sum(order_total) filter (where is_valid_sale)")} as returning_revenue_pct,
                  cast(sum(order_total) filter (where is_valid_sale and review_band = 'Detractor (1-2)') as double)
                    as revenue_at_risk
                from bi_orders group by 1"""
        ),
        "bi_customer_metrics": query(
            f"""select rfm_segment, count(*) as customers,
                  {plain("count(*) filter (where is_repeat_customer)", "count(*) filter (where lifetime_orders >= 1)")}
                    as repeat_customer_pct,
                  cast(sum(lifetime_value) as double) as total_ltv, {avg("lifetime_value")} as avg_ltv,
                  quantile_cont(lifetime_value::double, 0.5) as median_ltv, {avg("recency_days")} as avg_recency_days
                from bi_customer group by 1"""
        ),
        "cohort_metrics": query(
            f"""select month_index, {plain("sum(active_customers)", "sum(cohort_size)")} as retention_pct,
                  cast(max(cohort_size) as bigint) as cohort_size from cohort group by 1"""
        ),
        "bi_sales": out(
            "bi_sales",
            text=SALES_TEXT + " year_quarter purchase_month_name year_month_label purchase_day_name is_weekend "
            "customer_city customer_state customer_state_code customer_region customer_latitude customer_longitude "
            "cohort_month_label is_repeat_customer product_category product_category_group product_weight_band "
            "product_photo_band seller_state seller_region payment_method customer_type order_review_band",
            dates="purchase_date purchase_month purchase_week cohort_month",
            nums="price freight_value item_total allocated_payment product_weight_g product_volume_cm3",
            ints="order_item_id purchase_year purchase_quarter purchase_month_number year_month purchase_day_of_week "
            "installments items_in_order order_seq order_review_score",
        ),
        "bi_orders": out(
            "bi_orders",
            text="order_id customer_unique_id year_quarter purchase_month_name year_month_label purchase_day_name "
            "is_weekend customer_city customer_state customer_state_code customer_region customer_latitude "
            "customer_longitude cohort_month_label order_status is_valid_sale is_delivered is_cancelled "
            "is_first_order customer_type payment_method review_band has_comment is_late delivery_speed_band",
            dates="purchase_date delivered_date purchase_month purchase_week cohort_month",
            nums="order_revenue order_freight order_total payment_total payment_gap",
            ints="purchase_year purchase_quarter year_month order_seq items_in_order distinct_products "
            "distinct_sellers installments review_score delivery_days promised_days days_vs_promise",
        ),
        "bi_customer": out(
            "bi_customer",
            text="customer_unique_id customer_city customer_state customer_state_code customer_region "
            "customer_latitude customer_longitude cohort_month_label is_repeat_customer rfm_cell rfm_segment "
            "recommended_action ltv_tier ltv_band",
            dates="first_order_date last_order_date cohort_month",
            nums="monetary product_revenue freight_paid lifetime_value avg_order_value avg_review_score "
            "cumulative_revenue_pct customer_percentile",
            ints="lifetime_orders recency_days frequency r_score f_score m_score fm_score segment_rank total_orders "
            "total_items lifespan_days late_deliveries revenue_rank ltv_decile",
        ),
        "revenue_trend": query(
            """select cast(purchase_month as varchar) as purchase_month,
                 cast(sum(order_total) filter (where is_valid_sale) as double) as total_revenue
               from bi_orders group by 1"""
        ),
        "revenue_by_state": query(
            """select customer_state, cast(sum(order_total) filter (where is_valid_sale) as double) as total_revenue
               from bi_orders group by 1"""
        ),
        "top_product_categories": query(
            """select product_category, cast(sum(item_total) as double) as total_revenue from bi_sales
               where is_valid_sale group by 1 order by 2 desc, 1 limit 10"""
        ),
        "segment_actions": query(
            f"""select rfm_segment, cast(segment_rank as bigint) as segment_rank, recommended_action,
                  count(*) as customers, cast(sum(lifetime_value) as double) as total_ltv,
                  {avg("recency_days")} as avg_recency_days from bi_customer group by 1, 2, 3"""
        ),
        "ltv_distribution": query("select ltv_band, count(*) as customers from bi_customer group by 1"),
        "cohort_pivot": query(
            "select cast(cohort_month as varchar) as cohort_month, strftime(cohort_month, '%b %Y') as cohort_month_label, "
            + ", ".join(
                f"{plain(f'sum(active_customers) filter (where month_index = {m})', 'max(cohort_size)')} as M{m:02d}"
                for m in range(CALENDAR_MONTHS)
            )
            + " from cohort group by 1, 2"
        ),
        "new_vs_returning": query(
            """select cast(purchase_month as varchar) as purchase_month, customer_type,
                 cast(sum(order_total) filter (where is_valid_sale) as double) as total_revenue
               from bi_orders group by 1, 2"""
        ),
        "lorenz_curve": query(
            """select cast(floor(customer_percentile) as bigint) as percentile_bin,
                 max(cumulative_revenue_pct) as cumulative_revenue_pct from ltv group by 1"""
        ),
        "pareto_chart": out(
            "pareto",
            text="category category_group cumulative_pct_of_revenue",
            nums="gross_revenue",
            ints="revenue_rank",
        ),
        "revenue_vs_freight": query(
            f"""select category, category_group, cast(product_revenue as double) as product_revenue,
                  freight_pct_of_product_revenue, items_sold,
                  (select {avg("product_revenue")} from pareto) as avg_product_revenue,
                  (select {avg("cast(freight_pct_of_product_revenue as decimal(18,2))")} from pareto) as avg_freight_pct
                from pareto"""
        ),
        "review_by_speed": query(
            f"""select delivery_speed_band, {avg("review_score", "is_valid_sale")} as avg_review_score,
                  {avg("order_total", "is_valid_sale")} as avg_order_value from bi_orders group by 1"""
        ),
        "revenue_by_review_band": query(
            """select review_band, cast(sum(order_total) filter (where is_valid_sale) as double) as total_revenue,
                 count(*) filter (where is_valid_sale) as total_orders from bi_orders group by 1"""
        ),
        "late_vs_on_time": query(
            f"""select is_late, count(*) filter (where is_valid_sale) as total_orders,
                  {avg("review_score", "is_valid_sale")} as avg_review_score,
                  {plain("count(*) filter (where review_band = 'Detractor (1-2)')", "count(review_score)")} as detractor_pct,
                  {avg("order_total", "is_valid_sale")} as avg_order_value from bi_orders group by 1"""
        ),
        "category_detail": query(
            f"""select product_category, cast(sum(item_total) filter (where is_valid_sale) as double) as total_revenue,
                  {plain("sum(freight_value) filter (where is_valid_sale)", "sum(price) filter (where is_valid_sale)")}
                    as freight_pct_of_revenue,
                  count(*) filter (where is_valid_sale) as total_items
                from bi_sales where {SALES_WHERE} group by 1"""
        ),
        "product_drilldown": query(
            f"""select product_category_group, product_weight_band, product_photo_band,
                  cast(sum(item_total) filter (where is_valid_sale) as double) as total_revenue,
                  {plain("sum(freight_value) filter (where is_valid_sale)", "sum(price) filter (where is_valid_sale)")}
                    as freight_pct_of_revenue,
                  count(*) filter (where is_valid_sale) as total_items
                from bi_sales group by 1, 2, 3"""
        ),
        "segment_sales": query(
            """select cast(date_trunc('month', purchase_date)::date as varchar) as purchase_month,
                 cast(sum(item_total) as double) as total_revenue
               from fact_sales where is_valid_sale
                 and customer_unique_id in (select customer_unique_id from rfm where rfm_segment = 'At Risk')
               group by 1"""
        ),
        "keyset_window": query(
            """select cast(ts as varchar) as purchase_ts, event_id as order_id, user_id, event_type
               from events where (ts, event_id) > (timestamp '2024-01-10 00:00:00', 0) order by ts, event_id limit 500"""
        ),
        "insert_if_absent": query(
            """select event_type, count(*) as inserted, min(event_id) as first_id, cast(max(ts) as varchar) as last_ts
               from events where not (ts, event_id) <= (timestamp '2024-01-10 00:00:00', 0) group by 1"""
        ),
        "reject_classification": query(
            f"""select 'orders' as source_table, {ORDER_VERDICT} as verdict, count(*) as rows from src_orders group by 2
                union all select 'order_items', {ITEM_VERDICT}, count(*) from src_items group by 2
                union all select 'order_payments', 'ok', count(*) from src_payments
                union all select 'order_reviews', {REVIEW_VERDICT}, count(*) from src_reviews group by 2"""
        ),
        "late_rows": query(
            """select order_id, customer_id, cast(purchase_ts as varchar) as purchase_ts from src_orders
               where k % 7 = 0 and k % 109 <> 0
                 and (purchase_ts, order_id) <= (timestamp '1998-01-01 00:00:00', '5')"""
        ),
        "drip_rows": ROWS,
        "stream_rows": ROWS,
        "stream_again": COUNTS,
        "stream_late": query(
            """with placed as (
                 select event_id, event_type, ts, ts < timestamp '2024-01-20 00:00:00' and event_id % 7 <> 0 as early from events),
               mark as (select date_trunc('millisecond', max(ts)) - interval 36 hour as w from placed where early)
               select event_id, event_type, cast(ts as varchar) as ts,
                 case when early or ts > w then 'accepted' else 'late' end as verdict from placed, mark"""
        ).replace("\nwith placed as", ",\nplaced as"),
        "late_children": query(
            f"""select order_id, cast(order_item_id as bigint) as order_item_id, product_id, seller_id,
                  cast(price as double) as price, cast(freight_value as double) as freight_value
                from src_items where {GOOD} and {ITEM_VERDICT} = 'ok' and k % 5 = 0"""
        ),
        "drip_equals_bulk": COUNTS,
        "stream_ingest": COUNTS,
        "dq_checks": query(
            f"""select check_name, severity, detail, threshold, cast(observed as double) as observed,
                  case when severity <> 'info' and observed > threshold then 'fail' else 'pass' end as status
                from ({DQ})"""
        ),
        "dq_checks_after_ingest": dq_after_ingest(),
        "ingest_cursor": query(
            f"""select 'orders_feed' as source_name, cast(max(purchase_ts) filter (where k % 109 <> 0) as varchar) as last_purchase_ts,
                  max_by(order_id, (purchase_ts, order_id)) filter (where k % 109 <> 0) as last_order_id,
                  count(*) filter (where k % 109 <> 0) as orders_ingested, 0::bigint as orders_waiting,
                  count(*) filter (where k % 109 = 0) as orders_unreadable,
                  {pct("count(*) filter (where k % 109 <> 0)", "count(*)", 2)} as ingested_pct
                from src_orders"""
        ),
        "reject_log": query(
            f"""select 1::bigint as batch_id, 'seed.orders' as source_table, {ORDER_VERDICT} as error_type, order_id as record_key
                from src_orders where not {GOOD}
                union all select 1, 'seed.order_items', {ITEM_VERDICT}, order_id || '#' || order_item_id
                from src_items where {GOOD} and {ITEM_VERDICT} <> 'ok'
                union all select 1, 'seed.order_reviews', {REVIEW_VERDICT}, review_id
                from src_reviews where {GOOD} and {REVIEW_VERDICT} <> 'ok'"""
        ),
        "rls_static": query(
            """select customer_state, cast(sum(item_total) as double) as revenue, count(*) as items
               from bi_sales where customer_region = 'ASIA' group by 1"""
        ),
        "rls_dynamic": query(SEEN.format("true")),
        "rls_dynamic_manager": query(SEEN.format("customer_region = 'EUROPE'")),
        "rls_dynamic_trend": query(
            """select cast(purchase_month as varchar) as purchase_month,
                 cast(sum(order_total) filter (where is_valid_sale) as double) as total_revenue
               from bi_orders where customer_region = 'ASIA' group by 1"""
        ),
        "rls_yoy_mom": query(
            """with r as (
                 select m.month_start, sum(s.item_total) as revenue from months m
                 left join bi_sales s on s.is_valid_sale and s.customer_region = 'ASIA'
                   and s.purchase_month = m.month_start group by all)
               select cast(a.month_start as varchar) as month_start, cast(a.revenue as double) as revenue,
                 cast(y.revenue as double) as revenue_ly, cast(m.revenue as double) as revenue_pm,
                 (a.revenue::double - y.revenue::double) / nullif(y.revenue::double, 0) as revenue_yoy_pct,
                 (a.revenue::double - m.revenue::double) / nullif(m.revenue::double, 0) as revenue_mom_pct
               from r a left join r y on y.month_start = a.month_start - interval 1 year
               left join r m on m.month_start = a.month_start - interval 1 month"""
        ).replace("\nwith r as", ",\nr as"),
        "rls_running_total": query(
            """select cast(d.date as varchar) as date, cast(revenue as double) as revenue,
                 cast(sum(revenue) over (order by d.date) as double) as running_revenue
               from dim_date d
               left join (select purchase_date, sum(item_total) as revenue from bi_sales
                          where is_valid_sale and customer_region = 'ASIA' group by 1) r on r.purchase_date = d.date"""
        ),
        "rls_unknown_user": query(SEEN.format("false")),
    }

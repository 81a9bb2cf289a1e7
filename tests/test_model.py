from __future__ import annotations

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderlens.operators.skew import SkewPolicy
from orderlens.plans import analytics, bi, dimensions, insights, staging
from orderlens.plans.mart import Mart
from orderlens.plans.metrics import Filters, evaluate, share_of_selection
from orderlens.sources import adapters
from orderlens.sources.landing import aggregate_geolocation
from orderlens.sources.schemas import LANDING

from tests.conftest import SMALL, day, frame, item, money, order


def one(df, **key):
    for name, value in key.items():
        df = df.filter(F.col(name) == value)
    found = df.collect()
    assert len(found) == 1
    return found[0]


def orders_and_customers(*pairs):
    return {"orders": [o for o, _ in pairs], "customers": [c for _, c in pairs]}


@pytest.fixture(scope="module")
def mart(spark):
    return Mart(adapters.raw_tables(spark, SMALL)).settled("fact_orders", "fact_sales", "dim_customer")


def test_order_milestones(raw_of):
    raw = raw_of(
        **orders_and_customers(
            order(
                1, "p", "2017-02-28 23:00:00",
                order_approved_at=day("2017-03-01 00:30:00"),
                order_delivered_customer_date=day("2017-03-20 10:00:00"),
                order_estimated_delivery_date=day("2017-03-20 00:00:00"),
            ),
            order(2, "p", "2017-03-01", "canceled"),
        )
    )
    staged = Mart(raw).orders
    first, second = one(staged, order_id="o1"), one(staged, order_id="o2")
    assert (first.approval_hours, first.delivery_days, first.promised_days) == (Decimal("1.50"), 20, 20)
    # Late by the clock although not by the day.
    assert (first.days_vs_promise, first.is_late) == (0, True)
    assert (second.is_late, second.delivery_days, second.is_cancelled) == (None, None, True)


def test_payment_summary_and_its_legacy_form(spark, raw_of):
    def line(number, kind, value, installments=1):
        return {
            "order_id": "o1", "payment_sequential": number, "payment_type": kind,
            "payment_installments": installments, "payment_value": money(value),
        }

    lines = [line(1, "voucher", 10, 1), line(2, "credit_card", 10, 3), line(3, "not_defined", 99), line(4, None, 99)]
    payments = staging.order_payments(raw_of(order_payments=lines).order_payments)
    summary = staging.order_payment_summary(payments).first()
    # Equal values: the earlier line is the primary one.
    assert summary.asDict() == {
        "order_id": "o1", "payment_total": money(20), "payment_line_count": 2, "payment_method_count": 2,
        "max_installments": 3, "primary_payment_type": "voucher", "primary_installments": 1,
    }
    legacy = staging.order_payment_summary(payments, legacy_fanout=True).first()
    assert (legacy.payment_total, legacy.payment_line_count) == (money(40), 4)


def test_latest_review(raw_of):
    def review(name, created, score=5):
        return {"review_id": name, "order_id": "o1", "review_score": score, "review_creation_date": created and day(created)}

    rows = [review("b", "2017-01-02", 1), review("a", "2017-01-02", 3), review("c", None)]
    assert staging.order_reviews(raw_of(order_reviews=rows).order_reviews).first().review_id == "a"


def test_product_names_fall_back(spark, raw_of):
    raw = raw_of(
        products=[
            {"product_id": "1", "product_category_name": " Cama_Mesa ", "product_weight_g": "499", "product_photos_qty": ""},
            {"product_id": "2", "product_category_name": "pc_gamer"},
            {"product_id": "3", "product_category_name": "", "product_weight_g": "x"},
        ],
        category_translation=[
            {"product_category_name": "cama_mesa", "product_category_name_english": "bed_bath_table"}
        ],
    )
    products = Mart(raw).dim_product
    named = {r.product_id: (r.category_key, r.category, r.category_group) for r in products.collect()}
    assert named == {
        "1": ("bed_bath_table", "Bed Bath Table", "Home & Furniture"),
        "2": ("pc_gamer", "Pc Gamer", "Electronics & Computing"),
        "3": ("unknown", "Unknown", "Other"),
    }
    first = one(products, product_id="1")
    assert (first.weight_band, first.photo_band, first.weight_kg) == ("1. Under 0.5kg", "No photo", Decimal("0.499"))


def test_geolocation_median_mode_and_box(spark, raw_of):
    def sample(lat, city, zip_code="7", lng="-46.5"):
        return {
            "geolocation_zip_code_prefix": zip_code, "geolocation_lat": lat, "geolocation_lng": lng,
            "geolocation_city": city, "geolocation_state": " sp",
        }

    samples = [sample("-23.1", "b"), sample("-23.4", "a"), sample("x", "b"), sample("-60", "a", "8")]
    points = aggregate_geolocation(frame(spark, LANDING["geolocation_samples"], samples))
    seven = one(points, zip_code_prefix="00007")
    assert (seven.lat, seven.city, seven.state, seven.sample_count) == (Decimal("-23.250000"), "a", "SP", 2)
    assert [r.zip_code_prefix for r in staging.geolocation(points).collect()] == ["00007"]


def test_calendar(spark, raw_of):
    raw = raw_of(**orders_and_customers(order(1, "p", "2016-02-29"), order(2, "p", "2017-06-01")))
    days = Mart(raw).dim_date
    assert (days.count(), days.agg(F.min("date"), F.max("date")).first()) == (
        731, (datetime.date(2016, 1, 1), datetime.date(2017, 12, 31)),
    )
    leap = one(days, date_key=20160229)
    assert (leap.date_ly, leap.is_month_end, leap.day_name) == (datetime.date(2015, 2, 28), True, "Monday")
    assert one(days, date_key=20160101).iso_year_week == "2015-W53"
    assert dimensions.dim_date(spark, raw.orders.filter("false"), "order_purchase_timestamp").count() == 1096


def test_facts_with_missing_parts(raw_of):
    raw = raw_of(
        **orders_and_customers(
            order(1, "p", "2017-01-01", "canceled"), order(2, "p", "2017-02-01"), order(3, "q", "2017-02-01")
        ),
        order_items=[item(1, 1, 0), item(2, 1, 1), item(2, 2, 1, product="y"), item(2, 3, 1, product="y")],
        order_payments=[
            {"order_id": "o2", "payment_sequential": 1, "payment_type": "boleto", "payment_installments": 1, "payment_value": money(10)}
        ],
    )
    mart = Mart(raw)
    empty, second = one(mart.fact_orders, order_id="o3"), one(mart.fact_orders, order_id="o2")
    assert (empty.items_in_order, empty.order_total, empty.payment_gap, empty.payment_type) == (0, 0, 0, "unknown")
    assert (second.distinct_products, second.distinct_sellers, second.payment_gap) == (2, 1, money(7))
    # The sequence counts the cancelled order, lifetime orders do not.
    assert (second.order_seq, second.customer_type) == (2, "Returning")
    assert one(mart.dim_customer, customer_unique_id="p").lifetime_orders == 1
    shares = {r.order_item_key: r.allocated_payment for r in mart.fact_sales.collect()}
    assert shares == {"o1-1": None, "o2-1": Decimal("3.33"), "o2-2": Decimal("3.33"), "o2-3": Decimal("3.33")}


def test_people_with_only_cancelled_orders_stay(raw_of):
    raw = raw_of(**orders_and_customers(order(1, "p", "2017-01-01", "unavailable"), order(2, "q", "2017-01-01")))
    mart = Mart(raw)
    person = one(mart.bi_customer, customer_unique_id="p")
    assert (person.lifetime_orders, person.rfm_segment, person.lifetime_value) == (0, None, None)
    assert person.customer_state == "Sao Paulo"


def test_hot_keys_change_nothing(spark):
    raw = adapters.raw_tables(spark, SMALL)
    cold = Mart(raw)
    hot = Mart(raw, skew=SkewPolicy(rows_per_task=0))
    assert hot.hot("product_id") and hot.hot("order_id") and hot.hot("customer_unique_id")
    for name in ("fact_orders", "fact_sales", "bi_sales"):
        a, b = getattr(cold, name), getattr(hot, name)
        assert a.columns == b.columns
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_the_flat_items_are_shuffled_before_they_are_labelled(mart):
    """Joins of the item fact from the outside in: the calendar's labels move with no shuffle."""
    plan = mart.bi_sales._jdf.queryExecution().analyzed().toString().splitlines()
    joins = [next(k for k, line in enumerate(plan) if "Join" in line and f"({on}#" in line) for on in _FLAT_JOINS]
    assert joins == sorted(joins)


_FLAT_JOINS = ("payment_type", "customer_state_code", "purchase_date", "customer_unique_id", "product_id", "seller_id")


def _same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_the_concentration_curve_needs_no_wide_person_table(spark, mart):
    narrow = mart.settled("fact_orders")
    shares = insights.concentration(narrow)
    assert not narrow.__dict__.keys() & {"_person_totals", "customer_ltv"}
    whole = Mart(mart.raw)
    whole.__dict__.update(fact_orders=mart.fact_orders, customer_ltv=mart.customer_ltv)
    assert _same(shares, insights.concentration(whole))
    assert _same(narrow.concentration_curve, mart.customer_ltv.select(*narrow.concentration_curve.columns))


def test_segments_of_a_place_need_scores_only(spark, mart):
    narrow = mart.settled("fact_orders", "dim_customer")
    names, where = ["customers_in_segment", "segment_revenue"], Filters(regions=("ASIA", "EUROPE"))
    found = evaluate(narrow, names, ["rfm_segment"], where)
    assert not narrow.__dict__.keys() & {"_person_totals", "customer_ltv", "bi_customer"}
    people = mart.bi_customer.filter("total_orders is not null and customer_region in ('ASIA', 'EUROPE')")
    wanted = people.groupBy("rfm_segment").agg(
        F.count(F.lit(1)).alias("customers_in_segment"), F.sum("monetary").alias("segment_revenue")
    )
    assert _same(found, wanted)
    assert _same(narrow.rfm_scores, mart.rfm.select(*narrow.rfm_scores.columns))


def test_invariants(mart):
    ltv, rfm, cohort = mart.customer_ltv, mart.rfm, mart.cohort
    people = ltv.count()
    assert rfm.count() == people
    founding = cohort.filter("month_index = 0").agg(F.sum("cohort_size")).first()[0]
    assert founding == people
    tiles = [r["count"] for r in ltv.groupBy("ltv_decile").count().collect()]
    assert max(tiles) - min(tiles) <= 1
    assert ltv.agg(F.max("cumulative_revenue_pct")).first()[0] == 100
    assert mart.category_pareto.agg(F.max("cumulative_pct_of_revenue")).first()[0] == 100
    sums = [
        mart.fact_sales.filter("is_valid_sale").agg(F.sum("item_total")).first()[0],
        mart.fact_orders.filter("is_valid_sale").agg(F.sum("order_total")).first()[0],
        ltv.agg(F.sum("lifetime_value")).first()[0],
        cohort.agg(F.sum("cohort_revenue")).first()[0],
    ]
    assert len(set(sums)) == 1


def test_cohort_gaps(raw_of):
    raw = raw_of(
        **orders_and_customers(order(1, "p", "2016-12-31"), order(2, "p", "2017-03-01"), order(3, "q", "2017-01-01")),
        order_items=[item(1, 1, 5), item(2, 1, 7), item(3, 1, 1)],
    )
    orders = Mart(raw).fact_orders
    sparse = {(str(r.cohort_month), r.month_index_label): r.active_customers for r in analytics.cohort(orders).collect()}
    assert sparse == {("2016-12-01", "M00"): 1, ("2016-12-01", "M03"): 1, ("2017-01-01", "M00"): 1}
    dense = {(str(r.cohort_month), r.month_index): r.active_customers for r in analytics.cohort(orders, dense=True).collect()}
    assert dense == {
        ("2016-12-01", 0): 1, ("2016-12-01", 1): 0, ("2016-12-01", 2): 0, ("2016-12-01", 3): 1,
        ("2017-01-01", 0): 1, ("2017-01-01", 1): 0, ("2017-01-01", 2): 0,
    }


def test_plans_hold_no_python_and_no_pair_joins(mart):
    for df in (mart.fact_orders, mart.fact_sales, bi.bi_orders(mart), bi.bi_sales(mart), mart.cohort):
        plan = df._jdf.queryExecution().toString()
        assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def _planned(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_reports_leave_out_lookups_they_do_not_ask_for(spark):
    """Sellers, reviews and payments are not read for the revenue of a category."""
    whole = Mart(adapters.raw_tables(spark, SMALL))
    tell = ["s_nationkey", "nth#", "boleto"]
    assert all(name in _planned(whole.bi_sales) for name in tell)
    revenue = whole.bi_sales.groupBy("product_category").agg(F.sum("item_total"))
    assert not [name for name in tell if name in _planned(revenue)]
    regions = whole.bi_orders.groupBy("customer_region").agg(F.count(F.lit(1)))
    assert not [name for name in [*tell, "l_orderkey"] if name in _planned(regions)]


def test_shares_of_a_selection_compute_its_rows_once(spark):
    shares = share_of_selection(Mart(adapters.raw_tables(spark, SMALL)), "product_category")
    assert "l_orderkey" not in _planned(shares)
    assert shares.agg(F.max("cumulative_revenue_pct")).first()[0] == 1

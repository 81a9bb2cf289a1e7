from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from orderlens.plans import dashboards, security
from orderlens.plans.mart import Mart
from orderlens.plans import time_intelligence as over_time
from orderlens.plans.metrics import STAR_MEASURES, Filters, evaluate
from orderlens.plans.quality import IngestState, dq_checks
from orderlens.sources import adapters
from orderlens.sources.landing import typed_feed
from orderlens.sources.schemas import LANDING, OPS

from tests.conftest import SMALL, day, frame, item, order


def build(raw_of, change=lambda rows: None):
    pairs = [order(1, "p", "2017-01-01"), order(2, "p", "2017-02-01"), order(3, "q", "2017-02-01")]
    rows = {
        "orders": [o for o, _ in pairs],
        "customers": [c for _, c in pairs],
        "order_items": [item(1, 1, 10), item(2, 1, 5), item(3, 1, 2)],
        "order_payments": [
            {"order_id": f"o{n}", "payment_sequential": 1, "payment_type": "boleto", "payment_installments": 1, "payment_value": item(n, 1, v)["price"]}
            for n, v in ((1, 10), (2, 5), (3, 2))
        ],
        "order_reviews": [{"review_id": "r", "order_id": "o1", "review_score": 5}],
        "products": [{"product_id": "x", "product_category_name": "auto"}],
    }
    change(rows)
    return Mart(raw_of(**rows))


def state(spark, attempted=3, rejected=0, feed=("o1", "o2", "o3")):
    orders = [{"order_id": o, "order_purchase_timestamp": "2017-01-01 00:00:00"} for o in feed]
    batch = {"batch_id": 1, "source_name": "orders_feed", "status": "partial", "orders_attempted": attempted, "rows_loaded": 9, "rows_rejected": rejected}
    drained = {"batch_id": 2, "source_name": "orders_feed", "status": "succeeded", "orders_attempted": 0, "rows_loaded": 0, "rows_rejected": 0}
    return IngestState(
        typed_feed(frame(spark, LANDING["orders"], orders)),
        frame(spark, OPS["load_batch"], [batch, drained]),
        frame(spark, OPS["load_errors"], []),
        day("2018-01-01"),
        "z",
    )


def failing(mart, ingest):
    return {r.check_name for r in dq_checks(mart, ingest).collect() if r.status == "fail"}


def test_a_clean_model_passes(spark, raw_of):
    assert failing(build(raw_of), state(spark)) == set()
    without = dq_checks(build(raw_of)).collect()
    assert len(without) == 13 and all(r.status == "pass" for r in without)


def _break_everything(rows):
    rows["order_items"] += [item(1, 1, 0), item(1, 2, 0, product="gone"), item(1, 3, -3)]
    rows["customers"].pop()
    rows["customers"][1].update(customer_unique_id="other")
    rows["order_reviews"].append({"review_id": "s", "order_id": "o2", "review_score": 6})
    rows["products"].append({"product_id": "y"})


def test_each_check_notices(spark, raw_of):
    assert failing(build(raw_of, _break_everything), state(spark)) == {
        "orphan_items_no_product",
        "orphan_orders_no_customer",
        "negative_amounts",
        "fact_sales_grain_unique",
        "review_score_out_of_range",
        "orders_with_payment_gap_pct",
        "unknown_category_pct",
        "customer_grain_collapsed",
    }


def test_ingest_checks_notice(spark, raw_of):
    assert failing(build(raw_of), state(spark, rejected=1)) == {"batch_reject_rate_pct"}
    skipped = failing(build(raw_of), state(spark, feed=("o1", "o2", "o3", "o4")))
    assert skipped == {"orders_skipped_silently"}


def test_calendar_and_reconciliation_checks(spark, raw_of):
    mart = build(raw_of)
    mart.__dict__["dim_date"] = mart.dim_date.filter("date < '2017-01-15'")
    assert "dates_outside_dim_date" in failing(mart, state(spark))
    mart = build(raw_of)
    mart.__dict__["fact_sales"] = mart.fact_sales.filter("order_id <> 'o1'")
    assert "fact_revenue_reconciliation" in failing(mart, state(spark))


def test_mapping_is_checked(spark):
    with pytest.raises(ValueError, match="Sotheast"):
        security.user_regions(spark, [("a@example.com", "Sotheast", None)])
    with pytest.raises(ValueError, match="once"):
        security.user_regions(spark, [("a@example.com", "South", None)] * 2)


def test_users_see_their_regions_everywhere(spark, raw_of):
    mart = build(raw_of, lambda rows: rows["customers"][2].update(customer_state="rs"))
    users = [("n@example.com", r, None) for r in ("South", "Southeast")] + [("s@example.com", "South", None)]
    mapping = security.user_regions(spark, users)
    for name in security.SECURED:
        seen = {
            user: getattr(security.SecuredMart(mart, mapping, f"{user}@example.com"), name).count()
            for user in ("n", "s", "x")
        }
        whole = getattr(mart, name).count()
        assert seen == {"n": whole, "s": 1, "x": 0}
        assert security.in_region(getattr(mart, name), "South").count() == 1
    mine = security.SecuredMart(mart, mapping, "s@example.com")
    with pytest.raises(AttributeError):
        mine.fact_sales
    got = evaluate(mine, ["total_revenue", "total_orders", "segment_revenue"]).first()
    assert [float(v) for v in got] == [2.0, 1.0, 2.0]
    assert dashboards.revenue_trend(mine).count() == 1
    assert over_time.yoy_mom(mine).filter("revenue is not null").count() == 1
    with pytest.raises(AttributeError):
        dashboards.cohort_pivot(mine)


def test_filters_reach_people_or_are_refused(raw_of):
    mart = build(raw_of, lambda rows: rows["customers"][2].update(customer_state="rs"))
    south = Filters(regions=["South"])
    whole = evaluate(mart, ["avg_customer_ltv", "customers_in_segment"]).first()
    part = evaluate(mart, ["avg_customer_ltv", "customers_in_segment"], where=south).first()
    assert part.customers_in_segment == 1 < whole.customers_in_segment
    by = evaluate(mart, ["avg_customer_ltv"], ["customer_region"]).collect()
    assert {r.customer_region: r.avg_customer_ltv for r in by}["South"] == part.avg_customer_ltv
    with pytest.raises(ValueError, match="customer_region"):
        south.apply(mart.dim_date)


def test_metrics_agree_with_hand_counts(raw_of):
    mart = build(raw_of, lambda rows: rows["orders"][2].update(order_status="canceled"))
    got = evaluate(mart, ["total_revenue", "total_orders", "cancellation_rate", "new_customers", "returning_revenue_pct"]).first()
    assert [float(v) for v in got] == [15.0, 2.0, 1 / 3, 1.0, 5 / 15]
    by_month = evaluate(mart, ["total_revenue"], ["purchase_month"], Filters(states=["Sao Paulo"]))
    assert {str(r.purchase_month): float(r.total_revenue or 0) for r in by_month.collect()} == {
        "2017-01-01": 10.0, "2017-02-01": 5.0,
    }
    with pytest.raises(ValueError, match="product_category"):
        evaluate(mart, ["total_orders"], ["product_category"])


def test_every_measure_evaluates(spark, raw_of):
    log = state(spark).load_batch
    row = evaluate(build(raw_of), list(STAR_MEASURES), pipeline=log).first()
    assert row.rows_rejected_last_batch == 0 and float(row.total_revenue) == 17.0
    assert row.median_customer_ltv == 8.5 and row.avg_days_between_orders == 31.0


def test_checks_compute_each_fact_once(spark):
    checked = dq_checks(Mart(adapters.raw_tables(spark, SMALL)))
    plan = checked._jdf.queryExecution().optimizedPlan().toString()
    # the check of raw amounts alone reads the lines again
    assert len(re.findall(r"Relation \[l_orderkey", plan)) == 1

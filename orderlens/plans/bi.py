"""Flat datasets: a fact with the labels of all its dimensions."""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions import bands
from orderlens.operators.small import one_per

if TYPE_CHECKING:
    from orderlens.plans.mart import Mart

_CALENDAR = {
    "purchase_year": "year",
    "purchase_quarter": "quarter",
    "year_quarter": "year_quarter",
    "purchase_month_number": "month_number",
    "purchase_month_name": "month_name",
    "purchase_month": "month_start",
    "year_month": "year_month",
    "year_month_label": "year_month_label",
    "purchase_week": "week_start",
    "purchase_day_name": "day_name",
    "purchase_day_of_week": "day_of_week",
    "is_weekend": "is_weekend",
}


def _with_calendar(fact: DataFrame, mart: Mart) -> DataFrame:
    # One row per day, which is bounded by the calendar.
    days = mart.dim_date.select(
        F.col("date").alias("purchase_date"), *[F.col(c).alias(n) for n, c in _CALENDAR.items()]
    )
    return fact.join(F.broadcast(days), "purchase_date")


def _with_places(fact: DataFrame, mart: Mart) -> DataFrame:
    places = mart.places.select(
        F.col("state_code").alias("customer_state_code"),
        F.col("latitude").alias("customer_latitude"),
        F.col("longitude").alias("customer_longitude"),
    )
    return fact.join(places, "customer_state_code", "left")


def _with_payment(fact: DataFrame, mart: Mart) -> DataFrame:
    labels = mart.payment_labels.select("payment_type", "payment_type_label")
    method = F.coalesce("payment_type_label", F.lit("Unknown"))
    return fact.join(labels, "payment_type", "left").withColumn("payment_method", method)


_PERSON = (
    "customer_unique_id",
    "customer_city",
    "customer_state",
    "customer_state_code",
    "customer_region",
    "cohort_month",
    "cohort_month_label",
    "is_repeat_customer",
)


def _with_person(fact: DataFrame, mart: Mart, spread: str) -> DataFrame:
    """The fact keeps the state of the order for geography; labels follow the person."""
    people = mart.mv_dim_customer.select(*_PERSON).withColumnRenamed(
        "customer_state_code", "_person_state"
    )
    return mart.lookup(fact, people, "customer_unique_id", "inner", [spread])


def bi_sales(mart: Mart) -> DataFrame:
    """One row per order item."""
    products = mart.dim_product.select(
        "product_id",
        F.col("category").alias("product_category"),
        F.col("category_group").alias("product_category_group"),
        F.col("weight_band").alias("product_weight_band"),
        F.col("photo_band").alias("product_photo_band"),
        F.col("weight_g").alias("product_weight_g"),
        F.col("volume_cm3").alias("product_volume_cm3"),
    )
    sellers = one_per(mart.dim_seller.select("seller_id", "seller_state", "seller_region"), ["seller_id"])
    # What is broadcast comes last, and people's labels after products and sellers: each shuffle
    # of the fact carries only what the ones before it have added.
    flat = mart.lookup(mart.fact_sales, sellers, "seller_id", "left", ["order_item_key"])
    flat = mart.lookup(flat, products, "product_id", "inner", ["order_item_key"])
    flat = _with_person(flat, mart, "order_item_key")
    flat = _with_calendar(flat, mart)
    flat = _with_payment(_with_places(flat, mart), mart)
    return flat.select(
        "order_item_key",
        "order_id",
        "order_item_id",
        "customer_unique_id",
        "product_id",
        "seller_id",
        "purchase_date",
        *_CALENDAR,
        "customer_city",
        "customer_state",
        F.col("_person_state").alias("customer_state_code"),
        "customer_region",
        "customer_latitude",
        "customer_longitude",
        "cohort_month",
        "cohort_month_label",
        "is_repeat_customer",
        "product_category",
        "product_category_group",
        "product_weight_band",
        "product_photo_band",
        "product_weight_g",
        "product_volume_cm3",
        "seller_state",
        "seller_region",
        "payment_method",
        "installments",
        "order_status",
        "is_valid_sale",
        "is_delivered",
        "items_in_order",
        "order_seq",
        "is_first_order",
        F.when(F.col("is_first_order"), "New").otherwise("Returning").alias("customer_type"),
        "price",
        "freight_value",
        "item_total",
        "allocated_payment",
        F.col("review_score_oa").alias("order_review_score"),
        F.col("review_band_oa").alias("order_review_band"),
    )


_ORDER_CALENDAR = [
    name
    for name in _CALENDAR
    if name not in ("purchase_month_number", "purchase_day_of_week")
]


def bi_orders(mart: Mart) -> DataFrame:
    """One row per order: the place to measure reviews and delivery."""
    flat = _with_person(_with_calendar(mart.fact_orders, mart), mart, "order_id")
    flat = _with_payment(_with_places(flat, mart), mart)
    return flat.select(
        "order_id",
        "customer_unique_id",
        "purchase_date",
        "delivered_date",
        *_ORDER_CALENDAR,
        "customer_city",
        "customer_state",
        F.col("_person_state").alias("customer_state_code"),
        "customer_region",
        "customer_latitude",
        "customer_longitude",
        "cohort_month",
        "cohort_month_label",
        "order_status",
        "is_valid_sale",
        "is_delivered",
        "is_cancelled",
        "order_seq",
        "is_first_order",
        "customer_type",
        "items_in_order",
        "distinct_products",
        "distinct_sellers",
        "order_revenue",
        "order_freight",
        "order_total",
        "payment_method",
        "installments",
        "payment_total",
        "payment_gap",
        "review_score",
        "review_band",
        "has_comment",
        "delivery_days",
        "promised_days",
        "days_vs_promise",
        "is_late",
        bands.delivery_speed_band(F.col("delivery_days")).alias("delivery_speed_band"),
    )


def bi_customer(mart: Mart) -> DataFrame:
    """One row per person; people without a valid order keep NULL scores."""
    person = mart.mv_dim_customer.drop("cohort_month_key", "customer_zip_prefix")
    scores = mart.mv_rfm.select(
        "customer_unique_id",
        "recency_days",
        "frequency",
        "monetary",
        "r_score",
        "f_score",
        "m_score",
        "fm_score",
        "rfm_cell",
        "rfm_segment",
        "segment_rank",
        "recommended_action",
    )
    value = mart.mv_customer_ltv.select(
        "customer_unique_id",
        "total_orders",
        "total_items",
        "product_revenue",
        "freight_paid",
        "lifetime_value",
        "avg_order_value",
        "avg_review_score",
        "lifespan_days",
        "late_deliveries",
        "revenue_rank",
        "ltv_decile",
        "ltv_tier",
        "ltv_band",
        "cumulative_revenue_pct",
        "customer_percentile",
    )
    flat = person.join(scores, "customer_unique_id", "left").join(value, "customer_unique_id", "left")
    return _with_places(flat, mart)

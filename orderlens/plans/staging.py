"""Cleaning and conformance: raw tables to staged tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions import bands
from orderlens.functions.casts import safe_decimal, safe_int
from orderlens.functions.dates import hours_between
from orderlens.functions.exact import row_ratio
from orderlens.functions.text import clean_place, title_words, upper_code, zip_prefix
from orderlens.operators.keyed import first_by


def customers(raw: DataFrame) -> DataFrame:
    return raw.select(
        "customer_id",
        "customer_unique_id",
        zip_prefix(F.col("customer_zip_code_prefix")).alias("zip_code_prefix"),
        clean_place(F.col("customer_city")).alias("city"),
        upper_code(F.col("customer_state")).alias("state_code"),
    )


def orders(raw: DataFrame) -> DataFrame:
    """Milestone durations stay NULL where the milestone never happened."""
    bought, approved = F.col("order_purchase_timestamp"), F.col("order_approved_at")
    delivered = F.col("order_delivered_customer_date")
    promised = F.col("order_estimated_delivery_date")
    status = F.col("order_status")

    def days(start, end):
        return F.datediff(F.to_date(end), F.to_date(start))

    return raw.select(
        "order_id",
        "customer_id",
        "order_status",
        bought.alias("purchase_ts"),
        F.to_date(bought).alias("purchase_date"),
        approved.alias("approved_ts"),
        F.col("order_delivered_carrier_date").alias("shipped_ts"),
        delivered.alias("delivered_ts"),
        promised.alias("estimated_delivery_ts"),
        (status == "delivered").alias("is_delivered"),
        bands.is_cancelled(status).alias("is_cancelled"),
        hours_between(bought, approved).alias("approval_hours"),
        days(bought, delivered).alias("delivery_days"),
        days(bought, promised).alias("promised_days"),
        days(promised, delivered).alias("days_vs_promise"),
        (delivered > promised).alias("is_late"),
    )


def order_items(raw: DataFrame) -> DataFrame:
    price, freight = F.col("price"), F.col("freight_value")
    return raw.select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "shipping_limit_date",
        "price",
        "freight_value",
        (price + freight).alias("item_total"),
        F.when(price > 0, row_ratio(freight, price, 4)).alias("freight_ratio"),
    )


def order_payments(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("payment_type") != "not_defined").select(
        "order_id",
        "payment_sequential",
        "payment_type",
        "payment_installments",
        "payment_value",
    )


def order_payment_summary(payments: DataFrame, legacy_fanout: bool = False) -> DataFrame:
    """One row per order; the primary line carries the most money, then comes first.

    legacy_fanout repeats every line once per line of its order, which multiplies
    the total by the number of lines and squares the line count. Only for
    comparing with figures published that way.
    """
    line = F.struct("payment_type", "payment_installments")
    largest_first = F.struct("payment_value", -F.col("payment_sequential"))
    summary = payments.groupBy("order_id").agg(
        F.sum("payment_value").alias("payment_total"),
        F.count(F.lit(1)).alias("payment_line_count"),
        F.count_distinct("payment_type").alias("payment_method_count"),
        F.max("payment_installments").alias("max_installments"),
        F.max_by(line, largest_first).alias("_primary"),
    )
    lines = F.col("payment_line_count")
    total, count = F.col("payment_total"), lines
    if legacy_fanout:
        total, count = (total * lines).cast("decimal(22,2)"), lines * lines
    return summary.select(
        "order_id",
        total.alias("payment_total"),
        count.alias("payment_line_count"),
        "payment_method_count",
        "max_installments",
        F.col("_primary.payment_type").alias("primary_payment_type"),
        F.col("_primary.payment_installments").alias("primary_installments"),
    )


def order_reviews(raw: DataFrame) -> DataFrame:
    """The latest review per order."""
    latest = first_by(
        raw,
        ["order_id"],
        [F.col("review_creation_date").desc_nulls_last(), F.col("review_id").asc_nulls_last()],
    )
    answered, created = F.col("review_answer_timestamp"), F.col("review_creation_date")
    return latest.select(
        "order_id",
        "review_id",
        "review_score",
        "has_comment",
        "comment_length",
        "review_creation_date",
        F.datediff(F.to_date(answered), F.to_date(created)).alias("response_days"),
        bands.review_band(F.col("review_score")).alias("review_band"),
    )


def products(landed: DataFrame, translation: DataFrame, groups: DataFrame) -> DataFrame:
    """Typed measures, and a category that falls back from English to the source key."""

    def size(name: str):
        return safe_decimal(F.col(name), 18, 4)

    base = landed.select(
        "product_id",
        F.nullif(F.trim(F.lower("product_category_name")), F.lit("")).alias("category_pt"),
        safe_int(F.col("product_name_lenght")).alias("name_length"),
        safe_int(F.col("product_description_lenght")).alias("description_length"),
        F.coalesce(safe_int(F.col("product_photos_qty")), F.lit(0)).alias("photos_qty"),
        size("product_weight_g").alias("weight_g"),
        size("product_length_cm").alias("length_cm"),
        size("product_height_cm").alias("height_cm"),
        size("product_width_cm").alias("width_cm"),
    )
    english = translation.select(
        F.lower(F.trim("product_category_name")).alias("category_pt"),
        F.col("product_category_name_english").alias("_english"),
    )
    named = base.join(english, "category_pt", "left").withColumn(
        "_known", F.coalesce("_english", "category_pt")
    )
    grouped = named.join(groups.withColumnRenamed("category_en", "_known"), "_known", "left")
    key = F.coalesce("_known", F.lit("unknown"))
    volume = F.col("length_cm") * F.col("height_cm") * F.col("width_cm")
    return grouped.select(
        "product_id",
        "category_pt",
        key.alias("category_key"),
        title_words(F.replace(key, F.lit("_"), F.lit(" "))).alias("category_en"),
        F.coalesce("category_group", F.lit("Other")).alias("category_group"),
        "name_length",
        "description_length",
        "photos_qty",
        "weight_g",
        "length_cm",
        "height_cm",
        "width_cm",
        F.round(volume, 1).alias("volume_cm3"),
    )


def sellers(landed: DataFrame) -> DataFrame:
    return landed.select(
        "seller_id",
        zip_prefix(F.col("seller_zip_code_prefix")).alias("zip_code_prefix"),
        clean_place(F.col("seller_city")).alias("city"),
        upper_code(F.col("seller_state")).alias("state_code"),
    )


def geolocation(aggregated: DataFrame) -> DataFrame:
    """Points outside the country's bounding box are dropped (limits are fixed values)."""
    inside = F.col("lat").between(-34.0, 5.5) & F.col("lng").between(-74.0, -34.0)
    return aggregated.filter(inside).select(
        zip_prefix(F.col("zip_code_prefix")).alias("zip_code_prefix"),
        "lat",
        "lng",
        clean_place(F.col("city")).alias("city"),
        upper_code(F.col("state")).alias("state_code"),
        "sample_count",
    )

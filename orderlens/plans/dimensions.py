"""Star-schema dimensions."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.functions import bands
from orderlens.functions.dates import date_key, month_key, month_label, month_start
from orderlens.operators.small import one_per


def dim_date(spark: SparkSession, purchases: DataFrame, ts: str) -> DataFrame:
    """One row per day over whole years around the purchases; fixed years without any."""
    span = purchases.agg(F.to_date(F.min(ts)).alias("lo"), F.to_date(F.max(ts)).alias("hi"))
    first = F.coalesce(F.trunc("lo", "year"), F.lit(datetime.date(2016, 1, 1)))
    last = F.coalesce(
        F.date_sub(F.add_months(F.trunc("hi", "year"), 12), 1), F.lit(datetime.date(2018, 12, 31))
    )
    days = span.select(F.explode(F.sequence(first, last)).alias("date"))
    day = F.col("date")
    year, quarter, weekday = F.year(day), F.quarter(day), F.weekday(day) + F.lit(1)
    iso_year = F.extract(F.lit("YEAROFWEEK"), day)
    iso_week = F.weekofyear(day)
    return days.select(
        date_key(day).alias("date_key"),
        "date",
        year.alias("year"),
        quarter.alias("quarter"),
        F.concat(F.lit("Q"), quarter).alias("quarter_name"),
        F.concat(year, F.lit(" Q"), quarter).alias("year_quarter"),
        F.month(day).alias("month_number"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "MMM").alias("month_short"),
        month_key(day).alias("year_month"),
        month_label(day).alias("year_month_label"),
        month_start(day).alias("month_start"),
        F.last_day(day).alias("month_end"),
        iso_week.alias("iso_week"),
        F.concat(iso_year, F.lit("-W"), F.lpad(iso_week.cast("string"), 2, "0")).alias("iso_year_week"),
        F.trunc(day, "week").alias("week_start"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofyear(day).alias("day_of_year"),
        weekday.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "E").alias("day_short"),
        (weekday >= 6).alias("is_weekend"),
        (day == F.last_day(day)).alias("is_month_end"),
        (day == F.trunc(day, "year")).alias("is_year_start"),
        F.add_months(day, -12).alias("date_ly"),
    )


def dim_customer(customer_orders: DataFrame, states: DataFrame) -> DataFrame:
    """One row per person: attributes of the latest order, dates and counts of valid ones.

    Both come from one grouping, so orders are shuffled once and combined before.
    """
    valid = bands.is_valid_sale(F.col("order_status"))
    place = F.struct("city", "state_code", "zip_code_prefix")
    people = customer_orders.groupBy("customer_unique_id").agg(
        F.max_by(place, F.struct("purchase_date", "order_id")).alias("_place"),
        F.min(F.when(valid, F.col("purchase_date"))).alias("first_order_date"),
        F.max(F.when(valid, F.col("purchase_date"))).alias("last_order_date"),
        F.count_if(valid).alias("lifetime_orders"),
    )
    first = F.col("first_order_date")
    return (
        people.withColumn("state_code", F.col("_place.state_code"))
        .join(one_per(states, ["state_code"]), "state_code", "left")
        .select(
            "customer_unique_id",
            F.col("_place.city").alias("customer_city"),
            F.col("state_code").alias("customer_state_code"),
            F.col("state_name").alias("customer_state"),
            F.col("region").alias("customer_region"),
            F.col("_place.zip_code_prefix").alias("customer_zip_prefix"),
            "first_order_date",
            "last_order_date",
            month_start(first).alias("cohort_month"),
            month_label(first).alias("cohort_month_label"),
            month_key(first).alias("cohort_month_key"),
            "lifetime_orders",
            (F.col("lifetime_orders") > 1).alias("is_repeat_customer"),
        )
    )


def dim_product(products: DataFrame) -> DataFrame:
    return products.select(
        "product_id",
        "category_key",
        F.col("category_en").alias("category"),
        "category_group",
        F.col("category_pt").alias("category_portuguese"),
        "photos_qty",
        "name_length",
        "description_length",
        "weight_g",
        F.round(F.col("weight_g") * F.lit(0.001).cast("decimal(4,3)"), 3).alias("weight_kg"),
        "length_cm",
        "height_cm",
        "width_cm",
        "volume_cm3",
        bands.weight_band(F.col("weight_g")).alias("weight_band"),
        bands.photo_band(F.col("photos_qty")).alias("photo_band"),
    )


def dim_seller(sellers: DataFrame, states: DataFrame) -> DataFrame:
    return sellers.join(states, "state_code", "left").select(
        "seller_id",
        F.col("city").alias("seller_city"),
        F.col("state_code").alias("seller_state_code"),
        F.col("state_name").alias("seller_state"),
        F.col("region").alias("seller_region"),
    )


def dim_geo(states: DataFrame, geolocation: DataFrame, country: str) -> DataFrame:
    """One row per state with the sample-weighted centre of its zip prefixes."""
    weight = F.col("sample_count")

    def centre(axis: str):
        # Millionths as integers keep the rounding exact.
        micro = F.sum((F.col(axis) * F.lit(1_000_000)).cast("decimal(20,0)") * weight.cast("decimal(10,0)"))
        den = F.sum(weight).cast("decimal(20,0)")
        size = F.call_function("div", F.abs(micro) * F.lit(2) + den, den * F.lit(2))
        signed = F.when(micro < 0, -size).otherwise(size).cast("decimal(12,0)")
        return F.when(den != 0, (signed * F.lit("0.000001").cast("decimal(6,6)")).cast("decimal(12,6)"))

    centres = geolocation.groupBy("state_code").agg(
        centre("lat").alias("latitude"), centre("lng").alias("longitude")
    )
    return states.join(centres, "state_code", "left").select(
        "state_code",
        "state_name",
        "region",
        F.concat("state_name", F.lit(f", {country}")).alias("map_location"),
        F.lit(country).alias("country"),
        "latitude",
        "longitude",
    )


def analysis_date(fact_orders: DataFrame) -> DataFrame:
    """"Today" is the last valid purchase date in the data, never the clock."""
    last, first = F.max("purchase_date"), F.min("purchase_date")
    return fact_orders.filter("is_valid_sale").agg(
        last.alias("as_of_date"),
        first.alias("data_start_date"),
        month_start(last).alias("as_of_month"),
    )

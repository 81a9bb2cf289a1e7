"""The analyst's ad-hoc reports. Numbers stay numbers; formatting is the reader's."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.functions import bands
from orderlens.functions.exact import exact_ratio, pct, rounded_mean
from orderlens.operators.ordering import exact_percentile
from orderlens.operators.series import one_value
from orderlens.plans.mart import Mart


def _share(column: str, digits: int) -> Column:
    """Percentage of the column's total over rows that are already few: states, types, segments."""
    return pct(F.col(column), F.sum(column).over(Window.partitionBy()), digits)


def headline_kpis(mart: Mart) -> DataFrame:
    """The order fact is unique on order_id, so its valid rows are the distinct orders."""
    return (
        mart.fact_orders.filter("is_valid_sale")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.count_distinct("customer_unique_id").alias("customers"),
            F.sum("order_total").alias("revenue"),
            rounded_mean(F.col("order_total")).alias("aov"),
            F.sum("items_in_order").alias("items"),
            F.min("purchase_date").alias("first_day"),
            F.max("purchase_date").alias("last_day"),
        )
    )


def concentration(mart: Mart, tops: Sequence[int] = (1, 5, 10, 20, 50)) -> DataFrame:
    """Revenue share of the top k % of customers, all cut-offs in one pass."""
    shares = mart.concentration_curve.agg(
        *[
            F.max(F.when(F.col("customer_percentile") <= top, F.col("cumulative_revenue_pct"))).alias(f"_{top}")
            for top in tops
        ]
    )
    rows = F.array(
        *[F.struct(F.lit(top).alias("top_pct"), F.col(f"_{top}").alias("share_of_revenue")) for top in tops]
    )
    return shares.select(F.inline(rows))


def repeat_rate(mart: Mart) -> DataFrame:
    ltv = mart.mv_customer_ltv
    people, repeaters = F.count(F.lit(1)), F.count_if(F.col("total_orders") > 1)
    middle = exact_percentile(ltv, "lifetime_value", 0.5)
    cents = one_value(middle, F.round(F.col("percentile").cast("decimal(30,4)"), 2))
    return ltv.agg(
        people.alias("customers"),
        repeaters.alias("repeat_customers"),
        pct(repeaters, people, 2).alias("repeat_pct"),
        exact_ratio(F.sum("total_orders"), people, 3).alias("avg_orders_per_customer"),
        rounded_mean(F.col("lifetime_value")).alias("mean_ltv"),
    ).withColumn("median_ltv", cents)


def retention_pooled(mart: Mart, months: Sequence[int] = (1, 3, 6, 12)) -> DataFrame:
    base, active = F.sum("cohort_size"), F.sum("active_customers")
    return (
        mart.cohort.filter(F.col("month_index").isin(*months))
        .groupBy("month_index")
        .agg(
            F.count(F.lit(1)).alias("cohorts_old_enough"),
            base.alias("base_customers"),
            active.alias("still_active"),
            pct(active, base, 2).alias("retention_pct"),
        )
        .orderBy("month_index")
    )


def categories_to_80(mart: Mart) -> DataFrame:
    few, every = F.count_if("is_vital_few"), F.count(F.lit(1))
    return mart.category_pareto.agg(
        few.alias("categories_to_80pct"),
        every.alias("categories_total"),
        pct(few, every, 1).alias("pct_of_categories"),
    )


def top_categories(mart: Mart, top: int = 10) -> DataFrame:
    return (
        mart.category_pareto.select(
            "revenue_rank",
            "category",
            "category_group",
            F.col("gross_revenue").alias("revenue"),
            F.col("pct_of_total_revenue").alias("pct_of_total"),
            F.col("cumulative_pct_of_revenue").alias("cumulative_pct"),
            F.col("freight_pct_of_product_revenue").alias("freight_pct"),
        )
        .orderBy("revenue_rank")
        .limit(top)
    )


def freight_erosion(mart: Mart, fraction: float = 0.75, top: int = 10) -> DataFrame:
    """Categories with high revenue and the highest freight share."""
    pareto = mart.category_pareto
    floor = one_value(exact_percentile(pareto, "gross_revenue", fraction), F.col("percentile"))
    return (
        pareto.filter(F.col("gross_revenue").cast("double") > floor)
        .select(
            "category",
            "category_group",
            F.col("gross_revenue").alias("revenue"),
            F.col("freight_pct_of_product_revenue").alias("freight_pct_of_revenue"),
            "items_sold",
        )
        .orderBy(F.col("freight_pct_of_revenue").desc_nulls_first(), "category")
        .limit(top)
    )


def _reviewed_deliveries(mart: Mart) -> DataFrame:
    return mart.fact_orders.filter("is_valid_sale and is_delivered and review_score is not null")


def late_vs_review(mart: Mart) -> DataFrame:
    late = F.when(F.col("is_late").isNull(), "Unknown").when(F.col("is_late"), "Late")
    orders = F.count(F.lit(1))
    return (
        _reviewed_deliveries(mart)
        .groupBy(late.otherwise("On time").alias("delivery"))
        .agg(
            orders.alias("orders"),
            rounded_mean(F.col("review_score")).alias("avg_review"),
            pct(F.count_if(F.col("review_score") <= 2), orders, 1).alias("detractor_pct"),
            rounded_mean(F.col("order_total")).alias("aov"),
        )
        .orderBy("delivery")
    )


def speed_bands(mart: Mart) -> DataFrame:
    return (
        _reviewed_deliveries(mart)
        .groupBy(bands.speed_band(F.col("delivery_days")).alias("speed_band"))
        .agg(
            F.count(F.lit(1)).alias("orders"),
            rounded_mean(F.col("review_score")).alias("avg_review"),
            rounded_mean(F.col("order_total")).alias("aov"),
        )
        .orderBy("speed_band")
    )


def geo_share(mart: Mart, top: int = 12) -> DataFrame:
    """Orders with the names of their states, summed per state; the list of states is small."""
    orders = mart.fact_orders.filter("is_valid_sale")
    places = mart.places.select(
        F.col("state_code").alias("customer_state_code"), "state_name", "region"
    )
    by_state = (
        orders.join(places, "customer_state_code")
        .groupBy("state_name", "region")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum("order_total").cast("decimal(22,2)").alias("revenue"),
            rounded_mean(F.col("order_total")).alias("aov"),
            rounded_mean(F.col("delivery_days"), 1).alias("avg_delivery_days"),
            rounded_mean(F.col("review_score")).alias("avg_review"),
        )
    )
    return (
        by_state.withColumn("pct_of_revenue", _share("revenue", 2))
        .orderBy(F.col("revenue").desc(), "state_name")
        .limit(top)
    )


def payment_mix(mart: Mart) -> DataFrame:
    """Orders whose payment type has no label are left out, as in the published table."""
    by_type = (
        mart.fact_orders.filter("is_valid_sale")
        .join(mart.payment_labels, "payment_type")
        .groupBy("payment_type_label", "sort_order")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            rounded_mean(F.col("order_total")).alias("aov"),
            rounded_mean(F.col("installments")).alias("avg_installments"),
            rounded_mean(F.col("review_score")).alias("avg_review"),
        )
    )
    shared = by_type.withColumn("pct_of_orders", _share("orders", 1))
    return shared.orderBy("sort_order").drop("sort_order")


def rfm_segments(mart: Mart) -> DataFrame:
    by_segment = (
        mart.mv_rfm.groupBy("rfm_segment", "segment_rank")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.sum("monetary").cast("decimal(22,2)").alias("revenue"),
            rounded_mean(F.col("monetary")).alias("avg_value"),
            rounded_mean(F.col("recency_days"), 0).alias("avg_recency_days"),
        )
    )
    return (
        by_segment.withColumn("pct_of_customers", _share("customers", 1))
        .withColumn("pct_of_revenue", _share("revenue", 1))
        .orderBy("segment_rank")
    )


def recent_batches(health: DataFrame, top: int = 10) -> DataFrame:
    return (
        health.select(
            "batch_id",
            "status",
            "orders_attempted",
            "rows_loaded",
            "rows_rejected",
            "reject_rate_pct",
            "duration_seconds",
            "watermark_to",
        )
        .orderBy(F.col("batch_id").desc())
        .limit(top)
    )


def reject_reasons(errors: DataFrame) -> DataFrame:
    return (
        errors.groupBy("error_type", "source_table")
        .agg(F.count(F.lit(1)).alias("rows"))
        .orderBy(F.col("rows").desc(), "error_type", "source_table")
    )

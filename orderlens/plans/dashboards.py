"""The queries behind the dashboard charts, over the flat datasets.

Every function takes a mart and optional filters. The mart may be a secured one, but for the
charts over tables without a region; see `security.SecuredMart`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions import bands
from orderlens.functions.exact import mean_of, plain_ratio
from orderlens.operators.series import one_value
from orderlens.plans.metrics import FLAT_MEASURES, UNRELATED, Filters, dataset, evaluate


def _flat(mart, table: str, names: Sequence[str], by: Sequence[str], where: Filters | None) -> DataFrame:
    return evaluate(mart, names, by, where, FLAT_MEASURES[table])


def revenue_trend(mart, where: Filters | None = None) -> DataFrame:
    return _flat(mart, "bi_orders", ["total_revenue"], ["purchase_month"], where)


def revenue_by_state(mart, where: Filters | None = None) -> DataFrame:
    return _flat(mart, "bi_orders", ["total_revenue"], ["customer_state"], where)


def top_product_categories(mart, top: int = 10, where: Filters | None = None) -> DataFrame:
    rows = _flat(mart, "bi_sales", ["total_revenue"], ["product_category"], where)
    return rows.orderBy(F.col("total_revenue").desc_nulls_last(), "product_category").limit(top)


def segment_actions(mart, where: Filters | None = None) -> DataFrame:
    """Size, value and recency per RFM segment, with what to do about it."""
    return _flat(
        mart,
        "bi_customer",
        ["customers", "total_ltv", "avg_recency_days"],
        ["rfm_segment", "segment_rank", "recommended_action"],
        where,
    )


def ltv_distribution(mart, where: Filters | None = None) -> DataFrame:
    return _flat(mart, "bi_customer", ["customers"], ["ltv_band"], where)


def cohort_pivot(mart, months: Sequence[int] | None = None) -> DataFrame:
    """Cohorts as rows, months since the first order as columns, no totals.

    There is a column for every month that the calendar allows, unless `months` picks some.
    """
    if months is None:
        months = range(mart.dim_date.select("month_start").distinct().count())
    rate = plain_ratio(F.sum("active_customers"), F.sum("cohort_size"))
    wide = (
        mart.cohort.groupBy("cohort_month", "cohort_month_label")
        .pivot("month_index", list(months))
        .agg(rate)
    )
    return wide.withColumnsRenamed({str(m): f"M{m:02d}" for m in months})


def new_vs_returning(mart, where: Filters | None = None) -> DataFrame:
    return _flat(mart, "bi_orders", ["total_revenue"], ["purchase_month", "customer_type"], where)


def lorenz_curve(mart) -> DataFrame:
    """The concentration curve, one point per percent of customers."""
    return (
        mart.concentration_curve.groupBy(F.floor("customer_percentile").cast("int").alias("percentile_bin"))
        .agg(F.max("cumulative_revenue_pct").alias("cumulative_revenue_pct"))
    )


def pareto_chart(mart) -> DataFrame:
    return mart.category_pareto.select(
        "category", "category_group", "gross_revenue", "cumulative_pct_of_revenue", "revenue_rank"
    )


def revenue_vs_freight(mart) -> DataFrame:
    """Points per category with the average lines of both axes."""
    rows = mart.category_pareto.select(
        "category",
        "category_group",
        "product_revenue",
        "freight_pct_of_product_revenue",
        "items_sold",
    )
    means = rows.agg(
        F.struct(
            mean_of(F.col("product_revenue")).alias("revenue"),
            mean_of(F.col("freight_pct_of_product_revenue")).alias("freight"),
        ).alias("m")
    )
    lines = one_value(means, F.col("m"))
    return rows.withColumns(
        {
            "avg_product_revenue": lines.getField("revenue"),
            "avg_freight_pct": lines.getField("freight"),
        }
    )


def review_by_speed(mart, where: Filters | None = None) -> DataFrame:
    return (where or Filters()).apply(_orders_for(mart, where), UNRELATED["orders"]).groupBy(
        bands.delivery_speed_band(F.col("delivery_days")).alias("delivery_speed_band")
    ).agg(
        mean_of(F.col("review_score"), F.col("is_valid_sale")).alias("avg_review_score"),
        mean_of(F.col("order_total"), F.col("is_valid_sale")).alias("avg_order_value"),
    )


def _orders_for(mart, where: Filters | None) -> DataFrame:
    return dataset(mart, "orders", (where or Filters()).columns() - UNRELATED["orders"])


def revenue_by_review_band(mart, where: Filters | None = None) -> DataFrame:
    return _flat(mart, "bi_orders", ["total_revenue", "total_orders"], ["review_band"], where)


def late_vs_on_time(mart, where: Filters | None = None) -> DataFrame:
    return _flat(
        mart,
        "bi_orders",
        ["total_orders", "avg_review_score", "detractor_pct", "avg_order_value"],
        ["is_late"],
        where,
    )


def category_detail(mart, where: Filters | None = None) -> DataFrame:
    return _flat(
        mart,
        "bi_sales",
        ["total_revenue", "freight_pct_of_revenue", "total_items"],
        ["product_category"],
        where,
    )


def product_drilldown(mart, where: Filters | None = None) -> DataFrame:
    """Products by weight and photo band, for the categories the filters leave."""
    return _flat(
        mart,
        "bi_sales",
        ["total_revenue", "freight_pct_of_revenue", "total_items"],
        ["product_category_group", "product_weight_band", "product_photo_band"],
        where,
    )


def filtered_by(fact: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Fact rows whose key is among the filtered rows of a conformed dimension."""
    return fact.join(dimension.select(key), key, "left_semi")


def segment_sales(mart, segment: str) -> DataFrame:
    """Item revenue per month of one RFM segment: the segment filters people, people filter sales."""
    people = mart.mv_rfm.filter(F.col("rfm_segment") == segment)
    sales = filtered_by(mart.fact_sales.filter("is_valid_sale"), people, "customer_unique_id")
    return sales.groupBy(F.trunc("purchase_date", "month").alias("purchase_month")).agg(
        F.sum("item_total").alias("total_revenue")
    )

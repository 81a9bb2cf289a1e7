"""Customer and product analytics. "Valid" orders only; the key is the person."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderlens.functions import bands
from orderlens.functions.dates import month_key, month_label, month_number, month_start
from orderlens.functions.exact import exact_ratio, pct, with_count_pct, with_exact_ratio
from orderlens.operators.cuts import ntiles
from orderlens.operators.ordering import global_order, ntile_of
from orderlens.operators.series import densify, one_value


def person_totals(fact_orders: DataFrame) -> DataFrame:
    """One row per person with everything RFM and lifetime value need: one grouping."""
    sums = (
        fact_orders.filter("is_valid_sale")
        .groupBy("customer_unique_id")
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            F.sum("items_in_order").alias("total_items"),
            F.sum("order_revenue").cast("decimal(22,2)").alias("product_revenue"),
            F.sum("order_freight").cast("decimal(22,2)").alias("freight_paid"),
            F.sum("order_total").cast("decimal(22,2)").alias("lifetime_value"),
            F.sum("order_total").alias("_spent"),
            F.count("order_total").alias("_bought"),
            F.min("purchase_date").alias("first_order_date"),
            F.max("purchase_date").alias("last_order_date"),
            F.sum("review_score").alias("_score"),
            F.count("review_score").alias("_scored"),
            F.count_if("is_late").alias("late_deliveries"),
        )
    )
    means = with_exact_ratio(sums, "avg_order_value", F.col("_spent"), F.col("_bought"), 2)
    means = with_exact_ratio(means, "avg_review_score", F.col("_score"), F.col("_scored"), 2)
    return means.select(
        "customer_unique_id",
        "total_orders",
        "total_items",
        "product_revenue",
        "freight_paid",
        "lifetime_value",
        "avg_order_value",
        "first_order_date",
        "last_order_date",
        "avg_review_score",
        "late_deliveries",
    )


def person_values(fact_orders: DataFrame) -> DataFrame:
    """What scores and ranks a person, which needs nothing of an order but its date and total."""
    return (
        fact_orders.filter("is_valid_sale")
        .groupBy("customer_unique_id")
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            F.sum("order_total").cast("decimal(22,2)").alias("lifetime_value"),
            F.max("purchase_date").alias("last_order_date"),
        )
    )


#: What the RFM table says of a person without scoring it.
_SAID_ONLY = ("first_order_date", "avg_order_value", "avg_review_score")


def rfm(totals: DataFrame) -> DataFrame:
    """Recency and money are quintiles; frequency is banded, as most people order once.

    `totals` is read several times, so it must be written. It may be `person_values`, without
    the columns that no score needs; the result then lacks them too.

    Ties are broken by person, so the quintiles are the same on every run. They are told by
    their cut points, so people are neither ordered nor moved. "Today" is the last valid
    purchase, which is the latest of the people's last ones.
    """
    today = one_value(totals.agg(F.max("last_order_date").alias("d")), F.col("d"))
    said = [c for c in _SAID_ONLY if c in totals.columns]
    base = totals.select(
        "customer_unique_id",
        "last_order_date",
        F.datediff(today, "last_order_date").alias("recency_days"),
        F.col("total_orders").alias("frequency"),
        F.col("lifetime_value").alias("monetary"),
        *said,
        bands.frequency_score(F.col("total_orders")).alias("f_score"),
    )
    orders = {"r_score": F.unix_date("last_order_date"), "m_score": F.col("monetary") * 100}
    scored = ntiles(base, orders, "customer_unique_id", 5)
    # Half up: 2.5 becomes 3.
    value = F.call_function("div", F.col("f_score") + F.col("m_score") + F.lit(1), F.lit(2)).cast("int")
    ranked = scored.withColumn("fm_score", value).withColumn(
        "segment_rank", bands.segment_rank(F.col("r_score"), F.col("fm_score"))
    )
    names = (
        "customer_unique_id",
        "first_order_date",
        "last_order_date",
        "recency_days",
        "frequency",
        "monetary",
        "avg_order_value",
        "avg_review_score",
    )
    return ranked.select(
        *[c for c in names if c in ranked.columns],
        "r_score",
        "f_score",
        "m_score",
        "fm_score",
        F.concat("r_score", "f_score", "m_score").alias("rfm_cell"),
        bands.segment_name(F.col("segment_rank")).alias("rfm_segment"),
        "segment_rank",
        bands.segment_action(F.col("segment_rank")).alias("recommended_action"),
    )


def ranked_by_value(totals: DataFrame) -> DataFrame:
    """People with their place on the concentration curve."""
    ranked = global_order(
        totals,
        [F.col("lifetime_value").desc_nulls_first(), F.col("customer_unique_id").asc()],
        position="revenue_rank",
        running={"_running": "lifetime_value"},
        totals={"_revenue": "lifetime_value"},
        row_count="_people",
    )
    running = F.col("_running") * F.lit(100)
    ranked = with_exact_ratio(ranked, "cumulative_revenue_pct", running, F.col("_revenue"), 4)
    return with_count_pct(ranked, "customer_percentile", F.col("revenue_rank"), F.col("_people"), 4)


def customer_ltv(totals: DataFrame) -> DataFrame:
    """Observed lifetime value with the person's place on the concentration curve."""
    ranked = ranked_by_value(totals)
    ranked = ranked.withColumn("ltv_decile", ntile_of(F.col("revenue_rank"), F.col("_people"), 10))
    return ranked.select(
        "customer_unique_id",
        "total_orders",
        "total_items",
        "product_revenue",
        "freight_paid",
        "lifetime_value",
        "avg_order_value",
        "first_order_date",
        "last_order_date",
        F.datediff("last_order_date", "first_order_date").alias("lifespan_days"),
        "avg_review_score",
        "late_deliveries",
        "revenue_rank",
        "ltv_decile",
        "cumulative_revenue_pct",
        "customer_percentile",
        bands.ltv_tier(F.col("ltv_decile")).alias("ltv_tier"),
        bands.ltv_band(F.col("lifetime_value")).alias("ltv_band"),
    )


def cohort(fact_orders: DataFrame, dense: bool = False) -> DataFrame:
    """Monthly retention triangle, one row per cohort month and month index.

    Activity is one row per person and month, so finding a person's first month
    is a window over a few rows, and counting rows counts people. Cells without
    activity are left out; dense=True adds them with zeros up to the last month with
    a sale, so no cell lies after the analysis date.
    """
    month = month_start(F.col("purchase_date"))
    activity = (
        fact_orders.filter("is_valid_sale")
        .groupBy("customer_unique_id", month.alias("activity_month"))
        .agg(F.sum("order_total").alias("_spent"))
    )
    first = F.min("activity_month").over(Window.partitionBy("customer_unique_id"))
    placed = activity.withColumn("cohort_month", first)
    cells = placed.groupBy("cohort_month", "activity_month").agg(
        F.count(F.lit(1)).alias("active_customers"), F.sum("_spent").alias("cohort_revenue")
    )
    if dense:
        months = cells.select("activity_month").union(cells.select("cohort_month")).distinct()
        span = months.select(
            F.sequence(
                F.min("activity_month"), F.max("activity_month"), F.expr("interval 1 month")
            ).alias("_m")
        )
        calendar = span.select(F.explode("_m").alias("activity_month"))
        cells = (
            densify(cells, calendar, "activity_month", ["cohort_month"])
            .filter("activity_month >= cohort_month")
            .fillna(0, ["active_customers"])
            .withColumn("cohort_revenue", F.coalesce("cohort_revenue", F.lit(0).cast("decimal(22,2)")))
        )
    index = month_number(F.col("activity_month")) - month_number(F.col("cohort_month"))
    by_cohort = Window.partitionBy("cohort_month")  # at most one row per calendar month
    founded = F.max(F.when(index == 0, F.col("active_customers"))).over(by_cohort)
    revenue = F.col("cohort_revenue")
    return (
        cells.withColumn("cohort_size", founded)
        .select(
            "cohort_month",
            month_label(F.col("cohort_month")).alias("cohort_month_label"),
            month_key(F.col("cohort_month")).alias("cohort_month_key"),
            index.alias("month_index"),
            F.format_string("M%02d", index).alias("month_index_label"),
            "activity_month",
            "cohort_size",
            "active_customers",
            pct(F.col("active_customers"), F.col("cohort_size"), 2).alias("retention_pct"),
            revenue.cast("decimal(22,2)").alias("cohort_revenue"),
            exact_ratio(revenue, F.col("cohort_size"), 2).alias("revenue_per_cohort_customer"),
        )
    )


def category_totals(fact_sales: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Sums per product first, so that few rows meet the product table.

    The distinct order count needs the category on every item; items repeat an
    order within a category rarely, so they are counted as (category, order) pairs.
    """
    named = dim_product.select("product_id", "category", "category_group")
    valid = fact_sales.filter("is_valid_sale")
    return (
        valid.join(named, "product_id")
        .groupBy("category", "category_group")
        .agg(
            F.sum("price").cast("decimal(22,2)").alias("product_revenue"),
            F.sum("freight_value").cast("decimal(22,2)").alias("freight_cost"),
            F.sum("item_total").cast("decimal(22,2)").alias("gross_revenue"),
            F.count(F.lit(1)).alias("items_sold"),
            F.count_distinct("order_id").alias("orders"),
        )
    )


def category_pareto(totals: DataFrame) -> DataFrame:
    ranked = global_order(
        totals,
        [F.col("gross_revenue").desc_nulls_first(), F.col("category").asc(), F.col("category_group").asc()],
        position="revenue_rank",
        running={"_running": "gross_revenue"},
        totals={"_all": "gross_revenue"},
    )
    cumulative = pct(F.col("_running"), F.col("_all"), 3)
    return ranked.select(
        "category",
        "category_group",
        "revenue_rank",
        "items_sold",
        "orders",
        "product_revenue",
        "freight_cost",
        "gross_revenue",
        pct(F.col("freight_cost"), F.col("product_revenue"), 2).alias("freight_pct_of_product_revenue"),
        pct(F.col("gross_revenue"), F.col("_all"), 3).alias("pct_of_total_revenue"),
        cumulative.alias("cumulative_pct_of_revenue"),
        (cumulative <= 80).alias("is_vital_few"),
    )

"""Thirteen assertions over the model, evaluated together."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from orderlens.functions.exact import pct
from orderlens.operators.keyed import absent_from, union_all, up_to_cursor
from orderlens.operators.series import one_value
from orderlens.plans.mart import Mart
from orderlens.session import cut_lineage

PAYMENT_GAP_TOLERANCE = 1

# name, severity, threshold, detail (fixed values)
CHECKS = (
    ("orphan_items_no_product", "error", 0.0, "order items whose product_id is missing from dim_product"),
    ("orphan_orders_no_customer", "error", 0.0, "orders whose customer_id is missing from raw.customers"),
    ("negative_amounts", "error", 0.0, "order items with negative price or freight"),
    (
        "fact_revenue_reconciliation",
        "error",
        0.05,
        "absolute difference between fact_sales and fact_orders revenue",
    ),
    ("fact_sales_grain_unique", "error", 0.0, "duplicate order_item_key values in fact_sales"),
    ("dates_outside_dim_date", "error", 0.0, "orders whose purchase_date falls outside dim_date"),
    ("review_score_out_of_range", "error", 0.0, "reviews outside the 1-5 scale"),
    ("batch_reject_rate_pct", "warn", 1.0, "share of rows rejected by the latest drip batch"),
    (
        "orders_with_payment_gap_pct",
        "warn",
        5.0,
        "share of orders where payments differ from item totals by more than R$1",
    ),
    ("unknown_category_pct", "warn", 3.0, "share of products that fell through the category translation"),
    (
        "customer_grain_collapsed",
        "error",
        0.0,
        "1 means customer_unique_id is not deduplicating -- retention metrics invalid",
    ),
    (
        "orders_skipped_silently",
        "error",
        0.0,
        "orders the watermark has passed that are in neither raw.orders nor ops.load_errors",
    ),
    ("ingest_completeness_pct", "info", 100.0, "raw.orders as a share of seed.orders"),
)


class DataQualityError(RuntimeError):
    """An error-severity check failed."""


@dataclass(frozen=True)
class IngestState:
    """What the ingest checks look at; without it they observe nothing and pass.

    `feed` is the landed orders with `purchase_ts`; the cursor is None before the
    first batch.
    """

    feed: DataFrame
    load_batch: DataFrame
    load_errors: DataFrame
    last_ts: object = None
    last_id: str | None = None
    source_name: str = "orders_feed"


def _observed(df: DataFrame, *named: tuple[str, Column]) -> DataFrame:
    """One aggregate over `df`, turned into (check_name, observed) rows."""
    values = df.agg(*[value.cast("double").alias(name) for name, value in named])
    rows = F.array(
        *[F.struct(F.lit(n).alias("check_name"), F.col(n).alias("observed")) for n, _ in named]
    )
    return values.select(F.inline(rows))


def _count_if(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def observations(mart: Mart, ingest: IngestState | None = None) -> DataFrame:
    orders, sales, raw = mart.fact_orders, mart.fact_sales, mart.raw
    valid = F.col("is_valid_sale")
    every = F.count(F.lit(1))
    span = mart.dim_date.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    low, high = one_value(span, F.col("lo")), one_value(span, F.col("hi"))
    item_sum = F.coalesce(F.sum(F.when(valid, F.col("item_total"))), F.lit(0).cast("decimal(22,2)"))
    order_sum = F.coalesce(F.sum(F.when(valid, F.col("order_total"))), F.lit(0).cast("decimal(22,2)"))
    gap = F.abs("payment_gap") > PAYMENT_GAP_TOLERANCE
    day = F.col("purchase_date")
    score = F.col("review_score")
    people, ids = F.count_distinct("customer_unique_id"), F.count_distinct("customer_id")
    # Each fact is computed once: two checks read its one row of sums, or the few columns they need.
    order_side = cut_lineage(
        orders.agg(
            order_sum.alias("total"),
            _count_if((day < low) | (day > high)).alias("outside"),
            pct(F.count_if(valid & gap), F.count_if(valid), 2).alias("gap_pct"),
        )
    )
    sales = cut_lineage(sales.select("order_item_key", "product_id", "is_valid_sale", "item_total"))
    item_keys = sales.groupBy("order_item_key").agg(
        every.alias("copies"),
        F.sum(F.when(valid, F.col("item_total"))).alias("item_total"),
        F.lit(True).alias("is_valid_sale"),
    )
    parts = [
        _observed(
            absent_from(sales.select("product_id"), mart.dim_product, ["product_id"]),
            ("orphan_items_no_product", every),
        ),
        _observed(
            absent_from(raw.orders.select("customer_id"), raw.customers, ["customer_id"]),
            ("orphan_orders_no_customer", every),
        ),
        _observed(
            raw.order_items,
            ("negative_amounts", _count_if((F.col("price") < 0) | (F.col("freight_value") < 0))),
        ),
        _observed(
            item_keys,
            ("fact_sales_grain_unique", F.count_if(F.col("copies") > 1)),
            ("fact_revenue_reconciliation", F.round(F.abs(item_sum - one_value(order_side, F.col("total"))), 2)),
        ),
        _observed(
            order_side,
            ("dates_outside_dim_date", F.max("outside")),
            ("orders_with_payment_gap_pct", F.max("gap_pct")),
        ),
        _observed(raw.order_reviews, ("review_score_out_of_range", _count_if(~score.between(1, 5)))),
        _observed(
            mart.dim_product,
            ("unknown_category_pct", pct(F.count_if(F.col("category_key") == "unknown"), every, 2)),
        ),
        _observed(raw.customers, ("customer_grain_collapsed", F.when(people >= ids, 1).otherwise(0))),
    ]
    if ingest is not None:
        parts += _ingest_observations(mart, ingest)
    return union_all(parts)


def _ingest_observations(mart: Mart, ingest: IngestState) -> list[DataFrame]:
    every = F.count(F.lit(1))
    rate = pct(F.col("rows_rejected"), F.col("rows_loaded") + F.col("rows_rejected"), 2)
    moved = ingest.load_batch.filter("orders_attempted > 0").filter(
        F.col("source_name") == ingest.source_name
    )
    passed = up_to_cursor(F.col("purchase_ts"), F.col("order_id"), ingest.last_ts, ingest.last_id)
    skipped = ingest.feed.filter(passed).select("order_id")
    skipped = absent_from(skipped, mart.raw.orders, ["order_id"])
    logged = ingest.load_errors.filter("source_table = 'seed.orders'")
    logged = logged.select(F.col("record_key").alias("order_id"))
    loaded = one_value(mart.raw.orders.agg(every.alias("n")), F.col("n"))
    return [
        _observed(moved, ("batch_reject_rate_pct", F.max_by(rate, "batch_id"))),
        _observed(absent_from(skipped, logged, ["order_id"]), ("orders_skipped_silently", every)),
        _observed(ingest.feed, ("ingest_completeness_pct", pct(loaded, every, 2))),
    ]


def dq_checks(mart: Mart, ingest: IngestState | None = None) -> DataFrame:
    """One row per check. Nothing observed, or an info check, counts as passed."""
    spark = mart.spark
    rules = spark.createDataFrame(
        list(CHECKS), "check_name string, severity string, threshold double, detail string"
    )
    seen = observations(mart, ingest)
    failed = (F.col("severity") != "info") & (F.col("observed") > F.col("threshold"))
    return rules.join(F.broadcast(seen), "check_name", "left").select(
        "check_name",
        "severity",
        F.when(F.coalesce(failed, F.lit(False)), "fail").otherwise("pass").alias("status"),
        "observed",
        "threshold",
        "detail",
    )


def failed_errors(results: list[Row]) -> list[str]:
    return [r.check_name for r in results if r.severity == "error" and r.status == "fail"]

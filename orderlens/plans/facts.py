"""Facts at two grains: order items and orders.

Order attributes are assembled once, at order grain. The item fact is that table
joined to the items; the order fact is a projection of it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderlens.functions import bands
from orderlens.functions.dates import date_key
from orderlens.functions.exact import with_exact_share
from orderlens.operators.skew import lookup_join, sequence_within
from orderlens.operators.small import one_per


def customer_orders(orders: DataFrame, customers: DataFrame) -> DataFrame:
    return orders.join(customers, "customer_id")


def order_sequence(with_customer: DataFrame, hot_people: Sequence = ()) -> DataFrame:
    """The nth order of a person, over all orders, cancelled ones included."""
    return sequence_within(
        with_customer,
        "customer_unique_id",
        [F.col("purchase_ts").asc_nulls_last(), F.col("order_id").asc()],
        "order_seq",
        hot_people,
    )


def item_rollup(items: DataFrame) -> DataFrame:
    """One row per order.

    Two distinct counts in one grouping would triple the rows. Instead the first
    row of every product and of every seller in an order is flagged; on co-located
    items that takes sorts but no shuffle.
    """
    baskets = items.groupBy("order_id", "product_id", "seller_id").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum("price").alias("_price"),
        F.sum("freight_value").alias("_freight"),
        F.sum("item_total").alias("_total"),
    )

    def new(column: str, other: str):
        seen = Window.partitionBy("order_id", column).orderBy(other)
        named = F.col(column).isNotNull()
        return (named & (F.row_number().over(seen) == 1)).cast("bigint")

    flagged = baskets.withColumn("_product", new("product_id", "seller_id")).withColumn(
        "_seller", new("seller_id", "product_id")
    )
    return flagged.groupBy("order_id").agg(
        F.sum("_n").alias("items_in_order"),
        F.sum("_product").alias("distinct_products"),
        F.sum("_seller").alias("distinct_sellers"),
        F.sum("_price").cast("decimal(22,2)").alias("order_revenue"),
        F.sum("_freight").cast("decimal(22,2)").alias("order_freight"),
        F.sum("_total").cast("decimal(22,2)").alias("order_total"),
    )


def order_context(sequenced: DataFrame, payments: DataFrame, reviews: DataFrame) -> DataFrame:
    """What is known per order apart from its items. All inputs are unique on order_id."""
    paid = payments.select(
        "order_id",
        "payment_total",
        "payment_method_count",
        "primary_payment_type",
        "primary_installments",
    )
    reviewed = reviews.select("order_id", "review_score", "review_band", "has_comment", "comment_length")
    first = F.col("order_seq") == 1
    return (
        sequenced.join(paid, "order_id", "left")
        .join(one_per(reviewed, ["order_id"]), "order_id", "left")
        .withColumns(
            {
                "date_key": date_key(F.col("purchase_date")),
                "delivered_date": F.to_date("delivered_ts"),
                "payment_type": F.coalesce("primary_payment_type", F.lit("unknown")),
                "is_valid_sale": bands.is_valid_sale(F.col("order_status")),
                "is_first_order": first,
                "installments": F.coalesce("primary_installments", F.lit(1)),
            }
        )
        .withColumnRenamed("state_code", "customer_state_code")
    )


def fact_orders(context: DataFrame, rollup: DataFrame) -> DataFrame:
    """One row per order; orders without items get zeros."""

    def money(name: str):
        return F.coalesce(name, F.lit(0).cast("decimal(1,0)")).cast("decimal(22,2)")

    def count(name: str):
        return F.coalesce(name, F.lit(0)).alias(name)

    gap = money("payment_total") - money("order_total")
    return context.join(rollup, "order_id", "left").select(
        "order_id",
        "customer_unique_id",
        "customer_id",
        "purchase_date",
        "date_key",
        "delivered_date",
        "customer_state_code",
        "payment_type",
        "order_status",
        "is_delivered",
        "is_cancelled",
        "is_valid_sale",
        "order_seq",
        "is_first_order",
        F.when(F.col("is_first_order"), "New").otherwise("Returning").alias("customer_type"),
        count("items_in_order"),
        count("distinct_products"),
        count("distinct_sellers"),
        money("order_revenue").alias("order_revenue"),
        money("order_freight").alias("order_freight"),
        money("order_total").alias("order_total"),
        "payment_total",
        "payment_method_count",
        "installments",
        gap.cast("decimal(22,2)").alias("payment_gap"),
        "review_score",
        "review_band",
        "has_comment",
        "comment_length",
        "approval_hours",
        "delivery_days",
        "promised_days",
        "days_vs_promise",
        "is_late",
    )


_ORDER_COLUMNS = (
    "order_id",
    "customer_unique_id",
    "customer_id",
    "purchase_date",
    "date_key",
    "delivered_date",
    "customer_state_code",
    "payment_type",
    "order_status",
    "is_delivered",
    "is_valid_sale",
    "order_seq",
    "is_first_order",
    "payment_total",
    "installments",
    "review_score",
    "review_band",
)


def _with_order_totals(items: DataFrame, hot_orders: Sequence) -> DataFrame:
    """Items next to their order's total and item count.

    Without hot orders a window on the co-located items does it in place. A hot
    order is summed on the map side and joined back to its salted rows.
    """
    total = F.sum("item_total").cast("decimal(22,2)")
    if not hot_orders:
        order = Window.partitionBy("order_id")
        return items.withColumns(
            {
                "order_total": F.sum("item_total").over(order).cast("decimal(22,2)"),
                "items_in_order": F.count(F.lit(1)).over(order),
            }
        )
    sums = items.groupBy("order_id").agg(
        total.alias("order_total"), F.count(F.lit(1)).alias("items_in_order")
    )
    return lookup_join(items, sums, "order_id", "inner", hot_orders, _ITEM_SPREAD)


_ITEM_SPREAD = ("order_item_id", "product_id", "seller_id")


def fact_sales(items: DataFrame, context: DataFrame, hot_orders: Sequence = ()) -> DataFrame:
    """One row per order item, with the order's payment allocated by share of its total."""
    joined = lookup_join(
        _with_order_totals(items, hot_orders),
        context.select(*_ORDER_COLUMNS),
        "order_id",
        "inner",
        hot_orders,
        _ITEM_SPREAD,
    )
    paid = joined.withColumn("_paid", F.coalesce("payment_total", "order_total"))
    shared = with_exact_share(paid, "allocated_payment", F.col("_paid"), F.col("item_total"), F.col("order_total"))
    return shared.select(
        F.concat_ws("-", "order_id", "order_item_id").alias("order_item_key"),
        "order_id",
        "order_item_id",
        "customer_unique_id",
        "customer_id",
        "product_id",
        "seller_id",
        "purchase_date",
        "date_key",
        "delivered_date",
        "customer_state_code",
        "payment_type",
        "order_status",
        "is_delivered",
        "is_valid_sale",
        "items_in_order",
        "order_seq",
        "is_first_order",
        "price",
        "freight_value",
        "item_total",
        "freight_ratio",
        "allocated_payment",
        "installments",
        F.col("review_score").alias("review_score_oa"),
        F.col("review_band").alias("review_band_oa"),
    )

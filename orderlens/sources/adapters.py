"""Projection of the order/lineitem tables at hand into the commerce source shape.

`raw_tables` gives typed, keyed tables; `landing_tables` gives the same data as
text with faults planted by key, to exercise the reject paths on whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderlens.operators.keyed import first_by
from orderlens.plans.mart import RawTables
from orderlens.sources.landing import aggregate_geolocation, typed_feed
from orderlens.sources.lookups import payment_types

MONEY_SCALE = "cast(0.001 as decimal(4,3))"


# Declared, so that opening a table reads no file footers.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ),
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def orders(source: DataFrame) -> DataFrame:
    """Row-wise only, so it also runs on a stream."""
    key, bought = F.col("o_orderkey"), F.col("o_orderdate")

    def later(unit: str, amount: Column) -> Column:
        return F.timestamp_add(unit, amount.cast("int"), bought)

    filled = F.col("o_orderstatus") == "F"
    status = F.when(filled, "delivered").when(F.col("o_orderstatus") == "O", "shipped")
    return source.select(
        key.cast("string").alias("order_id"),
        F.concat(F.lit("c"), key).alias("customer_id"),
        status.otherwise("canceled").alias("order_status"),
        bought.alias("order_purchase_timestamp"),
        later("HOUR", key % 48).alias("order_approved_at"),
        F.when(filled, later("DAY", F.lit(1))).alias("order_delivered_carrier_date"),
        F.when(filled, later("DAY", key % 40)).alias("order_delivered_customer_date"),
        later("DAY", F.lit(20)).alias("order_estimated_delivery_date"),
    )


def person() -> Column:
    """Every fifth order belongs to someone with several, the others to someone with one."""
    key = F.col("o_orderkey")
    return F.when(key % 5 == 0, F.concat(F.lit("p"), "o_custkey")).otherwise(F.concat(F.lit("n"), key))


def customers(source: DataFrame, people: DataFrame) -> DataFrame:
    """One row per order."""
    key, buyer = F.col("o_orderkey"), F.col("o_custkey")
    nation = F.col("c_nationkey")
    joined = source.select("o_orderkey", "o_custkey").join(
        people.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey"
    )
    return joined.select(
        F.concat(F.lit("c"), key).alias("customer_id"),
        person().alias("customer_unique_id"),
        (nation * 4 + buyer % 4).cast("string").alias("customer_zip_code_prefix"),
        F.concat(F.lit(" SÃO  nation-"), nation, F.lit(" d'oeste ")).alias("customer_city"),
        nation.cast("string").alias("customer_state"),
    )


def unique_lines(lineitem: DataFrame) -> DataFrame:
    """(order, line number) is not unique in the source; keep the first row of each."""
    order = [
        "l_partkey",
        "l_suppkey",
        "l_extendedprice",
        "l_quantity",
        "l_discount",
        "l_tax",
        "l_returnflag",
        "l_linestatus",
        "l_shipdate",
    ]
    return first_by(
        lineitem, ["l_orderkey", "l_linenumber"], [F.col(c).asc_nulls_last() for c in order]
    )


def items(lines: DataFrame) -> DataFrame:
    gross = "cast(l_extendedprice as decimal(12,2))"
    net = f"{gross} * (1 - cast(l_discount as decimal(4,2))) * {MONEY_SCALE}"
    freight = f"{gross} * cast(l_tax as decimal(4,2)) * {MONEY_SCALE}"
    return lines.selectExpr(
        "cast(l_orderkey as string) as order_id",
        "l_linenumber as order_item_id",
        "cast(l_partkey as string) as product_id",
        "cast(l_suppkey as string) as seller_id",
        "l_shipdate as shipping_limit_date",
        f"cast({net} as decimal(12,2)) as price",
        f"cast({freight} as decimal(12,2)) as freight_value",
        "l_returnflag",
    )


def payments(order_items: DataFrame) -> DataFrame:
    kind = F.when(F.col("l_returnflag") == "R", "credit_card").when(
        F.col("l_returnflag") == "A", "boleto"
    )
    lines = order_items.groupBy("order_id", kind.otherwise("voucher").alias("payment_type")).agg(
        F.sum(F.col("price") + F.col("freight_value")).cast("decimal(12,2)").alias("payment_value"),
        F.max("order_item_id").alias("payment_installments"),
    )
    # At most three lines per order.
    number = F.row_number().over(Window.partitionBy("order_id").orderBy("payment_type"))
    return lines.withColumn("payment_sequential", number).select(
        "order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"
    )


def reviews(source: DataFrame) -> DataFrame:
    """One review per order, and a later second one for every twentieth order."""
    key = F.col("o_orderkey")
    score = F.substring("o_orderpriority", 1, 1).cast("int")
    second = F.col("nth") == 2
    created = F.timestamp_add("DAY", F.when(second, 35).otherwise(30), F.col("o_orderdate"))
    nth = F.when(key % 20 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return source.withColumn("nth", F.explode(nth)).select(
        F.concat_ws("-", F.lit("r"), key, "nth").alias("review_id"),
        key.cast("string").alias("order_id"),
        F.when(second, F.lit(6) - score).otherwise(score).alias("review_score"),
        (key % 3 == 0).alias("has_comment"),
        F.when(key % 3 == 0, key % 200 + F.lit(1)).otherwise(0).cast("int").alias("comment_length"),
        created.alias("review_creation_date"),
        F.timestamp_add("DAY", (key % 7).cast("int"), created).alias("review_answer_timestamp"),
    )


def products(part: DataFrame) -> DataFrame:
    size = F.col("p_size")
    return part.select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.when(size != 50, category_pt()).alias("product_category_name"),
        F.length("p_name").cast("string").alias("product_name_lenght"),
        (size * 3).cast("string").alias("product_description_lenght"),
        (size % 5).cast("string").alias("product_photos_qty"),
        (size * 250).cast("string").alias("product_weight_g"),
        size.cast("string").alias("product_length_cm"),
        F.when(size % 7 != 0, size % 7).cast("string").alias("product_height_cm"),
        F.concat(size % 11 + F.lit(1), F.lit(".5")).alias("product_width_cm"),
    )


def category_pt() -> Column:
    return F.lower(F.concat_ws("_", "p_type", F.replace(F.col("p_brand"), F.lit("#"), F.lit("_"))))


def category_en() -> Column:
    return F.concat(F.lit("en_"), category_pt())


def translation(part: DataFrame) -> DataFrame:
    """English names for all categories but those of one product type."""
    return part.filter("p_type <> 'SMALL'").select(
        category_pt().alias("product_category_name"),
        category_en().alias("product_category_name_english"),
    ).distinct()


def category_groups(part: DataFrame) -> DataFrame:
    return part.filter("p_type <> 'SMALL'").select(
        category_en().alias("category_en"), F.col("p_type").alias("category_group")
    ).distinct()


def sellers(supplier: DataFrame) -> DataFrame:
    nation = F.col("s_nationkey")
    return supplier.select(
        F.col("s_suppkey").cast("string").alias("seller_id"),
        (nation * 4 + F.col("s_suppkey") % 4).cast("string").alias("seller_zip_code_prefix"),
        F.concat(F.lit("SÃO nation-"), nation).alias("seller_city"),
        nation.cast("string").alias("seller_state"),
    )


def states(nation: DataFrame, region: DataFrame) -> DataFrame:
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").cast("string").alias("state_code"),
        F.col("n_name").alias("state_name"),
        F.col("r_name").alias("region"),
    )


def geolocation_samples(people: DataFrame) -> DataFrame:
    key, nation = F.col("c_custkey"), F.col("c_nationkey")

    def axis(start: int, factor: int, extra: Column) -> Column:
        steps = (key * factor % 400) * 5 + F.lit(start * 100)
        return ((steps + extra).cast("decimal(12,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("string")

    far = F.when(nation == 24, 4000).otherwise(0)
    return people.select(
        (nation * 4 + key % 4).cast("string").alias("geolocation_zip_code_prefix"),
        axis(-30, 7, far).alias("geolocation_lat"),
        axis(-70, 13, F.lit(0)).alias("geolocation_lng"),
        F.concat(F.lit("cidade "), key % 3).alias("geolocation_city"),
        F.concat(F.lit(" "), nation).alias("geolocation_state"),
    )


def raw_tables(spark: SparkSession, sf_dir: str) -> RawTables:
    """The tables, each planned when a query first asks for it."""

    def read(name: str) -> DataFrame:
        return table(spark, sf_dir, name)

    def item_keys() -> DataFrame:
        return read("lineitem").select(
            F.col("l_orderkey").cast("string").alias("order_id"),
            F.col("l_partkey").cast("string").alias("product_id"),
            F.col("l_suppkey").cast("string").alias("seller_id"),
        )

    def person_keys() -> DataFrame:
        return read("orders").select(person().alias("customer_unique_id"))

    raw = RawTables(
        spark,
        country="World",
        key_scans={"order_items": item_keys, "persons": person_keys},
        orders=lambda: orders(read("orders")),
        customers=lambda: customers(read("orders"), read("customer")),
        order_items=lambda: items(unique_lines(read("lineitem"))),
        order_payments=lambda: payments(raw.order_items),
        order_reviews=lambda: reviews(read("orders")),
        products=lambda: products(read("part")),
        sellers=lambda: sellers(read("supplier")),
        category_translation=lambda: translation(read("part")),
        geolocation=lambda: aggregate_geolocation(geolocation_samples(read("customer"))),
        states=lambda: states(read("nation"), read("region")),
        category_groups=lambda: category_groups(read("part")),
        payment_types=lambda: payment_types(spark),
    )
    return raw


def _as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def _planted(column: str, *faults: tuple[str, Column]) -> Callable[[DataFrame], DataFrame]:
    """Replace a column by the first fault whose condition holds."""

    def apply(df: DataFrame) -> DataFrame:
        value = F.col(column)
        for condition, fault in reversed(faults):
            value = F.when(F.expr(condition), fault).otherwise(value)
        return df.withColumn(column, value)

    return apply


def landing_orders(source: DataFrame) -> DataFrame:
    """The dirty order feed; row-wise only, so it also runs on a stream."""
    broken = _planted("order_purchase_timestamp", ("order_id % 109 = 0", F.lit("bad")))
    return typed_feed(broken(_as_text(orders(source))))


def landing_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    def read(name: str) -> DataFrame:
        return table(spark, sf_dir, name)

    source, part = read("orders"), read("part")
    order_items = items(unique_lines(read("lineitem")))
    number = "cast(substring(customer_id, 2) as bigint)"
    kept_customers = customers(source, read("customer")).filter(f"{number} % 113 <> 0")
    no_person = _planted("customer_unique_id", (f"{number} % 127 = 0", F.lit(None).cast("string")))
    bad_price = _planted(
        "price",
        ("order_id % 101 = 0", F.lit("abc")),
        ("order_id % 103 = 0", F.concat(F.lit("-"), "price")),
    )
    bad_product = _planted("product_id", ("order_id % 107 = 0", F.lit("none")))
    bad_score = _planted("review_score", ("order_id % 131 = 0", F.lit("9")))
    comment = F.when(F.col("has_comment"), F.repeat(F.lit("x"), F.col("comment_length")))
    written = reviews(source).select(
        "review_id",
        "order_id",
        "review_score",
        F.lit(None).cast("string").alias("review_comment_title"),
        comment.alias("review_comment_message"),
        "review_creation_date",
        "review_answer_timestamp",
    )
    return {
        "orders": landing_orders(source),
        "customers": no_person(_as_text(kept_customers)),
        "order_items": bad_product(bad_price(_as_text(order_items.drop("l_returnflag")))),
        "order_payments": _as_text(payments(order_items)),
        "order_reviews": bad_score(_as_text(written)),
        "products": products(part),
        "sellers": sellers(read("supplier")),
        "category_translation": translation(part),
    }

"""Every query of the library by name, over the tables in one folder."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.functions.casts import safe_money, safe_timestamp
from orderlens.functions.text import clean_place
from orderlens.operators.keyed import absent_from, union_all, up_to_cursor
from orderlens.operators.skew import SkewPolicy
from orderlens.plans import analytics, dashboards, insights, quality, security, staging
from orderlens.plans import time_intelligence as over_time
from orderlens.plans.mart import Mart
from orderlens.plans.metrics import (
    FLAT_MEASURES,
    Filters,
    evaluate,
    segment_share,
    share_of_selection,
)
from orderlens.session import at_once, release, shared_dir
from orderlens.sources import adapters
from orderlens.sources.file_index import LandedFiles
from orderlens.sources.landing import aggregate_geolocation, load_landing, row_counts
from orderlens.sources.schemas import LANDING, OPS
from orderlens.streaming import health, late, rules
from orderlens.streaming.ingest import Cursor, Ingest, next_window

Query = Callable[[SparkSession, str], DataFrame]

KEYSET_START = datetime.datetime(2024, 1, 10)
STREAM_SPLIT = datetime.datetime(2024, 1, 20)
STREAM_DELAY = "36 hours"
LATE_CURSOR = datetime.datetime(1998, 1, 1)


def portable(df: DataFrame) -> DataFrame:
    """Types every engine prints alike: decimals as doubles, dates as text, wide integers."""

    def column(field: T.StructField):
        value, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.DecimalType, T.FloatType)):
            value = value.cast("double")
        elif isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            value = value.cast("string")
        elif isinstance(kind, T.IntegralType):
            value = value.cast("bigint")
        return value.alias(field.name)

    return df.select(*[column(f) for f in df.schema.fields])


def open_mart(spark: SparkSession, sf_dir: str) -> Mart:
    return Mart(adapters.raw_tables(spark, sf_dir), skew=SkewPolicy())


def _of(build: Callable[[Mart], DataFrame]) -> Query:
    return lambda spark, sf_dir: portable(build(open_mart(spark, sf_dir)))


def _table(name: str) -> Query:
    return _of(lambda mart: getattr(mart, name))


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return adapters.table(spark, sf_dir, name)


# -- staging --------------------------------------------------------------------
def clean_place_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """clean_place over whole documents."""
    docs = _read(spark, sf_dir, "documents")
    cleaned = docs.select("doc_id", clean_place(F.col("text")).alias("cleaned"))
    return portable(cleaned.select("doc_id", "cleaned", F.length("cleaned").alias("n_chars")))


def safe_cast_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and sums of what parses and what does not, over the dirty feed."""
    landed = adapters.landing_tables(spark, sf_dir)
    price = safe_money(F.col("price"))
    items = landed["order_items"].agg(
        F.count(F.lit(1)).alias("items"),
        F.count_if(price.isNull()).alias("bad_prices"),
        F.count_if(price < 0).alias("negative_prices"),
        F.sum(price).alias("parsed_total"),
    )
    ts = safe_timestamp(F.col("order_purchase_timestamp"))
    orders = landed["orders"].agg(
        F.struct(F.count_if(ts.isNull()).alias("bad"), F.max(ts).alias("last")).alias("o")
    )
    seen = orders.scalar()
    return portable(
        items.withColumns({"bad_timestamps": seen.getField("bad"), "last_ts": seen.getField("last")})
    )


def landing_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = dict(adapters.landing_tables(spark, sf_dir))
    landed["geolocation"] = adapters.raw_tables(spark, sf_dir).geolocation
    return portable(row_counts(landed))


def geolocation_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = adapters.geolocation_samples(_read(spark, sf_dir, "customer"))
    return portable(aggregate_geolocation(samples))


def payments_summary_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = open_mart(spark, sf_dir)
    return portable(staging.order_payment_summary(mart.order_payments, legacy_fanout=True))


# -- ingest ---------------------------------------------------------------------
def keyset_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next 500 events after a (ts, id) cursor."""
    events = _read(spark, sf_dir, "events").select(
        F.col("ts").alias("purchase_ts"), F.col("event_id").alias("order_id"), "user_id", "event_type"
    )
    window = next_window(events, Cursor(KEYSET_START, "0"), 500)
    return portable(window)


def insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliver the events twice, the second time whole: only unseen ids are added."""
    events = _read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    held = events.filter(up_to_cursor(F.col("ts"), F.col("event_id"), KEYSET_START, "0"))
    added = absent_from(events, held, ["event_id"])
    return portable(
        added.groupBy("event_type").agg(
            F.count(F.lit(1)).alias("inserted"), F.min("event_id").alias("first_id"), F.max("ts").alias("last_ts")
        )
    )


def reject_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rule over the whole dirty feed, items of refused orders included."""
    landed = adapters.landing_tables(spark, sf_dir)
    parsed = landed["orders"].filter("purchase_ts is not null")
    unparsed = landed["orders"].filter("purchase_ts is null").withColumn("reason", F.lit("bad_timestamp"))
    checked = {
        "orders": rules.check_orders(parsed, landed["customers"]).unionByName(unparsed),
        "order_items": rules.check_items(landed["order_items"], landed["products"]),
        "order_payments": rules.check_payments(landed["order_payments"]),
        "order_reviews": rules.check_reviews(landed["order_reviews"]),
    }
    counted = [
        df.groupBy(F.coalesce("reason", F.lit("ok")).alias("verdict"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(name).alias("source_table"), "verdict", "rows")
        for name, df in checked.items()
    ]
    out = counted[0]
    for df in counted[1:]:
        out = out.unionByName(df)
    return portable(out)


def land(spark: SparkSession, sf_dir: str, folder: str, **only: str) -> dict[str, LandedFiles]:
    """Bulk load: the dirty feed written once as landing tables, which may grow.

    `only` keeps the rows of a table that meet a condition, for feeds that land in parts.
    """
    tables = adapters.landing_tables(spark, sf_dir)
    tables |= {name: tables[name].filter(condition) for name, condition in only.items()}

    def write(name: str) -> None:
        df, path = tables[name], f"{folder}/landing/{name}"
        if name == "orders":
            # By time and id, so that a month with very many orders is written by many tasks.
            ranged = df.repartitionByRange("purchase_ts", "order_id")
            ranged.write.mode("overwrite").partitionBy("purchase_month").parquet(path)
        else:
            df.write.mode("overwrite").parquet(path)

    at_once({name: partial(write, name) for name in tables})
    release(spark)
    return {name: LandedFiles(spark, f"{folder}/landing/{name}") for name in tables}


def csv_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed written as CSV files and landed from them: orders per month, and unreadable ones."""
    folder = f"{shared_dir(spark).rstrip('/')}/csv-{uuid.uuid4().hex}"
    tables = adapters.landing_tables(spark, sf_dir)
    paths = {name: f"{folder}/{name}.csv" for name in ("orders", "customers", "order_items")}
    for name, path in paths.items():
        tables[name].select(*LANDING[name].names).write.option("header", True).option("escape", '"').csv(path)
    landed = load_landing(spark, paths, f"{folder}/landing")
    orders = landed["orders"].join(landed["customers"].select("customer_id").distinct(), "customer_id", "left_semi")
    items = landed["order_items"].groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
    return portable(
        orders.join(items, "order_id", "left")
        .groupBy("purchase_month")
        .agg(F.count(F.lit(1)).alias("orders"), F.sum("n").alias("items"))
    )


def new_ingest(spark: SparkSession, sf_dir: str, indexed: bool = True, **only: str) -> Ingest:
    """An ingest over the landed feed. `indexed=False` is for loads whose batches need every file
    anyway: the jobs that make and ask the indexes are then but a load on the driver."""
    folder = f"{shared_dir(spark).rstrip('/')}/ingest-{uuid.uuid4().hex}"
    return Ingest(spark, folder, land(spark, sf_dir, folder, **only), indexed)


def _drip_in(ingest: Ingest, batches: int) -> None:
    """Drain the feed in about so many batches."""
    ingest.drip(size=max(1, -(-ingest.feed.count() // batches)))


def _loaded_counts(ingest: Ingest) -> DataFrame:
    tables = {f"raw.{t}": ingest.raw(t) for t in ("customers", "orders", "order_items", "order_payments", "order_reviews")}
    loaded = row_counts(tables).withColumnRenamed("table_name", "subject")
    refused = (
        ingest.load_errors()
        .groupBy(F.concat_ws(" ", "source_table", "error_type").alias("subject"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    return loaded.unionByName(refused)


def drip_equals_bulk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches through the cursor load and refuse what one pass would."""
    ingest = new_ingest(spark, sf_dir, indexed=False)
    size = -(-ingest.feed.count() // 3)
    ingest.drip(runs=5, size=size)
    return portable(_loaded_counts(ingest))


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through Structured Streaming, once over everything that landed."""
    ingest = new_ingest(spark, sf_dir, indexed=False)
    source = spark.readStream.schema(adapters.SCHEMAS["orders"]).option("pathGlobFilter", "orders.parquet").parquet(sf_dir)
    query = ingest.stream(adapters.landing_orders(source), f"{ingest.store.root}/stream-state")
    query.awaitTermination()
    return portable(_loaded_counts(ingest))


def _loaded_rows(ingest: Ingest) -> DataFrame:
    """All loaded rows in one shape."""

    def rows(table: str, order_id="order_id", number=None, other=None, amount=None, text=None) -> DataFrame:
        def value(name: str | None, kind: str):
            return (F.lit(None) if name is None else F.col(name)).cast(kind)

        return ingest.raw(table).select(
            F.lit(f"raw.{table}").alias("table_name"),
            value(order_id, "string").alias("order_id"),
            value(number, "bigint").alias("number"),
            value(other, "string").alias("other"),
            value(amount, "double").alias("amount"),
            value(text, "string").alias("text"),
        )

    return union_all(
        [
            rows("orders", other="customer_id", text="order_status"),
            rows("customers", None, other="customer_id", text="customer_unique_id"),
            rows("order_items", number="order_item_id", other="product_id", amount="price", text="seller_id"),
            rows("order_payments", number="payment_sequential", amount="payment_value", text="payment_type"),
            rows("order_reviews", number="review_score", other="review_id"),
        ]
    )


def drip_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row that three batches through the cursor and the file indexes leave in the raw tables."""
    ingest = new_ingest(spark, sf_dir)
    _drip_in(ingest, 3)
    return portable(_loaded_rows(ingest))


def _arrivals(spark: SparkSession, folder: str) -> DataFrame:
    """Landed orders as a stream of files."""
    return spark.readStream.schema(LANDING["orders"]).parquet(f"{folder}/arrivals")


def _arrive(spark: SparkSession, sf_dir: str, folder: str, condition: str) -> None:
    orders = adapters.landing_tables(spark, sf_dir)["orders"].select(*LANDING["orders"].names)
    orders.filter(condition).write.mode("append").parquet(f"{folder}/arrivals")


def stream_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row that a stream of two deliveries leaves in the raw tables."""
    ingest = new_ingest(spark, sf_dir, indexed=False)
    root = ingest.store.root
    for condition in ("order_id % 2 = 0", "order_id % 2 = 1"):
        _arrive(spark, sf_dir, root, condition)
        ingest.stream(_arrivals(spark, root), f"{root}/stream-state").awaitTermination()
    return portable(_loaded_rows(ingest))


def stream_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream whose checkpoint is lost starts anew at the same path: nothing is lost or doubled."""
    ingest = new_ingest(spark, sf_dir, indexed=False)
    root = ingest.store.root
    for condition in ("order_id % 3 = 0", "order_id % 3 <> 0"):
        _arrive(spark, sf_dir, root, condition)
        ingest.stream(_arrivals(spark, root), f"{root}/stream-state").awaitTermination()
        ingest.store.clear("stream-state")
    return portable(_loaded_counts(ingest))


def late_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items that land after their orders were loaded: the rows that a backfill adds."""
    ingest = new_ingest(spark, sf_dir, order_items="order_id % 5 <> 0")
    _drip_in(ingest, 2)
    items = adapters.landing_tables(spark, sf_dir)["order_items"].filter("order_id % 5 = 0")
    items.write.mode("append").parquet(f"{ingest.store.root}/landing/order_items")
    done = ingest.backfill_children()
    added = ingest.raw("order_items").filter(F.col("batch_id") == done.batch_id)
    names = ("order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value")
    return portable(added.select(*names))


def late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders behind a cursor that were not loaded: every seventh one is held back."""
    feed = adapters.landing_orders(_read(spark, sf_dir, "orders"))
    loaded = feed.filter("order_id % 7 <> 0").select("order_id")
    behind = up_to_cursor(F.col("purchase_ts"), F.col("order_id"), LATE_CURSOR, "5")
    late = absent_from(feed.filter(behind), loaded, ["order_id"])
    return portable(late.select("order_id", "customer_id", "purchase_ts"))


def stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in two deliveries, the second with late and repeated ones: which were accepted."""
    root = f"{shared_dir(spark).rstrip('/')}/late-{uuid.uuid4().hex}"
    events = _read(spark, sf_dir, "events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    early = (F.col("ts") < F.lit(str(STREAM_SPLIT)).cast("timestamp")) & (F.col("event_id") % 7 != 0)
    gate = late.LateGate(spark, root, events.schema, ["event_id"], "ts", STREAM_DELAY)
    repeated = events.filter(early & (F.col("event_id") % 5 == 0))
    for rows in (events.filter(early), events.filter(~early).unionByName(repeated)):
        rows.write.mode("append").parquet(f"{root}/landing")
        gate.run(spark.readStream.schema(events.schema).parquet(f"{root}/landing"))
    named = {"accepted": gate.accepted(), "late": gate.late()}
    said = [rows.withColumn("verdict", F.lit(name)) for name, rows in named.items()]
    return portable(union_all(said).withColumn("ts", F.col("ts").cast("timestamp_ntz")))


def _after_drip(report: Callable[[Ingest, Mart], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ingest = new_ingest(spark, sf_dir, indexed=False)
        ingest.drip(runs=2, size=ingest.feed.count())
        raw = adapters.raw_tables(spark, sf_dir)
        names = ("geolocation", "states", "category_groups", "payment_types", "country")
        return portable(report(ingest, ingest.mart({n: getattr(raw, n) for n in names})))

    return run


def _batch_report(ingest: Ingest, _: Mart) -> DataFrame:
    return insights.recent_batches(health.pipeline_health(ingest.load_batch())).drop("duration_seconds")


def _cursor(ingest: Ingest, _: Mart) -> DataFrame:
    watermark = ingest.store.read_batches("ops/ingest_watermark", OPS["ingest_watermark"])
    return health.cursor_report(watermark, ingest.feed)


def _reject_log(ingest: Ingest, _: Mart) -> DataFrame:
    return health.load_errors(ingest.load_errors()).select("batch_id", "source_table", "error_type", "record_key")


def _pipeline_metrics(ingest: Ingest, mart: Mart) -> DataFrame:
    names = ["rows_rejected_last_batch", "pipeline_reject_rate", "failed_batches", "data_as_of"]
    return evaluate(mart, names, pipeline=ingest.load_batch())


# -- metrics ----------------------------------------------------------------------
CORE = (
    "total_revenue product_revenue freight_cost total_orders total_items total_customers avg_order_value "
    "avg_items_per_order revenue_per_customer cancellation_rate"
).split()
EXPERIENCE = (
    "avg_review_score reviewed_orders detractor_pct promoter_pct revenue_at_risk avg_delivery_days "
    "avg_promised_days late_delivery_pct avg_days_vs_promise freight_pct_of_product_revenue "
    "avg_freight_per_order data_as_of"
).split()
NEW_RETURNING = (
    "new_customers returning_customers new_customer_revenue returning_customer_revenue returning_revenue_pct"
).split()
COHORT = (
    "retention_pct cohort_customers m1_retention_pct m3_retention_pct m6_retention_pct revenue_per_cohort_customer"
).split()
VALUE = (
    "top_20_pct_customer_revenue_share avg_customer_ltv median_customer_ltv avg_days_between_orders"
).split()
REPORT = Filters(
    date_from=datetime.date(1996, 3, 15),
    date_to=datetime.date(1999, 6, 30),
    regions=("ASIA", "EUROPE"),
    category_groups=("ECONOMY", "STANDARD", "Other"),
)


def _metrics(names, by=(), where=None) -> Query:
    return _of(lambda mart: evaluate(mart, names, by, where))


PLACES = Filters(regions=("ASIA", "EUROPE"))


def _flat_metrics(table: str, by=()) -> Query:
    return _of(lambda m: evaluate(m, list(FLAT_MEASURES[table]), by, measures=FLAT_MEASURES[table]))


# -- security ---------------------------------------------------------------------
def _mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A director with every region, and one manager per region."""
    regions = [r.r_name for r in _read(spark, sf_dir, "region").collect()]
    rows = [("director@example.com", r, "National") for r in regions]
    rows += [(f"{r.lower()}@example.com", r, "Regional") for r in regions]
    return security.user_regions(spark, rows, regions)


def _secured(user: str, report: Callable) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        mapping = _mapping(spark, sf_dir)
        return portable(report(security.SecuredMart(open_mart(spark, sf_dir), mapping, user)))

    return run


def _people_seen(mart) -> DataFrame:
    return mart.bi_customer.groupBy("customer_region").agg(
        F.count(F.lit(1)).alias("people"), F.sum("lifetime_value").alias("total_ltv")
    )


def queries() -> dict[str, Query]:
    return {
        # sources and staging
        "landing_row_counts": landing_row_counts,
        "csv_landing": csv_landing,
        "geolocation_aggregate": geolocation_aggregate,
        "safe_cast_rejects": safe_cast_rejects,
        "clean_place_text": clean_place_text,
        "customers_staged": _table("customers"),
        "orders_staged": _table("orders"),
        "items_deduped": _table("order_items"),
        "payments_staged": _table("order_payments"),
        "payments_summary": _table("order_payment_summary"),
        "payments_summary_legacy": payments_summary_legacy,
        "latest_review": _table("order_reviews"),
        "products_staged": _table("products"),
        "sellers_staged": _table("sellers"),
        "geolocation_staged": _table("geolocation"),
        # star schema
        "dim_date": _table("dim_date"),
        "dim_customer": _table("dim_customer"),
        "product_bands": _table("dim_product"),
        "dim_seller": _table("dim_seller"),
        "dim_geo_centroid": _table("dim_geo"),
        "order_sequence": _of(
            lambda m: m.order_sequence.select("order_id", "customer_unique_id", "order_seq")
        ),
        "fact_orders": _table("fact_orders"),
        "fact_sales": _table("fact_sales"),
        "payment_allocation": _of(
            lambda m: m.fact_sales.groupBy("payment_type").agg(
                F.sum("allocated_payment").alias("allocated"), F.sum("item_total").alias("items")
            )
        ),
        # analytics
        "analysis_date": _table("analysis_date"),
        "rfm": _table("rfm"),
        "cohort_retention": _table("cohort"),
        "cohort_dense": _of(lambda m: analytics.cohort(m.fact_orders, dense=True)),
        "customer_ltv": _table("customer_ltv"),
        "category_pareto": _table("category_pareto"),
        # ad-hoc reports
        "headline_kpis": _of(insights.headline_kpis),
        "concentration": _of(insights.concentration),
        "repeat_rate": _of(insights.repeat_rate),
        "retention_pooled": _of(insights.retention_pooled),
        "categories_to_80": _of(insights.categories_to_80),
        "top_categories": _of(insights.top_categories),
        "freight_erosion": _of(insights.freight_erosion),
        "late_vs_review": _of(insights.late_vs_review),
        "speed_bands": _of(insights.speed_bands),
        "geo_share": _of(insights.geo_share),
        "payment_mix": _of(insights.payment_mix),
        "rfm_segments": _of(insights.rfm_segments),
        "reject_reasons": _after_drip(lambda ingest, _: insights.reject_reasons(ingest.load_errors())),
        "recent_batches": _after_drip(_batch_report),
        "ingest_cursor": _after_drip(_cursor),
        "reject_log": _after_drip(_reject_log),
        # metric layer
        "core_metrics": _metrics(CORE),
        "core_metrics_by_region_year": _metrics(CORE, ["customer_region", "purchase_year"]),
        "core_metrics_filtered": _metrics(CORE, ["customer_state"], REPORT),
        "experience_metrics": _metrics(EXPERIENCE, ["purchase_year"]),
        "new_vs_returning_metrics": _metrics(NEW_RETURNING, ["purchase_year"]),
        "repeat_customer_pct": _metrics(["repeat_customer_pct"], ["customer_region"]),
        "value_metrics": _metrics(VALUE),
        "ltv_by_band": _metrics(["avg_customer_ltv", "median_customer_ltv"], ["ltv_band"]),
        "ltv_by_region": _metrics(["avg_customer_ltv", "median_customer_ltv"], ["customer_region"]),
        "ltv_filtered": _metrics(VALUE, ["customer_state"], PLACES),
        "segments_filtered": _metrics(["customers_in_segment", "segment_revenue"], ["rfm_segment"], PLACES),
        "retention_weighted": _metrics(COHORT),
        "retention_by_cohort": _metrics(COHORT, ["cohort_month"]),
        "categories_to_80_metric": _metrics(["categories_to_80_pct"]),
        "segment_share": _of(segment_share),
        "cumulative_share_ties": _of(lambda m: share_of_selection(m, "product_category")),
        "pipeline_metrics": _after_drip(_pipeline_metrics),
        "yoy_mom": _of(over_time.yoy_mom),
        "yoy_mom_by_region": _of(lambda m: over_time.yoy_mom(m, ["customer_region"])),
        "mtd_qtd_ytd": _of(over_time.to_date),
        "running_total": _of(lambda m: over_time.running_total(m, where=REPORT)),
        "moving_avg_3m": _of(over_time.moving_average),
        "rolling_mean_3": _of(over_time.rolling_mean),
        "time_shift_yoy": _of(over_time.time_shift),
        "bi_sales_metrics": _flat_metrics("bi_sales", ["product_category_group"]),
        "bi_orders_metrics": _flat_metrics("bi_orders", ["customer_region"]),
        "bi_customer_metrics": _flat_metrics("bi_customer", ["rfm_segment"]),
        "cohort_metrics": _flat_metrics("cohort", ["month_index"]),
        # flat datasets and charts
        "bi_sales": _table("bi_sales"),
        "bi_orders": _table("bi_orders"),
        "bi_customer": _table("bi_customer"),
        "revenue_trend": _of(dashboards.revenue_trend),
        "revenue_by_state": _of(dashboards.revenue_by_state),
        "top_product_categories": _of(dashboards.top_product_categories),
        "segment_actions": _of(dashboards.segment_actions),
        "ltv_distribution": _of(dashboards.ltv_distribution),
        "cohort_pivot": _of(dashboards.cohort_pivot),
        "new_vs_returning": _of(dashboards.new_vs_returning),
        "lorenz_curve": _of(dashboards.lorenz_curve),
        "pareto_chart": _of(dashboards.pareto_chart),
        "revenue_vs_freight": _of(dashboards.revenue_vs_freight),
        "review_by_speed": _of(dashboards.review_by_speed),
        "revenue_by_review_band": _of(dashboards.revenue_by_review_band),
        "late_vs_on_time": _of(dashboards.late_vs_on_time),
        "category_detail": _of(lambda m: dashboards.category_detail(m, REPORT)),
        "product_drilldown": _of(dashboards.product_drilldown),
        "segment_sales": _of(lambda m: dashboards.segment_sales(m, "At Risk")),
        # ingest
        "keyset_window": keyset_window,
        "insert_if_absent": insert_if_absent,
        "reject_classification": reject_classification,
        "late_rows": late_rows,
        "drip_equals_bulk": drip_equals_bulk,
        "stream_ingest": stream_ingest,
        "drip_rows": drip_rows,
        "stream_rows": stream_rows,
        "stream_again": stream_again,
        "late_children": late_children,
        "stream_late": stream_late,
        # quality and security
        "dq_checks": _of(quality.dq_checks),
        "dq_checks_after_ingest": _after_drip(lambda i, m: quality.dq_checks(m, i.ingest_state())),
        "rls_static": _of(
            lambda m: security.in_region(m.bi_sales, "ASIA")
            .groupBy("customer_state")
            .agg(F.sum("item_total").alias("revenue"), F.count(F.lit(1)).alias("items"))
        ),
        "rls_dynamic": _secured("director@example.com", _people_seen),
        "rls_dynamic_manager": _secured("europe@example.com", _people_seen),
        "rls_dynamic_trend": _secured("asia@example.com", dashboards.revenue_trend),
        "rls_yoy_mom": _secured("asia@example.com", over_time.yoy_mom),
        "rls_running_total": _secured("asia@example.com", over_time.running_total),
        "rls_unknown_user": _secured("nobody@example.com", _people_seen),
    }

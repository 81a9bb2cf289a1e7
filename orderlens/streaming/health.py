"""Reports over the pipeline's own tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions.exact import pct
from orderlens.operators.keyed import first_by


def pipeline_health(load_batch: DataFrame) -> DataFrame:
    """The batch log with durations and reject rates, newest first."""
    micros = F.timestamp_diff("MICROSECOND", "started_at", "finished_at")
    rejected, loaded = F.col("rows_rejected"), F.col("rows_loaded")
    return load_batch.select(
        "batch_id",
        "source_name",
        "started_at",
        "finished_at",
        "status",
        "orders_attempted",
        "rows_loaded",
        "rows_rejected",
        F.round(micros / F.lit(1_000_000), 2).alias("duration_seconds"),
        pct(rejected, loaded + rejected, 3).alias("reject_rate_pct"),
        "watermark_to",
    ).orderBy(F.col("batch_id").desc())


def load_errors(errors: DataFrame) -> DataFrame:
    return errors.select(
        "error_id",
        "batch_id",
        "source_table",
        "error_type",
        "record_key",
        "error_detail",
        "logged_at",
    )


def cursor_report(watermark: DataFrame, feed: DataFrame) -> DataFrame:
    """Where each source's cursor stands, and what of the feed it has not reached.

    `watermark` holds a row per batch; the newest of a source counts. Rows without a
    readable time are never reached, and counted by themselves.
    """
    newest = first_by(watermark, ["source_name"], [F.col("batch_id").desc()])
    stands = newest.select(F.col("last_purchase_ts"), F.col("last_order_id")).agg(
        F.max(F.struct("last_purchase_ts", "last_order_id")).alias("at")
    )
    at = stands.select("at").scalar()
    ts, key = F.col("purchase_ts"), F.col("order_id")
    behind = (ts > at["last_purchase_ts"]) | ((ts == at["last_purchase_ts"]) & (key > at["last_order_id"]))
    counted = feed.agg(
        F.struct(
            F.count_if(F.coalesce(behind, ts.isNotNull() & at.isNull())).alias("waiting"),
            F.count_if(ts.isNull()).alias("unreadable"),
            F.count(F.lit(1)).alias("rows"),
        ).alias("c")
    )
    seen = counted.select("c").scalar()
    return newest.select(
        "source_name",
        "last_purchase_ts",
        "last_order_id",
        "orders_ingested",
        seen["waiting"].alias("orders_waiting"),
        seen["unreadable"].alias("orders_unreadable"),
        pct(F.col("orders_ingested"), seen["rows"], 2).alias("ingested_pct"),
    )

"""Bulk load of the landing layer."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.functions.casts import safe_decimal, safe_timestamp
from orderlens.functions.text import upper_code, zip_prefix
from orderlens.operators.grouped import grouped_median, smallest_mode
from orderlens.operators.keyed import union_all
from orderlens.sources.schemas import LANDING


def read_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A CSV with a header as an all-text table.

    Quoted text of reviews may hold line breaks, so such a file is read by one task; files of
    the other tables are split.
    """
    return (
        spark.read.schema(LANDING[table])
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", table == "order_reviews")
        .csv(path)
    )


def load_landing(
    spark: SparkSession, csv_paths: Mapping[str, str], root: str
) -> dict[str, DataFrame]:
    """Replace the landing tables by the CSVs; geolocation samples are aggregated on the way.

    Orders get their parsed purchase time as a typed column and are laid out by
    month, so that the ingest cursor prunes folders and row groups.
    """
    for table, path in csv_paths.items():
        rows = read_csv(spark, path, table)
        name, writer = table, rows.write
        if table == "geolocation_samples":
            name, writer = "geolocation", aggregate_geolocation(rows).write
        elif table == "orders":
            typed = typed_feed(rows)
            writer = typed.sort("purchase_month", "purchase_ts").write.partitionBy("purchase_month")
        writer.mode("overwrite").parquet(f"{root}/{name}")
    names = ["geolocation" if t == "geolocation_samples" else t for t in csv_paths]
    return {name: spark.read.parquet(f"{root}/{name}") for name in names}


def typed_feed(orders: DataFrame) -> DataFrame:
    parsed = safe_timestamp(F.col("order_purchase_timestamp"))
    return orders.withColumn("purchase_ts", parsed).withColumn(
        "purchase_month", F.date_format("purchase_ts", "yyyy-MM")
    )


def aggregate_geolocation(samples: DataFrame, hot: Sequence = ()) -> DataFrame:
    """Address samples to one point per zip prefix.

    Coordinates are medians, because single samples are far off; city and state
    are the most frequent values, the smallest on a tie.
    """
    points = samples.select(
        zip_prefix(F.col("geolocation_zip_code_prefix")).alias("zip_code_prefix"),
        safe_decimal(F.col("geolocation_lat"), 24, 18).alias("lat"),
        safe_decimal(F.col("geolocation_lng"), 24, 18).alias("lng"),
        F.col("geolocation_city").alias("city"),
        upper_code(F.col("geolocation_state")).alias("state"),
    ).filter("lat is not null and lng is not null and zip_code_prefix is not null")
    out = points.groupBy("zip_code_prefix").agg(F.count(F.lit(1)).alias("sample_count"))
    for axis in ("lat", "lng"):
        middle = grouped_median(points, "zip_code_prefix", axis, hot)
        out = out.join(
            middle.withColumn(axis, F.round(axis, 6).cast("decimal(10,6)")), "zip_code_prefix"
        )
    for name in ("city", "state"):
        out = out.join(smallest_mode(points, "zip_code_prefix", name), "zip_code_prefix", "left")
    return out.select("zip_code_prefix", "lat", "lng", "city", "state", "sample_count")


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) of every table."""
    return union_all(
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"), "row_count"
            )
            for name, df in tables.items()
        ]
    )


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)

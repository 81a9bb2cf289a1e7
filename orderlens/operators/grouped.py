"""Ordered-set aggregates per group that hold up when one group is very large."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderlens.operators.ordering import global_order


def smallest_mode(df: DataFrame, group: str, value: str) -> DataFrame:
    """(group, value): the most frequent non-NULL value, the smallest one on a tie."""
    counted = (
        df.filter(F.col(value).isNotNull()).groupBy(group, value).agg(F.count(F.lit(1)).alias("_n"))
    )
    return counted.groupBy(group).agg(F.min_by(value, F.struct(-F.col("_n"), F.col(value))).alias(value))


def middle_values(df: DataFrame, group: str, value: str, hot: Sequence = ()) -> DataFrame:
    """(group, low, high): the one or two middle values, whose mean is the median.

    Values are counted per group first. A hot group is then cumulated by the
    range-partitioned order instead of by one task.
    """
    counted = (
        df.filter(F.col(value).isNotNull()).groupBy(group, value).agg(F.count(F.lit(1)).alias("_n"))
    )
    rows = Window.partitionBy(group).orderBy(value).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    is_hot = F.coalesce(F.col(group).isin(list(hot)), F.lit(False)) if hot else F.lit(False)
    upto = counted.filter(~is_hot).withColumn("_upto", F.sum("_n").over(rows))
    if hot:
        ranked = global_order(
            counted.filter(is_hot), [F.col(group), F.col(value)], "_at", running={"_run": "_n"}
        )
        starts = ranked.groupBy(group).agg(F.min(F.col("_run") - F.col("_n")).alias("_start"))
        split = ranked.join(F.broadcast(starts), group).select(
            group, value, "_n", (F.col("_run") - F.col("_start")).alias("_upto")
        )
        upto = upto.unionByName(split)
    sizes = counted.groupBy(group).agg(F.sum("_n").alias("_all"))
    first = F.col("_upto") - F.col("_n")
    lower = F.call_function("div", F.col("_all") - F.lit(1), F.lit(2))
    upper = F.call_function("div", F.col("_all"), F.lit(2))
    near = upto.join(sizes, group).filter((first <= upper) & (lower < F.col("_upto")))
    # At most two values per group are left.
    return near.groupBy(group).agg(F.min(value).alias("low"), F.max(value).alias("high"))


def grouped_median(df: DataFrame, group: str, value: str, hot: Sequence = ()) -> DataFrame:
    """(group, value): the interpolated median, as a decimal."""
    middle = (F.col("low") + F.col("high")) / F.lit(2)
    return middle_values(df, group, value, hot).select(group, middle.alias(value))

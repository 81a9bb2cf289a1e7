"""Series over a gap-free calendar."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def one_value(df: DataFrame, value: Column) -> Column:
    """A scalar subquery: Spark runs it once and inlines the literal."""
    return df.select(value).scalar()


def densify(series: DataFrame, calendar: DataFrame, period: str, by: Sequence[str] = ()) -> DataFrame:
    """Every period of the calendar for every combination of `by`; absent periods get NULL.

    `calendar` holds one row per day or month. Combinations are spread over it by
    exploding the list of periods, which is as long as the calendar.
    """
    periods = calendar.agg(F.array_sort(F.collect_set(period)).alias("_p"))
    if not by:
        return periods.select(F.explode("_p").alias(period)).join(series, period, "left")
    groups = series.select(*by).distinct().withColumn(period, F.explode(one_value(periods, F.col("_p"))))
    return groups.join(series, [*by, period], "left")


def prior_period(value: str, order: str, steps: int, by: Sequence[str] = ()) -> Column:
    """The value `steps` periods earlier, on a densified series."""
    return F.lag(value, steps).over(Window.partitionBy(*by).orderBy(order))


def running_sum(value: str, order: str, within: Sequence[str] = ()) -> Column:
    span = Window.partitionBy(*within).orderBy(order)
    return F.sum(value).over(span.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def trailing(fn, value: str, order: str, periods: int, by: Sequence[str] = ()) -> Column:
    span = Window.partitionBy(*by).orderBy(order)
    return fn(value).over(span.rowsBetween(1 - periods, Window.currentRow))


def growth(current: Column, prior: Column) -> Column:
    """Relative change; NULL without a prior value to compare with."""
    return F.when(
        prior.isNotNull() & (prior != 0),
        (current.cast("double") - prior.cast("double")) / prior.cast("double"),
    )

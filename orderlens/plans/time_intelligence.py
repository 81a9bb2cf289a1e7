"""Revenue over time on a calendar without gaps.

Facts are summed to days or months first. Everything after that works on rows
bounded by the calendar, so windows over a whole series are small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions.dates import month_number
from orderlens.functions.exact import plain_ratio
from orderlens.operators.series import densify, growth, prior_period, running_sum, trailing
from orderlens.plans.mart import Mart
from orderlens.plans.metrics import UNRELATED, Filters, dataset

REVENUE = {"sales": "item_total", "orders": "order_total"}


def _filtered(mart: Mart, source: str, by: Sequence[str], where: Filters | None) -> DataFrame:
    where = where or Filters()
    columns = {*by, *(where.columns() - UNRELATED[source])}
    rows = where.apply(dataset(mart, source, columns), UNRELATED[source])
    return rows.filter("is_valid_sale")


def monthly_revenue(
    mart: Mart, by: Sequence[str] = (), where: Filters | None = None, source: str = "sales"
) -> DataFrame:
    """Revenue per calendar month; months without sales are present with NULL."""
    month = F.trunc("purchase_date", "month").alias("month_start")
    sums = _filtered(mart, source, by, where).groupBy(*by, month).agg(
        F.sum(REVENUE[source]).cast("decimal(22,2)").alias("revenue")
    )
    months = mart.dim_date.select("month_start").distinct()
    return densify(sums, months, "month_start", by)


def daily_revenue(
    mart: Mart, by: Sequence[str] = (), where: Filters | None = None, source: str = "sales"
) -> DataFrame:
    sums = _filtered(mart, source, by, where).groupBy(*by, F.col("purchase_date").alias("date")).agg(
        F.sum(REVENUE[source]).cast("decimal(22,2)").alias("revenue")
    )
    return densify(sums, mart.dim_date.select("date"), "date", by)


def yoy_mom(mart: Mart, by: Sequence[str] = (), where: Filters | None = None) -> DataFrame:
    """Revenue next to the previous month's and last year's; growth needs a prior value."""
    series = monthly_revenue(mart, by, where)
    month = "month_start"
    return series.withColumns(
        {
            "revenue_ly": prior_period("revenue", month, 12, by),
            "revenue_pm": prior_period("revenue", month, 1, by),
        }
    ).withColumns(
        {
            "revenue_yoy_pct": growth(F.col("revenue"), F.col("revenue_ly")),
            "revenue_mom_pct": growth(F.col("revenue"), F.col("revenue_pm")),
        }
    )


def to_date(mart: Mart, by: Sequence[str] = (), where: Filters | None = None) -> DataFrame:
    """Revenue so far in the month, quarter and year, for every day."""
    series = daily_revenue(mart, by, where).withColumns(
        {
            "_month": F.trunc("date", "month"),
            "_quarter": F.trunc("date", "quarter"),
            "_year": F.trunc("date", "year"),
        }
    )
    return series.withColumns(
        {
            "revenue_mtd": running_sum("revenue", "date", [*by, "_month"]),
            "revenue_qtd": running_sum("revenue", "date", [*by, "_quarter"]),
            "revenue_ytd": running_sum("revenue", "date", [*by, "_year"]),
        }
    ).drop("_month", "_quarter", "_year")


def running_total(mart: Mart, by: Sequence[str] = (), where: Filters | None = None) -> DataFrame:
    """Cumulative revenue inside the selection: it starts where the filters start."""
    where = where or Filters()
    series = daily_revenue(mart, by, where)
    if where.date_from:
        series = series.filter(F.col("date") >= F.lit(where.date_from))
    if where.date_to:
        series = series.filter(F.col("date") <= F.lit(where.date_to))
    return series.withColumn("running_revenue", running_sum("revenue", "date", by))


def moving_average(
    mart: Mart, months: int = 3, by: Sequence[str] = (), where: Filters | None = None
) -> DataFrame:
    """Trailing revenue over the months since the first sale in the window.

    The first months of the series average over one and two months.
    """
    series = monthly_revenue(mart, by, where)
    first = F.min(F.when(F.col("revenue").isNotNull(), F.col("month_start")))
    if by:
        starts = series.groupBy(*by).agg(first.alias("_first"))
        series = series.join(starts, list(by))
    else:
        series = series.withColumn("_first", series.agg(first.alias("f")).scalar())
    since = month_number(F.col("month_start")) - month_number(F.col("_first")) + F.lit(1)
    length = F.least(since, F.lit(months))
    total = trailing(F.sum, "revenue", "month_start", months, by)
    return series.withColumn(
        "moving_avg", F.when(length > 0, plain_ratio(total, length))
    ).drop("_first")


def rolling_mean(mart: Mart, periods: int = 3, where: Filters | None = None) -> DataFrame:
    """Mean of the last rows of the monthly order revenue, months without sales left out."""
    rows = monthly_revenue(mart, where=where, source="orders").filter("revenue is not null")
    total = trailing(F.sum, "revenue", "month_start", periods)
    seen = trailing(F.count, "revenue", "month_start", periods)
    return rows.withColumn("rolling_mean", plain_ratio(total, seen))


def time_shift(mart: Mart, months: int = 12, where: Filters | None = None) -> DataFrame:
    """Monthly order revenue against the same month `months` earlier."""
    rows = monthly_revenue(mart, where=where, source="orders").filter("revenue is not null")
    earlier = rows.select(
        F.add_months("month_start", months).alias("month_start"),
        F.col("revenue").alias("shifted_revenue"),
    )
    return rows.join(earlier, "month_start", "left").withColumn(
        "pct_change", growth(F.col("revenue"), F.col("shifted_revenue"))
    )

"""Row-level security: which regions a user may see, applied to every dataset alike."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.sources.lookups import REGIONS

SECURED = ("bi_sales", "bi_orders", "bi_customer")
# Tables without rows about people, which everybody may read.
OPEN = ("dim_date",)


def user_regions(
    spark: SparkSession, rows: Iterable[tuple[str, str, str | None]], regions: Sequence[str] = REGIONS
) -> DataFrame:
    """The mapping (user_email, region, role_label), checked before use.

    A misspelt region would show a user nothing, which looks like a quiet month,
    so it is refused here, and so is a repeated pair.
    """
    rows = list(rows)
    unknown = sorted({region for _, region, _ in rows if region not in regions})
    if unknown:
        raise ValueError(f"unknown regions: {', '.join(map(str, unknown))}")
    if len({(user, region) for user, region, _ in rows}) < len(rows):
        raise ValueError("a user may hold a region once")
    return spark.createDataFrame(rows, "user_email string, region string, role_label string")


def in_region(df: DataFrame, region: str, column: str = "customer_region") -> DataFrame:
    return df.filter(F.col(column) == region)


def visible_to(df: DataFrame, mapping: DataFrame, user: str, column: str = "customer_region") -> DataFrame:
    """Rows in the user's regions; a user without any sees nothing.

    The pairs are unique, so a user's side has at most one row per region.
    """
    mine = mapping.filter(F.col("user_email") == user).select(F.col("region").alias(column))
    return df.join(F.broadcast(mine), column, "left_semi")


class SecuredMart:
    """The three flat datasets as one user sees them, and the calendar.

    Everything over these works, time series included. Closed are the charts over tables
    that carry no region: cohorts, the concentration curve, the category Pareto and its
    freight chart, and sales of a segment.
    """

    secured = True

    def __init__(self, mart, mapping: DataFrame, user: str):
        self._mart, self._mapping, self._user = mart, mapping, user

    def __getattr__(self, name: str) -> DataFrame:
        if name in OPEN:
            return getattr(self._mart, name)
        if name not in SECURED:
            raise AttributeError(f"{name} is not available under row-level security")
        return visible_to(getattr(self._mart, name), self._mapping, self._user)

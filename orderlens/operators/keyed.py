"""Keyed building blocks: newest row per key, insert-if-absent, keyset windows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key in `order`, which must be total.

    Filtering row_number() to 1 lets Spark drop all but one row per key on the
    map side (WindowGroupLimit), so a key with very many copies stays cheap.
    """
    spot = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_spot", spot).filter("_spot = 1").drop("_spot")


def absent_from(rows: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key the target does not hold yet: the insert-if-absent half of an append."""
    return rows.join(target.select(*keys), list(keys), "left_anti")


def _instant(ts) -> Column:
    """A time without zone; as text, so that no session time zone shifts it."""
    return F.lit(str(ts)).cast("timestamp_ntz")


def after_cursor(ts: Column, key: Column, last_ts, last_key: str) -> Column:
    """(ts, key) > (last_ts, last_key), spelled so that the ts part reaches the scan."""
    if last_ts is None:
        return ts.isNotNull()
    bound = _instant(last_ts)
    return (ts >= bound) & ((ts > bound) | ((ts == bound) & (key > F.lit(last_key or ""))))


def up_to_cursor(ts: Column, key: Column, last_ts, last_key: str) -> Column:
    """(ts, key) <= (last_ts, last_key)."""
    if last_ts is None:
        return F.lit(False)
    bound = _instant(last_ts)
    return (ts <= bound) & ((ts < bound) | ((ts == bound) & (key <= F.lit(last_key or ""))))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)

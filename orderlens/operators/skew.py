"""Hot keys: find them with a sketch, then split only those.

AQE splits skewed sort-merge joins by itself where it may. The helpers here cover
what it cannot: a join whose output distribution is needed afterwards, and ordered
windows over one hot group.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderlens.operators.ordering import global_order


@dataclass(frozen=True)
class SkewPolicy:
    """A key is hot when it holds more rows than one task should take, whatever the total.

    At most `max_hot` keys are looked for, with a sketch that tracks `tracked` of them.
    """

    rows_per_task: int = 1_000_000
    max_hot: int = 2_000
    tracked: int = 10_000
    salts: int = 64


def hot_keys(df: DataFrame, columns: Sequence[str], policy: SkewPolicy) -> dict[str, list]:
    """Hot values per column from one scan of those columns.

    The frequent-items sketch merges on the map side, and at most `max_hot` values per
    column reach the driver. A miss costs time only: results never depend on this list.
    """
    sketches = [
        F.call_function("approx_top_k", F.col(c), F.lit(policy.max_hot), F.lit(policy.tracked)).alias(c)
        for c in columns
    ]
    row = df.select(*columns).agg(*sketches).first()
    return {
        c: [entry["item"] for entry in row[c] or [] if entry["item"] is not None and entry["count"] > policy.rows_per_task]
        for c in columns
    }


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    how: str = "inner",
    hot: Sequence = (),
    spread: Sequence[str] = (),
    salts: int = 64,
) -> DataFrame:
    """Join rows to a side that is unique on `on`; hot keys are salted, the rest is not.

    `spread` names the columns that tell the rows of a hot key apart. The unique
    side repeats only its hot rows, at most `salts` times each.
    """
    if not hot:
        return left.join(right, on, how)
    is_hot = F.coalesce(F.col(on).isin(list(hot)), F.lit(False))
    salt = F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")
    salted = left.withColumn("_salt", F.when(is_hot, salt).otherwise(F.lit(0)))
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    repeated = right.withColumn("_salt", F.explode(copies))
    return salted.join(repeated, [on, "_salt"], how).drop("_salt")


def sequence_within(
    df: DataFrame, group: str, order: Sequence[Column], name: str, hot: Sequence = ()
) -> DataFrame:
    """row_number() per group, where a hot group is numbered by many tasks."""
    numbered = F.row_number().over(Window.partitionBy(group).orderBy(*order)).cast("bigint")
    if not hot:
        return df.withColumn(name, numbered)
    is_hot = F.coalesce(F.col(group).isin(list(hot)), F.lit(False))
    calm = df.filter(~is_hot).withColumn(name, numbered)
    ranked = global_order(df.filter(is_hot), [F.col(group), *order], position="_at")
    starts = ranked.groupBy(group).agg(F.min("_at").alias("_start"))  # one row per hot group
    split = (
        ranked.join(F.broadcast(starts), group)
        .withColumn(name, F.col("_at") - F.col("_start") + F.lit(1))
        .drop("_at", "_start")
    )
    return calm.unionByName(split)


def colocate(df: DataFrame, key: str, hot: Sequence = ()) -> DataFrame:
    """One shuffle that later groupings and joins on `key` share, unless a key is hot."""
    return df if hot else df.repartition(key)

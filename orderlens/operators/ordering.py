"""Total order over a whole table, spread over many tasks.

A window without PARTITION BY moves everything into one task. Here rows are
range-partitioned and sorted, then written once; every partition adds up its own
rows, and the totals of the partitions before it arrive by a broadcast of one row
per partition.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderlens.session import cut_lineage

_ROW_BITS = 33  # monotonically_increasing_id(): partition id above, row in partition below


def global_order(
    df: DataFrame,
    order: Sequence[Column],
    position: str = "position",
    running: Mapping[str, str] | None = None,
    totals: Mapping[str, str] | None = None,
    row_count: str | None = None,
) -> DataFrame:
    """Number rows 1..n by `order` (which must be total), with running sums and totals.

    running maps a new column to the column it accumulates up to and including the
    row; totals maps a new column to the column it sums over all rows.
    """
    running, totals = dict(running or {}), dict(totals or {})
    summed = sorted({*running.values(), *totals.values()})
    # The partition id must not change between the two passes below, so the
    # ordered rows are written to the shared folder rather than recomputed.
    placed = cut_lineage(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    placed = placed.withColumn("_part", F.shiftright("_mid", _ROW_BITS))

    per_part = placed.groupBy("_part").agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_s_{c}") for c in summed]
    )
    # As many rows as there were range partitions.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everywhere = Window.orderBy("_part").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    offsets = per_part.select(
        "_part",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n_before"),
        F.sum("_n").over(everywhere).alias("_n_all"),
        *[F.sum(f"_s_{c}").over(before).alias(f"_before_{c}") for c in summed],
        *[F.sum(f"_s_{c}").over(everywhere).alias(f"_all_{c}") for c in summed],
    )

    local = placed
    if running:
        so_far = Window.partitionBy("_part").orderBy("_mid").rowsBetween(
            Window.unboundedPreceding, Window.currentRow
        )
        for name, source in running.items():
            local = local.withColumn(f"_run_{name}", F.sum(source).over(so_far))
    joined = local.join(F.broadcast(offsets), "_part")

    in_part = F.col("_mid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    columns = [F.col(c) for c in df.columns]
    columns.append((F.col("_n_before") + in_part + F.lit(1)).alias(position))
    for name, source in running.items():
        run, prior = F.col(f"_run_{name}"), F.col(f"_before_{source}")
        total = F.when(prior.isNull(), run).otherwise(prior + F.coalesce(run, F.lit(0)))
        columns.append(total.alias(name))
    columns += [F.col(f"_all_{source}").alias(name) for name, source in totals.items()]
    if row_count:
        columns.append(F.col("_n_all").alias(row_count))
    return joined.select(*columns)


def ntile_of(position: Column, rows: Column, tiles: int) -> Column:
    """The ntile(tiles) bucket of a 1-based position among `rows` rows."""
    at = position - F.lit(1)
    small = F.call_function("div", rows, F.lit(tiles))
    larger = rows % F.lit(tiles)  # this many buckets hold one row more
    edge = larger * (small + F.lit(1))
    in_larger = F.call_function("div", at, small + F.lit(1))
    in_small = larger + F.call_function("div", at - edge, F.greatest(small, F.lit(1)))
    return (F.when(at < edge, in_larger).otherwise(in_small) + F.lit(1)).cast("int")


def ntile_all(df: DataFrame, order: Sequence[Column], tiles: int, name: str) -> DataFrame:
    placed = global_order(df, order, position="_at", row_count="_rows")
    return placed.withColumn(name, ntile_of(F.col("_at"), F.col("_rows"), tiles)).drop("_at", "_rows")


def exact_percentile(df: DataFrame, value: str, fraction: float) -> DataFrame:
    """One row `percentile`: percentile_cont over all non-NULL values.

    Equal values are counted before anything is ordered, and only the one or two
    values around the wanted position leave the executors.
    """
    counted = df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    ranked = global_order(
        counted, [F.col(value)], position="_at", running={"_upto": "_n"}, totals={"_all": "_n"}
    )
    spot = (F.col("_all") - F.lit(1)).cast("double") * F.lit(float(fraction))
    lower, upper = F.floor(spot), F.ceil(spot)
    first = F.col("_upto") - F.col("_n")  # 0-based position of the first copy

    def at(index: Column) -> Column:
        return (first <= index) & (index < F.col("_upto"))

    amount = F.col(value).cast("double")
    ends = ranked.filter(at(lower) | at(upper)).agg(
        F.max(F.when(at(lower), amount)).alias("_low"),
        F.max(F.when(at(upper), amount)).alias("_high"),
        F.max(spot - lower).alias("_part"),
    )
    return ends.select(
        (F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_part")).alias("percentile")
    )

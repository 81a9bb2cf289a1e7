"""Sides of a join that are few by nature, checked before they are broadcast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.session import cut_lineage


def one_per(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`df`, which is unique on `keys`, so that Catalyst knows it.

    A left join to it is then left out of reports that ask for none of its columns, with
    all that is computed for the join alone.
    """
    others = [F.first(c).alias(c) for c in df.columns if c not in keys]
    # dropDuplicates() would rename columns while a plan is optimized, which exceptAll() cannot follow.
    return df.groupBy(*keys).agg(*others).select(*df.columns) if others else df.distinct()


def few(df: DataFrame, most: int = 10_000, key: str | None = None) -> DataFrame:
    """`df`, computed once, and broadcast by joins if it has at most `most` rows.

    With more rows it stays a table like any other, and Catalyst picks the join. `key` names
    the column that it is unique on.
    """
    kept = cut_lineage(df)
    small = kept.limit(most + 1).count() <= most
    if key is not None:
        kept = one_per(kept, [key])
    return F.broadcast(kept) if small else kept

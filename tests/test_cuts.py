"""Cut points found in rounds are those of a full order."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderlens.operators import cuts


def rows_of(kind: str, n: int):
    pick = random.Random(n)
    values = {
        "spread": lambda k: pick.randrange(10**9),
        "ties": lambda k: pick.choice([1, 1, 1, 1, 1, 2, None]),
        "one": lambda k: 7,
        "negative": lambda k: pick.randrange(-50, 50),
    }[kind]
    keys = [f"{'customer-' * (k % 2)}{pick.randrange(10**6):06d}{'é' * (k % 3)}-{k}" for k in range(n)]
    return [(key, values(k)) for k, key in enumerate(keys)]


@pytest.mark.parametrize("kind", ["spread", "ties", "one", "negative"])
@pytest.mark.parametrize("few", [3, 5_000])
def test_ntiles_are_those_of_a_window(spark, monkeypatch, kind, few):
    monkeypatch.setattr(cuts, "FEW", few)
    df = spark.createDataFrame(rows_of(kind, 600), "key string, value long").repartition(4)
    found = cuts.ntiles(df, {"a": F.col("value"), "b": -F.col("value")}, "key", 5)
    for name, order in (("a", F.col("value").asc_nulls_last()), ("b", (-F.col("value")).asc_nulls_last())):
        want = F.ntile(5).over(Window.orderBy(order, "key"))
        assert found.withColumn("want", want).where(F.col(name) != F.col("want")).count() == 0


@pytest.mark.parametrize("n", [0, 1, 3, 7])
def test_few_rows(spark, n):
    df = spark.createDataFrame(rows_of("spread", n), "key string, value long")
    got = sorted(r.a for r in cuts.ntiles(df, {"a": F.col("value")}, "key", 5).collect())
    size, more = divmod(n, 5)
    assert got == sorted(t for k in range(5) for t in [k + 1] * (size + (k < more)))


def test_no_rows_are_moved(spark):
    df = spark.createDataFrame(rows_of("spread", 100), "key string, value long")
    plan = cuts.ntiles(df, {"a": F.col("value")}, "key", 5)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan

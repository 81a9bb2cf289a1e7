from __future__ import annotations

import datetime
import statistics

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderlens.operators import grouped, keyed, ordering, series, skew

from tests.conftest import SMALL


@pytest.fixture(scope="module")
def sold(spark):
    """Suppliers repeat often and amounts tie."""
    return (
        spark.read.parquet(f"{SMALL}/lineitem.parquet")
        .withColumn("id", F.monotonically_increasing_id())
        .selectExpr("id", "l_suppkey as k", "cast(l_quantity as decimal(12,2)) as v")
    )


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_global_order_equals_plain_windows(sold):
    order = [F.col("v").desc(), F.col("id").asc()]
    spread = ordering.global_order(
        sold.repartition(6), order, "at", running={"run": "v"}, totals={"all": "v"}, row_count="n"
    ).withColumn("tile", ordering.ntile_of(F.col("at"), F.col("n"), 7))
    one = Window.orderBy(*order)
    plain = sold.select(
        "id", "k", "v",
        F.row_number().over(one).cast("bigint").alias("at"),
        F.sum("v").over(one.rowsBetween(Window.unboundedPreceding, 0)).alias("run"),
        F.sum("v").over(Window.partitionBy()).alias("all"),
        F.count("*").over(Window.partitionBy()).alias("n"),
        F.ntile(7).over(one).alias("tile"),
    )
    assert rows(spread) == rows(plain)


@pytest.mark.parametrize("n", [1, 3, 4, 5, 7, 10, 23, 101])
def test_ntile_of(spark, n):
    for tiles in (3, 5, 10):
        got = spark.range(1, n + 1).select(
            ordering.ntile_of(F.col("id"), F.lit(n), tiles).alias("a"),
            F.ntile(tiles).over(Window.orderBy("id")).alias("b"),
        )
        assert all(r.a == r.b for r in got.collect())


def test_exact_percentile(sold):
    values = sorted(float(r.v) for r in sold.collect())
    for fraction in (0.0, 0.25, 0.5, 0.75, 1.0):
        spot = (len(values) - 1) * fraction
        low = values[int(spot)]
        high = values[min(int(spot) + 1, len(values) - 1)]
        got = ordering.exact_percentile(sold, "v", fraction).first()[0]
        assert got == pytest.approx(low + (high - low) * (spot - int(spot)))
    assert ordering.exact_percentile(sold.filter("false"), "v", 0.5).first()[0] is None


def test_hot_keys_and_salted_join(spark, sold):
    skewed = sold.withColumn("k", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("k")))
    found = skew.hot_keys(skewed, ["k"], skew.SkewPolicy(rows_per_task=skewed.count() // 5))["k"]
    assert found == [1]
    names = spark.range(0, 8).selectExpr("id as k", "concat('n', id) as name")
    for how in ("inner", "left"):
        plain = skewed.join(names, "k", how)
        salted = skew.lookup_join(skewed, names, "k", how, found, ["id"], salts=4)
        assert rows(salted.select("id", "name")) == rows(plain.select("id", "name"))
    assert skew.hot_keys(skewed, ["k"], skew.SkewPolicy())["k"] == []


def test_sequence_within_a_hot_group(sold):
    order = [F.col("v").asc(), F.col("id").asc()]
    plain = skew.sequence_within(sold, "k", order, "n")
    split = skew.sequence_within(sold, "k", order, "n", hot=[1, 3])
    assert rows(plain.select("id", "n")) == rows(split.select("id", "n"))


def test_grouped_median_and_mode(spark, sold):
    wanted = {}
    for r in sold.collect():
        wanted.setdefault(r.k, []).append(r.v)
    for hot in ((), (1, 2)):
        got = {r.k: r.v for r in grouped.grouped_median(sold, "k", "v", hot).collect()}
        assert got == {k: statistics.median(v) for k, v in wanted.items()}
    ties = spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (1, None), (2, "z"), (2, "z"), (2, "a")], "k int, v string")
    assert rows(grouped.smallest_mode(ties, "k", "v")) == [(1, "a"), (2, "z")]


def test_first_by_keeps_one_row_and_limits_on_the_map_side(spark):
    df = spark.range(100).selectExpr("id % 7 as k", "id as v")
    first = keyed.first_by(df, ["k"], [F.col("v").desc()])
    assert rows(first) == [(k, max(range(k, 100, 7))) for k in range(7)]
    assert "WindowGroupLimit" in first._jdf.queryExecution().toString()


def test_cursor_conditions(spark):
    at = datetime.datetime(2020, 1, 1)
    later = at + datetime.timedelta(seconds=1)
    df = spark.createDataFrame(
        [(at, "a"), (at, "b"), (at, "c"), (later, "a"), (None, "z")], "ts timestamp_ntz, id string"
    )
    ahead = df.filter(keyed.after_cursor(F.col("ts"), F.col("id"), at, "b"))
    behind = df.filter(keyed.up_to_cursor(F.col("ts"), F.col("id"), at, "b"))
    assert rows(ahead) == [(at, "c"), (later, "a")]
    assert rows(behind) == [(at, "a"), (at, "b")]
    assert df.filter(keyed.after_cursor(F.col("ts"), F.col("id"), None, "")).count() == 4


def test_cursor_does_not_depend_on_the_session_time_zone(spark):
    at = datetime.datetime(2020, 1, 1)
    df = spark.createDataFrame([(at, "a"), (at, "c")], "ts timestamp_ntz, id string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert df.filter(keyed.after_cursor(F.col("ts"), F.col("id"), at, "b")).count() == 1
        assert df.filter(keyed.up_to_cursor(F.col("ts"), F.col("id"), at, "b")).count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_cursor_reaches_the_scan(spark):
    events = spark.read.parquet(f"{SMALL}/events.parquet")
    at = datetime.datetime(2024, 1, 10)
    plan = events.filter(keyed.after_cursor(F.col("ts"), F.col("event_id"), at, "5"))
    assert "GreaterThanOrEqual(ts,2024-01-10" in plan._jdf.queryExecution().toString()


def test_insert_if_absent(spark):
    held = spark.createDataFrame([(1, "a")], "k int, v string")
    new = spark.createDataFrame([(1, "b"), (2, "c"), (None, "d")], "k int, v string")
    assert keyed.absent_from(new, held, ["k"]).count() == 2


def test_densify_and_growth(spark):
    months = spark.createDataFrame([(m,) for m in range(1, 6)], "m int")
    sums = spark.createDataFrame([("x", 1, 10.0), ("x", 4, 0.0), ("y", 5, 3.0)], "g string, m int, v double")
    dense = series.densify(sums, months, "m", ["g"])
    assert dense.count() == 10
    assert series.densify(sums.filter("g = 'x'").drop("g"), months, "m").count() == 5
    grown = spark.createDataFrame([(1, 5.0, 4.0), (2, 5.0, None), (3, 5.0, 0.0)], "i int, a double, b double").orderBy("i")
    assert [r[0] for r in grown.select(series.growth(F.col("a"), F.col("b"))).collect()] == [0.25, None, None]

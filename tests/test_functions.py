from __future__ import annotations

import datetime
import re
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from orderlens.functions import bands, casts, dates, exact, text
from orderlens.plans import analytics


def values(spark, column, rows, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(column(F.col("v"))).collect()]


def test_safe_casts(spark):
    rows = ["12.345", " 7 ", "", None, "abc", "1e3", "2.5", "-2.5", "99999999999", "NaN"]
    assert values(spark, casts.safe_money, rows) == [
        Decimal("12.35"), Decimal("7.00"), None, None, None, Decimal("1000.00"),
        Decimal("2.50"), Decimal("-2.50"), None, None,
    ]
    assert values(spark, casts.safe_int, rows) == [12, 7, None, None, None, 1000, 3, -3, None, None]


def test_safe_timestamp(spark):
    rows = ["2017-01-02 03:04:05", " 2017-01-02 ", "2017", "2017-13-01", "01/02/2017", "", None]
    assert values(spark, casts.safe_timestamp, rows) == [
        datetime.datetime(2017, 1, 2, 3, 4, 5), datetime.datetime(2017, 1, 2), None, None, None, None, None,
    ]


def test_clean_place(spark):
    rows = ["SÃO  PAULO ", "rio-grande d'oeste", "", "   ", None, "\tcampinas", "Weißenfels"]
    assert values(spark, text.clean_place, rows) == [
        "Sao Paulo", "Rio-Grande D'Oeste", None, None, None, " Campinas", "Weissenfels",
    ]
    assert values(spark, text.zip_prefix, [" 123 ", "123456"]) == ["00123", "12345"]


@pytest.mark.parametrize("digits", [0, 1, 2, 3, 4])
def test_exact_ratio_rounds_half_away_from_zero(spark, digits):
    pairs = [(1, 3), (-1, 3), (1, 8), (-1, 8), (5, 2), (2, 3), (10**13, 7), (10**13, 3), (0, 5), (7, 0)]
    df = spark.createDataFrame([(i, n, d) for i, (n, d) in enumerate(pairs)], "i int, n bigint, d bigint")
    got = [r[0] for r in df.orderBy("i").select(exact.exact_ratio(F.col("n"), F.col("d"), digits)).collect()]
    for (n, d), value in zip(pairs, got):
        if d == 0:
            assert value is None
            continue
        scaled = Fraction(abs(n), d) * 10**digits
        want = (2 * scaled.numerator + scaled.denominator) // (2 * scaled.denominator)
        assert value == Decimal(want if n >= 0 else -want).scaleb(-digits)


def test_exact_share_agrees_on_both_paths(spark):
    rows = [("10.00", "1.00", "3.00"), ("30000000.05", "10000000.01", "40000000.00"), ("1.00", "1.00", "0.00")]
    df = spark.createDataFrame([tuple(map(Decimal, r)) for r in rows], "a decimal(22,2), p decimal(13,2), w decimal(22,2)")
    got = [r[0] for r in df.select(exact.exact_share(F.col("a"), F.col("p"), F.col("w"))).collect()]
    want = Fraction("30000000.05") * Fraction("10000000.01") / 40000000
    assert got == [Decimal("3.33"), Decimal(round(want * 100)).scaleb(-2), None]


def test_hours_between(spark):
    df = spark.sql(
        "select timestamp_ntz'2017-01-01 00:00:00' a, timestamp_ntz'2017-01-01 01:30:00' b, "
        "timestamp_ntz'2016-12-31 23:59:42' c, cast(null as timestamp_ntz) d"
    )
    got = df.select(*[dates.hours_between(F.col("a"), F.col(x)) for x in "bcd"]).first()
    assert list(got) == [Decimal("1.50"), Decimal("-0.01"), None]


def test_bands(spark):
    assert values(spark, bands.speed_band, [-1, 3, 4, 30, 31, None], "int") == [
        "1. 0-3 days", "1. 0-3 days", "2. 4-7 days", "4. 15-30 days", "5. 30+ days", "5. 30+ days",
    ]
    assert values(spark, bands.delivery_speed_band, [None, 8], "int") == ["Not delivered", "3. 8-14 days"]
    assert values(spark, bands.weight_band, [None, 499, 500, 10000], "int") == [
        "Unknown", "1. Under 0.5kg", "2. 0.5-2kg", "4. Over 10kg",
    ]
    assert values(spark, bands.frequency_score, [1, 2, 3, 4, 10], "int") == [1, 3, 4, 5, 5]
    assert values(spark, bands.review_band, [5, 4, 3, 2, 1], "int") == [
        "Promoter (4-5)", "Promoter (4-5)", "Passive (3)", "Detractor (1-2)", "Detractor (1-2)",
    ]


def test_every_segment(spark):
    grid = spark.range(1, 6).select(F.col("id").alias("r")).join(spark.range(1, 6).select(F.col("id").alias("fm")))
    rank = bands.segment_rank(F.col("r"), F.col("fm"))
    got = {(r.r, r.fm): (r.rank, r.name) for r in grid.select("r", "fm", rank.alias("rank"), bands.segment_name(rank).alias("name")).collect()}
    assert got[5, 5] == got[4, 4] == (1, "Champions")
    assert got[2, 5] == (2, "Cannot Lose Them")
    assert got[1, 3] == (3, "At Risk")
    assert got[3, 5] == got[5, 3] == (4, "Loyal Customers")
    assert [got[r, 1][1] for r in (5, 4, 3, 2, 1)] == [
        "New Customers", "Promising", "Needs Attention", "Hibernating", "Lost",
    ]
    assert {rank for rank, _ in got.values()} == set(range(1, 10))


def _longest_method(df, capsys) -> int:
    capsys.readouterr()
    df.explain("codegen")
    return max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)))


def test_a_share_in_steps_is_the_share_and_short_enough_to_compile(spark, capsys):
    values = ["0", "0.01", "-0.01", "3.33", "99999.99", "9999999.99", "10000000", "99999999999.99", None]
    rows = [(a, p, w) for a in values for p in values for w in values]
    df = spark.createDataFrame(rows, "a string, p string, w string")
    df = df.selectExpr("cast(a as decimal(22,2)) a", "cast(p as decimal(13,2)) p", "cast(w as decimal(22,2)) w")
    df = df.where("coalesce(abs(a * p / nullif(w, 0)), 0) < 1e14")
    a, p, w = F.col("a"), F.col("p"), F.col("w")
    made = exact.with_exact_share(df, "share", a, p, w).withColumn("one", exact.exact_share(a, p, w))
    assert made.where("not share <=> one").count() == 0 and made.where("share is not null").count() > 100
    assert made.columns == ["a", "p", "w", "share", "one"]
    table = spark.range(9).selectExpr("cast(id as decimal(22,2)) a", "cast(id as decimal(13,2)) p", "cast(id as decimal(22,2)) w")
    # the JVM compiles no method of more than 8,000 bytes
    assert _longest_method(exact.with_exact_share(table, "share", a, p, w), capsys) < 8_000
    assert _longest_method(table.select(exact.exact_share(a, p, w)), capsys) > 8_000


def test_ratios_in_steps_are_the_ratios_and_short_enough_to_compile(spark, capsys):
    values = ["0", "0.01", "-0.01", "3.33", "9999999.99", "1000000000", "99999999999.99", None]
    df = spark.createDataFrame([(n, d) for n in values for d in values], "n string, d string")
    df = df.selectExpr("cast(n as decimal(22,2)) n", "cast(d as decimal(22,2)) d")
    df = df.where("coalesce(abs(n / nullif(d, 0)), 0) < 1e10")
    n, d = F.col("n"), F.col("d")
    made = exact.with_exact_ratio(df, "ratio", n * 100, d, 4).withColumn("one", exact.pct(n, d, 4))
    assert made.where("not ratio <=> one").count() == 0 and made.where("ratio is not null").count() > 30
    assert made.columns == ["n", "d", "ratio", "one"]
    counts = spark.range(-20, 20).selectExpr("id n").join(spark.range(-3, 9).selectExpr("id d"))
    counted = exact.with_count_pct(counts, "share", n, d, 4).withColumn("one", exact.pct(n, d, 4))
    assert counted.where("not share <=> one").count() == 0 and counted.where("share is not null").count() > 400


def test_code_over_people_is_short_enough_to_compile(spark, capsys):
    orders = spark.range(9).selectExpr(
        "cast(id as string) customer_unique_id", "true is_valid_sale", "id items_in_order", "date'2020-01-01' purchase_date",
        *[f"cast(id as decimal(22,2)) {c}" for c in ("order_revenue", "order_freight", "order_total")],
        "cast(5 as smallint) review_score", "false is_late",
    )
    totals = analytics.person_totals(orders)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # plans with stages to come show no code
    try:
        # the JVM compiles no method of more than 8,000 bytes
        assert _longest_method(totals, capsys) < 8_000
        assert _longest_method(analytics.customer_ltv(totals), capsys) < 8_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)

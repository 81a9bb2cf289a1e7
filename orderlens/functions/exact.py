"""Ratios rounded half away from zero on integers, so no engine can disagree."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Amounts below this take 64-bit arithmetic; larger ones 38-digit decimals.
_SMALL = 10**9
_WIDE = "decimal(38,0)"


def _cents(value: Column) -> Column:
    """A small amount in cents. decimal(14,2) times 100 still fits 18 digits."""
    return (value.cast("decimal(14,2)") * F.lit(100)).cast("bigint")


def _wide_cents(value: Column) -> Column:
    return (value.cast("decimal(30,2)") * F.lit(100)).cast(_WIDE)


def _scaled(units: Column, digits: int) -> Column:
    """Integer units of 10**-digits as decimal(18, digits)."""
    unit, fits = F.lit(Decimal(1).scaleb(-digits)), 17 - digits
    short = units.cast(f"decimal({fits},0)") * unit
    long = units.cast("decimal(18,0)") * unit
    kind = f"decimal(18,{digits})"
    return F.when(F.abs(units) < 10**fits, short.cast(kind)).otherwise(long.cast(kind))


def _rounded_quotient(num: Column, den: Column, scale: int) -> Column:
    """round(num * scale / den) on integers, half away from zero."""
    size = F.call_function("div", F.abs(num) * F.lit(2 * scale) + F.abs(den), F.abs(den) * F.lit(2))
    return F.when((num < 0) != (den < 0), -size).otherwise(size)


def _small(*values: Column) -> Column:
    condition = F.abs(values[0]) < _SMALL
    for value in values[1:]:
        condition = condition & (F.abs(value) < _SMALL)
    return condition


def exact_ratio(num: Column, den: Column, digits: int) -> Column:
    """round(num / den, digits) for amounts or counts; NULL when den is zero."""
    if digits > 4:
        raise ValueError("at most four digits")
    small = _rounded_quotient(_cents(num), _cents(den), 10**digits)
    large = _rounded_quotient(_wide_cents(num), _wide_cents(den), 10**digits)
    units = F.when(_small(num, den), small).otherwise(large)
    return F.when(den != 0, _scaled(units, digits))


def with_exact_ratio(df: DataFrame, name: str, num: Column, den: Column, digits: int) -> DataFrame:
    """`exact_ratio` as a new column, computed in steps; see `with_exact_share`."""
    if digits > 4:
        raise ValueError("at most four digits")
    num_, den_ = F.col("_num"), F.col("_den")
    steps = df.withColumns({"_num": num, "_den": den})
    steps = steps.withColumn("_fits", F.coalesce(_small(num_, den_), F.lit(False)))
    few = F.col("_fits") & (den_ != 0)
    many = ~F.col("_fits") & (den_ != 0)
    steps = steps.withColumns(
        {
            "_small_num": F.when(few, _cents(num_)),
            "_small_den": F.when(few, _cents(den_)),
            "_wide_num": F.when(many, _wide_cents(num_)),
            "_wide_den": F.when(many, _wide_cents(den_)),
        }
    )
    small = _rounded_quotient(F.col("_small_num"), F.col("_small_den"), 10**digits)
    large = _rounded_quotient(F.col("_wide_num"), F.col("_wide_den"), 10**digits)
    steps = steps.withColumn("_units", F.when(F.col("_fits"), small).otherwise(large))
    made = steps.withColumn(name, _scaled(F.col("_units"), digits))
    return made.drop("_num", "_den", "_fits", "_small_num", "_small_den", "_wide_num", "_wide_den", "_units")


def with_count_pct(df: DataFrame, name: str, num: Column, den: Column, digits: int) -> DataFrame:
    """`pct` of two bigint counts as a new column; 64 bits hold any that rows can have."""
    units = _rounded_quotient(num * F.lit(100), den, 10**digits)
    counted = df.withColumn("_units", F.when(den != 0, units))
    return counted.withColumn(name, _scaled(F.col("_units"), digits)).drop("_units")


def row_ratio(num: Column, den: Column, digits: int) -> Column:
    """`exact_ratio` for single decimal(12,2) amounts, which always fit 64 bits."""
    cents = [(amount * F.lit(100)).cast("bigint") for amount in (num, den)]
    return F.when(den != 0, _scaled(_rounded_quotient(*cents, 10**digits), digits))


def pct(num: Column, den: Column, digits: int) -> Column:
    return exact_ratio(num * F.lit(100), den, digits)


def exact_share(amount: Column, part: Column, whole: Column) -> Column:
    """round(amount * part / whole, 2) for money."""
    limit = 10**7  # keeps the product of two amounts in cents within 64 bits
    fits = (F.abs(amount) < limit) & (F.abs(part) < limit) & (F.abs(whole) < _SMALL)
    small = _rounded_quotient(_cents(amount) * _cents(part), _cents(whole), 1)
    product = (_wide_cents(amount) * _wide_cents(part)).cast(_WIDE)
    large = _rounded_quotient(product, _wide_cents(whole), 1)
    return F.when(whole != 0, _scaled(F.when(fits, small).otherwise(large), 2))


def with_exact_share(df: DataFrame, name: str, amount: Column, part: Column, whole: Column) -> DataFrame:
    """`exact_share` as a new column, computed in steps.

    Written as one expression every step repeats the ones before it, and the code that Spark
    makes of it is longer than the JVM compiles. Columns that are used more than once stay steps.
    """
    limit = 10**7
    fits = (F.abs(amount) < limit) & (F.abs(part) < limit) & (F.abs(whole) < _SMALL)
    few = F.col("_fits") & (whole != 0)
    many = ~F.col("_fits") & (whole != 0)
    steps = df.withColumn("_fits", F.coalesce(fits, F.lit(False)))
    steps = steps.withColumns(
        {
            "_product": F.when(few, _cents(amount) * _cents(part)),
            "_whole": F.when(few, _cents(whole)),
            "_wide_product": F.when(many, (_wide_cents(amount) * _wide_cents(part)).cast(_WIDE)),
            "_wide_whole": F.when(many, _wide_cents(whole)),
        }
    )
    small = _rounded_quotient(F.col("_product"), F.col("_whole"), 1)
    large = _rounded_quotient(F.col("_wide_product"), F.col("_wide_whole"), 1)
    steps = steps.withColumn("_units", F.when(F.col("_fits"), small).otherwise(large))
    made = steps.withColumn(name, _scaled(F.col("_units"), 2))
    return made.drop("_fits", "_product", "_whole", "_wide_product", "_wide_whole", "_units")


def plain_ratio(num: Column, den: Column) -> Column:
    """Unrounded ratio as a double; NULL when den is zero."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def mean_of(value: Column, where: Column | None = None) -> Column:
    """Average as sum / count: exact sums do not depend on row order."""
    seen = value if where is None else F.when(where, value)
    return plain_ratio(F.sum(seen), F.count(seen))


def rounded_mean(value: Column, digits: int = 2) -> Column:
    return exact_ratio(F.sum(value), F.count(value), digits)

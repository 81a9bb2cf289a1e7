"""Text to typed values without raising: blank or unparseable text becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _text(value: Column) -> Column:
    return F.nullif(F.trim(value), F.lit(""))


def safe_decimal(value: Column, precision: int = 38, scale: int = 10) -> Column:
    return _text(value).try_cast(f"decimal({precision},{scale})")


def safe_money(value: Column) -> Column:
    """Parse at full scale, then round half away from zero to cents."""
    return F.round(safe_decimal(value), 2).try_cast("decimal(12,2)")


def safe_int(value: Column) -> Column:
    """Decimal text rounds half away from zero ('2.5' is 3); overflow is NULL."""
    return F.round(safe_decimal(value), 0).try_cast("int")


def safe_timestamp(value: Column) -> Column:
    # A bare year or a time of day would cast too, so ask for a full date first.
    text = _text(value)
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), text.try_cast("timestamp_ntz"))

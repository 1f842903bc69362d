"""Column builders shared by the jobs. All of them stay inside Spark's built-in expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(value: date | str | int) -> date:
    """A day given as date, ``YYYY-MM-DD`` or ``YYYYMMDD``."""
    if isinstance(value, datetime):
        return value.date()
    if isinstance(value, date):
        return value
    text = str(value)
    return date.fromisoformat(text) if "-" in text else date(int(text[:4]), int(text[4:6]), int(text[6:8]))


def date_key(value: date | str | int) -> int:
    """A day as the integer ``YYYYMMDD`` the warehouse uses as ``date_id``."""
    day = as_date(value)
    return day.year * 10000 + day.month * 100 + day.day


def day_to_key(day: Column) -> Column:
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def key_to_date(key: Column) -> Column:
    """``YYYYMMDD`` integer to date; 0, NULL and impossible days give NULL.

    Plain arithmetic instead of parsing a string, which costs about ten times as much per row.
    """
    year, month, day = (key / 10000).cast("int"), (key / 100).cast("int") % 100, (key % 100).cast("int")
    first = F.make_date(year, month, F.lit(1))
    return F.when(
        key.between(10000101, 99991231) & month.between(1, 12),
        F.when((day >= 1) & (day <= F.dayofmonth(F.last_day(first))), F.date_add(first, day - 1)),
    )


def month_of(key: Column) -> Column:
    """``YYYY-MM`` of a ``YYYYMMDD`` integer; NULL when it is no real day."""
    return F.date_format(key_to_date(key), "yyyy-MM")


def ratio(numerator: Column, denominator: Column, scale: int) -> Column:
    """``numerator / denominator`` rounded half up on exact decimals; NULL when the denominator is 0."""
    quotient = F.try_divide(numerator.cast("decimal(26,4)"), denominator.cast("decimal(22,4)"))
    return F.round(quotient, scale).cast(f"decimal(20,{scale})")


def percent(part: Column, whole: Column, scale: int = 2) -> Column:
    return ratio(part * F.lit(100), whole, scale)


def money(value: Column) -> Column:
    return F.coalesce(value, F.lit(0)).cast("decimal(18,2)")


def quantity(value: Column) -> Column:
    """Whole units; fractions round half up as an integer column of the warehouse would."""
    return F.round(F.coalesce(value, F.lit(0)), 0).cast("long")


def sum_when(condition: Column, value: Column) -> Column:
    return F.sum(F.when(condition, value).otherwise(F.lit(0)))


def count_when(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def flag_yn(condition: Column) -> Column:
    return F.when(condition, F.lit("Y")).otherwise(F.lit("N"))


def decode(value: Column, labels: Mapping, default: str) -> Column:
    """Simple CASE: the label of each code, ``default`` for NULL and unknown codes."""
    chain = F
    for code, label in labels.items():
        chain = chain.when(value == F.lit(code), F.lit(label))
    return chain.otherwise(F.lit(default))


def position_in(value: Column, order: Sequence[str]) -> Column:
    """1-based position of a label in a business order, 0 when it is not listed."""
    return F.array_position(F.array(*[F.lit(label) for label in order]), value)

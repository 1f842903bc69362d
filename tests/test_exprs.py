from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from shelfline.functions import as_date, date_key, decode, key_to_date, month_of, percent, position_in, quantity, ratio


def one(df):
    return df.first()[0]


def test_dates_in_any_form():
    for value in (date(2026, 3, 5), datetime(2026, 3, 5, 17, 30), "2026-03-05", "20260305", 20260305):
        assert as_date(value) == date(2026, 3, 5)
        assert date_key(value) == 20260305


def test_ratio_rounds_half_up_exactly(frame):
    rows = [(1005, 1000, "1.01"), (285, 1000, "0.29"), (1255, 1000, "1.26"), (7, 3, "2.33"), (-1005, 1000, "-1.01")]
    df = frame(rows, "n long, d long, want string")
    for row in df.select(ratio(F.col("n"), F.col("d"), 2).alias("got"), "want").collect():
        assert row.got == Decimal(row.want)


def test_ratio_of_zero_and_null_is_null(frame):
    df = frame([(5, 0), (None, 3), (5, None)], "n long, d long")
    assert [r[0] for r in df.select(ratio(F.col("n"), F.col("d"), 2)).collect()] == [None, None, None]
    assert [r[0] for r in df.select(percent(F.col("n"), F.col("d"))).collect()] == [None, None, None]


def test_impossible_dates_are_null(frame):
    keys = [20260131, 20240229, 19991231, 0, None, 20261345, 20260229, 20260431, 20260100, 20260001, 7, -20260131, 2147483647]
    df = frame([(k,) for k in keys], "k int")
    real = [date(2026, 1, 31), date(2024, 2, 29), date(1999, 12, 31)]
    assert [r[0] for r in df.select(key_to_date(F.col("k"))).collect()] == real + [None] * 10
    assert [r[0] for r in df.select(month_of(F.col("k"))).collect()] == ["2026-01", "2024-02", "1999-12"] + [None] * 10


def test_quantity_rounds_and_fills(frame):
    df = frame([(Decimal("2.5000"),), (Decimal("-2.5000"),), (None,), (Decimal("7.4999"),)], "q decimal(18,4)")
    assert [r[0] for r in df.select(quantity(F.col("q"))).collect()] == [3, -3, 0, 7]


def test_decode_and_position(frame):
    df = frame([("A",), ("Z",), (None,)], "c string")
    assert [r[0] for r in df.select(decode(F.col("c"), {"A": "first"}, "other")).collect()] == ["first", "other", "other"]
    assert [r[0] for r in df.select(position_in(F.col("c"), ["Z", "A"])).collect()] == [2, 1, None]

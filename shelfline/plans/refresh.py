"""Refreshing facts by day range: replace, check coverage, backfill."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions import as_date, date_key, over_shared
from shelfline.operators.facts import sales_coverage, sales_daily
from shelfline.rules import RetailRules


def replace_range(
    existing: DataFrame, new: DataFrame, lo, hi, column: str = "date_id", on_empty: str = "keep"
) -> DataFrame:
    """The table after deleting the days [lo, hi] and inserting ``new`` rows of that range.

    If ``new`` has no row in the range, the old rows stay unless ``on_empty="clear"``. The test for emptiness is part of
    the same plan, so nothing runs until the result is used, and it shares one evaluation of ``new`` with the new rows. To
    replace days of a stored table use ``sources.sinks.replace_days``.
    """
    if on_empty not in ("keep", "clear"):
        raise ValueError(f"on_empty must be 'keep' or 'clear', not {on_empty!r}")
    incoming = new.filter(F.col(column).between(lo, hi))
    outside = existing.filter(~F.col(column).between(lo, hi))
    if on_empty == "clear":
        return outside.unionByName(incoming)
    inside = existing.filter(F.col(column).between(lo, hi))
    names = ", ".join(f"`{c}`" for c in existing.columns)
    replaced = over_shared(
        incoming.select(*existing.columns),
        f"SELECT {names} FROM shared UNION ALL SELECT {names} FROM {{inside}} WHERE NOT EXISTS (SELECT 1 FROM shared)",
        inside=inside,
    )
    return outside.unionByName(replaced)


def replace_snapshot(
    existing: DataFrame, new: DataFrame, day, column: str = "date_id", on_empty: str = "keep"
) -> DataFrame:
    return replace_range(existing, new, day, day, column, on_empty)


def backfill_sales(
    existing: DataFrame, retail: DataFrame, item: DataFrame, store: DataFrame, product: DataFrame, lo, hi,
    rules: RetailRules = RetailRules(),
) -> DataFrame:
    """Sales facts with the days [lo, hi] computed again from the sources."""
    fresh = sales_daily(retail, item, store, product, lo, hi, rules)
    return replace_range(existing, fresh, date_key(lo), date_key(hi))


def days_to_load(stored: DataFrame | None, as_of, rules: RetailRules = RetailRules()) -> tuple[int, int]:
    """The range a refresh on ``as_of`` has to load: that day alone, or the look-back window when stored days are missing.

    Reads one row, the coverage of the full days before ``as_of``.
    """
    day = as_date(as_of)
    first, last = day - timedelta(days=rules.long_window_days), day - timedelta(days=1)
    complete = stored is not None and not sales_coverage(stored, first, last).first()["needs_backfill"]
    return (date_key(day), date_key(day)) if complete else (date_key(first), date_key(day))


def changed_days(stored: DataFrame, current: DataFrame) -> DataFrame:
    """Days whose source lines are not those of the stored prints: (date_id, lines_before, lines_now).

    Both sides come from ``facts.day_prints``; a day that only one of them has counts as changed.
    """

    def side(df: DataFrame, lines: str, mark: str) -> DataFrame:
        return df.select("date_id", F.col("source_lines").alias(lines), F.col("print").alias(mark))

    both = side(stored, "lines_before", "_before").unionByName(side(current, "lines_now", "_now"), allowMissingColumns=True)
    return (
        both.groupBy("date_id")
        .agg(*[F.max(c).alias(c) for c in ("lines_before", "lines_now", "_before", "_now")])
        .filter(~(F.col("_before").eqNullSafe(F.col("_now")) & F.col("lines_before").eqNullSafe(F.col("lines_now"))))
        .select("date_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("lines_before", "lines_now")])
    )


def day_runs(days: list[int]) -> list[tuple[int, int]]:
    """Day keys as (first, last) of each run of consecutive days."""
    runs: list[list[int]] = []
    for day in sorted(set(days)):
        if runs and as_date(day) - as_date(runs[-1][1]) == timedelta(days=1):
            runs[-1][1] = day
        else:
            runs.append([day, day])
    return [(first, last) for first, last in runs]

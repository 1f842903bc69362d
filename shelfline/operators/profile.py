"""Generic profiles behind the purchase, transfer and stock reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.functions import count_when, decode, month_of, percent


def active(df: DataFrame) -> DataFrame:
    return df.filter(F.col("isactive") == "Y")


def stack_rows(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def table_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: rows, distinct ids, active and inactive rows, first and last creation."""
    return stack_rows(
        [
            df.agg(
                F.count(F.lit(1)).alias("total_rows"),
                F.count_distinct("id").alias("distinct_ids"),
                count_when(F.col("isactive") == "Y").alias("active_rows"),
                count_when(F.col("isactive") == "N").alias("inactive_rows"),
                F.min("creationdate").alias("first_created"),
                F.max("creationdate").alias("last_created"),
            ).select(F.lit(name).alias("table_name"), "*")
            for name, df in tables.items()
        ]
    )


def latest_rows(df: DataFrame, columns: Sequence[str], limit: int) -> DataFrame:
    """The most recently created active rows (undated rows last, id as tie-breaker)."""
    return (
        active(df).orderBy(F.col("creationdate").desc_nulls_last(), F.col("id").asc()).select(*columns).limit(limit)
    )


def with_share(grouped: DataFrame, count: str, share: str = "pct") -> DataFrame:
    """Percent of the total count. ``grouped`` must already hold one row per code, so its window stays tiny."""
    return grouped.withColumn(share, percent(F.col(count), F.sum(count).over(Window.partitionBy())))


def distribution(
    df: DataFrame, code: str, labels: Mapping | None = None, default: str = "", sums: Mapping[str, str] | None = None
) -> DataFrame:
    """Rows, share and optional sums per value of a code column, with its decoded label."""
    aggregates = [F.count(F.lit(1)).alias("cnt")]
    aggregates += [F.sum(source).alias(name) for name, source in (sums or {}).items()]
    out = with_share(df.groupBy(code).agg(*aggregates), "cnt")
    if labels is not None:
        out = out.withColumn("label", decode(F.col(code), labels, default))
    return out


def fill_rates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: rows, filled, missing, fill rate, smallest and largest value, from a single scan."""
    aggregates = [F.count(F.lit(1)).alias("total_rows")]
    for c in columns:
        aggregates += [F.count(c).alias(f"{c}_n"), F.min(c).alias(f"{c}_lo"), F.max(c).alias(f"{c}_hi")]
    fields = F.array(
        *[
            F.struct(
                F.lit(c).alias("field"),
                F.col("total_rows").alias("total_rows"),
                F.col(f"{c}_n").alias("filled"),
                F.col(f"{c}_lo").alias("first_value"),
                F.col(f"{c}_hi").alias("last_value"),
            )
            for c in columns
        ]
    )
    return df.agg(*aggregates).select(F.inline(fields)).select(
        "field", "total_rows", "filled",
        (F.col("total_rows") - F.col("filled")).alias("missing"),
        percent(F.col("filled"), F.col("total_rows")).alias("fill_rate"),
        "first_value", "last_value",
    )


def monthly(df: DataFrame, day_key: str, totals: Mapping[str, Column], months: int | None = None) -> DataFrame:
    """Totals per month of a YYYYMMDD column, of all months or the latest; missing and zero dates are left out.

    ``totals`` are counts and sums. They are taken per day first, on the plain integer, so the month is worked out once
    per day and not once per document.
    """
    per_day = (
        df.filter(F.col(day_key).isNotNull() & (F.col(day_key) > 0))
        .groupBy(day_key)
        .agg(*[total.alias(name) for name, total in totals.items()])
    )
    by_month = (
        per_day.groupBy(month_of(F.col(day_key)).alias("month"))
        .agg(*[F.sum(name).alias(name) for name in totals])
        .orderBy(F.col("month").desc_nulls_last())
    )
    return by_month if months is None else by_month.limit(months)


def top_by(df: DataFrame, key: str, aggregates: Sequence[Column], rank_by: str, limit: int | None) -> DataFrame:
    """All groups, or the top ones, by one aggregate, nulls last, ties by key."""
    ranked = (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(*aggregates)
        .orderBy(F.col(rank_by).desc_nulls_last(), F.col(key).asc())
    )
    return ranked if limit is None else ranked.limit(limit)


def header_item_consistency(
    header: DataFrame, item: DataFrame, header_total: str, item_key: str, item_qty: str
) -> DataFrame:
    """Compare a header total with the sum of its active lines (tolerance 0.01, no lines count as 0).

    A header without a total is in neither class. The lines are summed per header first; that shuffle already has the
    partitioning the join and the distinct count of header ids need.
    """
    lines = active(item).groupBy(F.col(item_key).alias("id")).agg(F.sum(item_qty).alias("line_total"))
    gap = F.abs(F.col(header_total) - F.coalesce("line_total", F.lit(0)))
    out = (
        active(header)
        .select("id", header_total)
        .join(lines, "id", "left")
        .agg(
            F.count_distinct("id").alias("documents"),
            count_when(gap <= F.lit(0.01).cast("decimal(3,2)")).alias("consistent"),
            count_when(gap > F.lit(0.01).cast("decimal(3,2)")).alias("inconsistent"),
        )
    )
    return out.withColumn("consistent_pct", percent(F.col("consistent"), F.col("documents")))


def scorecard(aggregated: DataFrame, entries: Sequence[tuple[str, Column, Column | None, Column]]) -> DataFrame:
    """Turn one row of aggregates into rows (item, hits, total, rate, verdict).

    Each entry is (item, hits, total or None, verdict); the verdict may use ``rate(hits, total)``.
    """
    rows = F.array(
        *[
            F.struct(
                F.lit(item).alias("item"),
                hits.cast("long").alias("hits"),
                (F.lit(None) if total is None else total).cast("long").alias("total"),
                (F.lit(None) if total is None else rate(hits, total)).cast("decimal(20,2)").alias("rate"),
                verdict.alias("verdict"),
            )
            for item, hits, total, verdict in entries
        ]
    )
    return aggregated.select(F.inline(rows))


def rate(hits: Column, total: Column) -> Column:
    """Percent for scorecards: 0 for an empty table."""
    return F.coalesce(percent(hits, total), F.lit(0).cast("decimal(20,2)"))


def graded(value: Column, good: float, fair: float | None = None) -> Column:
    """PASS from ``good`` up, WARNING from ``fair`` up (or always, when no lower band is given), else FAIL."""
    bands = F.when(value >= good, "PASS")
    return bands.otherwise("WARNING") if fair is None else bands.when(value >= fair, "WARNING").otherwise("FAIL")

"""Purchase-order reports on headers and lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline import rules as L
from shelfline.functions import count_when, percent, ratio
from shelfline.operators.profile import (
    active, distribution, fill_rates, graded, header_item_consistency, latest_rows, monthly, rate, scorecard,
    table_profile, top_by, with_share,
)


def _header_qty() -> tuple[Column, Column]:
    """Ordered and received quantity of a header."""
    return F.col("tot_qty"), F.col("tot_qtyin")


def _item_qty() -> tuple[Column, Column]:
    """Ordered and received quantity of a line."""
    return F.col("qty"), F.col("qtyin")


def purchase_profile(purchase: DataFrame, purchase_item: DataFrame) -> DataFrame:
    return table_profile({"M_PURCHASE": purchase, "M_PURCHASEITEM": purchase_item})


def purchase_sample(purchase: DataFrame, limit: int = 10) -> DataFrame:
    return latest_rows(purchase, purchase.columns, limit)


def purchase_in_status(purchase: DataFrame) -> DataFrame:
    return distribution(active(purchase), "in_status").orderBy(F.col("in_status").asc_nulls_last())


def purchase_datein_fill(purchase: DataFrame) -> DataFrame:
    return fill_rates(active(purchase), ["datein"])


def purchase_qtyin_stats(purchase: DataFrame) -> DataFrame:
    _, received = _header_qty()
    return active(purchase).agg(
        F.count(F.lit(1)).alias("total_rows"),
        count_when(received > 0).alias("with_qty"),
        count_when(received == 0).alias("zero_qty"),
        count_when(received.isNull()).alias("null_qty"),
        F.sum(received).alias("total_qty"),
        ratio(F.sum(received), F.count(received), 2).alias("avg_qty"),
    )


def purchase_amtin_stats(purchase: DataFrame) -> DataFrame:
    amount = F.col("tot_amtin_actual")
    return active(purchase).agg(
        F.count(F.lit(1)).alias("total_rows"),
        count_when(amount > 0).alias("with_amount"),
        count_when(amount == 0).alias("zero_amount"),
        F.sum(amount).alias("total_amount"),
        ratio(F.sum(amount), F.count(amount), 2).alias("avg_amount"),
    )


def purchase_receiver_fill(purchase: DataFrame) -> DataFrame:
    return active(purchase).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count("inerid").alias("with_receiver"),
        F.count("intime").alias("with_time"),
        count_when(F.col("inerid").isNotNull() & F.col("intime").isNotNull()).alias("with_both"),
    )


def purchase_receipt_compare(purchase: DataFrame) -> DataFrame:
    ordered, received = _header_qty()
    return (
        active(purchase)
        .filter(ordered > 0)
        .agg(
            F.count(F.lit(1)).alias("total_rows"),
            count_when(ordered > 0).alias("with_ordered"),
            count_when(received > 0).alias("with_received"),
            count_when(ordered == received).alias("full_receipts"),
            count_when((received < ordered) & (received > 0)).alias("partial_receipts"),
            count_when(received > ordered).alias("over_receipts"),
            count_when((received == 0) | received.isNull()).alias("no_receipts"),
        )
    )


def _by_quantity(ordered: Column, received: Column) -> Column:
    return (
        F.when(received == ordered, L.RECEIPT_FULL)
        .when(received < ordered, L.RECEIPT_PARTIAL)
        .otherwise(L.RECEIPT_OVER)
    )


def header_completion_class() -> Column:
    """Receipt class of a header: received documents by quantity, then open ones, then those without quantity."""
    ordered, received = _header_qty()
    return (
        F.when((F.col("in_status") == 2) & (received > 0) & (ordered > 0), _by_quantity(ordered, received))
        .when(F.col("in_status") == 1, L.RECEIPT_NONE)
        .when(ordered == 0, L.RECEIPT_NO_QTY)
        .otherwise(L.OTHER)
    )


def purchase_completion(purchase: DataFrame) -> DataFrame:
    ordered, received = _header_qty()
    grouped = (
        active(purchase)
        .groupBy(header_completion_class().alias("receipt_class"))
        .agg(
            F.count(F.lit(1)).alias("cnt"),
            F.sum(ordered).alias("ordered_qty"),
            F.sum(received).alias("received_qty"),
        )
    )
    return (
        with_share(grouped, "cnt")
        .withColumn("completion_pct", percent(F.col("received_qty"), F.col("ordered_qty")))
        .orderBy(F.col("cnt").desc(), "receipt_class")
    )


def purchase_monthly(purchase: DataFrame, months: int | None = None) -> DataFrame:
    ordered, received = _header_qty()
    totals = {
        "receipts": F.count(F.lit(1)),
        "ordered_qty": F.sum(ordered),
        "received_qty": F.sum(received),
        "ordered_amount": F.sum("tot_amt_actual"),
        "received_amount": F.sum("tot_amtin_actual"),
    }
    return monthly(active(purchase), "datein", totals, months)


def _top_receivers(purchase: DataFrame, key: str, limit: int | None) -> DataFrame:
    ordered, received = _header_qty()
    return top_by(
        active(purchase),
        key,
        [
            F.count(F.lit(1)).alias("orders"),
            F.sum(ordered).alias("ordered_qty"),
            F.sum(received).alias("received_qty"),
            percent(F.sum(received), F.sum(ordered)).alias("completion_pct"),
            F.sum("tot_amtin_actual").alias("received_amount"),
        ],
        "received_amount",
        limit,
    )


def purchase_by_supplier(purchase: DataFrame, limit: int | None = None) -> DataFrame:
    return _top_receivers(purchase, "supplier_id", limit)


def purchase_by_store(purchase: DataFrame, limit: int | None = None) -> DataFrame:
    return _top_receivers(purchase, "store_id", limit)


def purchase_item_stats(purchase_item: DataFrame) -> DataFrame:
    ordered, received = _item_qty()
    return active(purchase_item).agg(
        F.count(F.lit(1)).alias("total_rows"),
        count_when(received > 0).alias("with_qty"),
        count_when(received == 0).alias("zero_qty"),
        count_when(received.isNull()).alias("null_qty"),
        F.sum(ordered).alias("ordered_qty"),
        F.sum(received).alias("received_qty"),
        percent(F.sum(received), F.sum(ordered)).alias("completion_pct"),
        ratio(F.sum(ordered), F.count(ordered), 2).alias("avg_ordered"),
        ratio(F.sum(received), F.count(received), 2).alias("avg_received"),
    )


def item_completion_class() -> Column:
    """Receipt class of a line, by quantity alone; a missing receipt counts as none."""
    ordered, received = _item_qty()
    return (
        F.when(ordered == 0, L.RECEIPT_NO_QTY)
        .when((ordered > 0) & (F.coalesce(received, F.lit(0)) == 0), L.RECEIPT_NONE)
        .when((ordered > 0) & (received > 0), _by_quantity(ordered, received))
        .otherwise(L.OTHER)
    )


def purchase_item_completion(purchase_item: DataFrame) -> DataFrame:
    ordered, received = _item_qty()
    grouped = (
        active(purchase_item)
        .groupBy(item_completion_class().alias("receipt_class"))
        .agg(
            F.count(F.lit(1)).alias("cnt"),
            F.sum(ordered).alias("ordered_qty"),
            F.sum(received).alias("received_qty"),
        )
    )
    return with_share(grouped, "cnt").orderBy(F.col("cnt").desc(), "receipt_class")


def purchase_consistency(purchase: DataFrame, purchase_item: DataFrame) -> DataFrame:
    return header_item_consistency(purchase, purchase_item, "tot_qtyin", "purchase_id", "qtyin")


def purchase_scorecard(purchase: DataFrame) -> DataFrame:
    """Is the purchase table fit to be a receipt fact? All figures come from one scan."""
    ordered, received = _header_qty()
    one = active(purchase).agg(
        F.count(F.lit(1)).alias("n"),
        F.count("store_id").alias("n_store"),
        F.count("supplier_id").alias("n_supplier"),
        F.count("billdate").alias("n_billdate"),
        F.count("datein").alias("n_datein"),
        count_when(F.col("in_status") == 2).alias("n_received"),
        count_when(received > 0).alias("n_qty"),
        count_when(F.col("tot_amtin_actual") > 0).alias("n_amount"),
        count_when(ordered > 0).alias("n_ordered"),
        count_when((ordered > 0) & (ordered == received)).alias("n_full"),
    )
    c = F.col

    def present(*names: str) -> Column:
        return sum(((c(name) > 0).cast("int") for name in names), F.lit(0))

    dimensions = present("n_store", "n_supplier", "n_billdate", "n_datein")
    measures = present("n_qty", "n_amount")
    return scorecard(
        one,
        [
            ("receipt_date", c("n_datein"), c("n"), graded(rate(c("n_datein"), c("n")), 95, 80)),
            ("receipt_status", c("n_received"), c("n"), F.lit("PASS")),
            ("receipt_quantity", c("n_qty"), c("n"), F.lit("PASS")),
            ("dimensions", dimensions, F.lit(4), graded(dimensions, 3)),
            ("measures", measures, F.lit(2), graded(measures, 2)),
            ("full_receipts", c("n_full"), c("n_ordered"), graded(rate(c("n_full"), c("n_ordered")), 80)),
        ],
    )

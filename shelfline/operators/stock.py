"""Reports on the stock report and its on-order quantity (column ``qtypurchaserem``)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline import rules as L
from shelfline.functions import count_when, percent, ratio
from shelfline.operators.prefix import median_of_counts, quantile_sketches, ranked_counts, sketched_median
from shelfline.operators.profile import active, rate, scorecard, stack_rows, with_share
from shelfline.rules import RetailRules


def _on_order() -> Column:
    return F.col("qtypurchaserem")


def _per_pair(df: DataFrame, *sums: str) -> DataFrame:
    """Rows, active rows and sums of each product and store, so that distinct counts meet one row per pair."""
    return df.groupBy("product_id", "store_id").agg(
        F.count(F.lit(1)).alias("total_rows"),
        count_when(F.col("isactive") == "Y").alias("active_rows"),
        *[F.sum(c).alias(c) for c in sums],
    )


def stock_overview(report: DataFrame) -> DataFrame:
    return _per_pair(report, "qty", "qtypurchaserem").agg(
        F.coalesce(F.sum("total_rows"), F.lit(0)).alias("total_rows"),
        F.count_distinct("product_id").alias("products"),
        F.count_distinct("store_id").alias("stores"),
        F.coalesce(F.sum("active_rows"), F.lit(0)).alias("active_rows"),
        F.sum("qty").alias("total_qty"),
        F.sum(_on_order()).alias("total_on_order"),
    )


def onorder_fill(report: DataFrame) -> DataFrame:
    return (
        active(report)
        .agg(
            F.count(F.lit(1)).alias("total_rows"),
            F.count(_on_order()).alias("filled"),
            count_when(_on_order() > 0).alias("positive"),
            count_when((_on_order() == 0) | _on_order().isNull()).alias("none"),
            count_when(_on_order() < 0).alias("negative"),
        )
        .withColumn("fill_rate", percent(F.col("filled"), F.col("total_rows")))
    )


def onorder_distribution(report: DataFrame) -> DataFrame:
    """Smallest, largest, mean, exact median and sum of the positive on-order quantities, all from their counts."""
    counts = ranked_counts(active(report).filter(_on_order() > 0), "qtypurchaserem")
    value, total = F.col("v"), F.sum(F.col("v") * F.col("n"))
    return counts.agg(
        F.min(value).alias("min_qty"),
        F.max(value).alias("max_qty"),
        ratio(total, F.sum("n"), 2).alias("avg_qty"),
        F.round(median_of_counts().cast("decimal(20,4)"), 2).alias("median_qty"),
        total.alias("total_qty"),
    )


def onorder_sketches(report: DataFrame) -> DataFrame:
    """Per store the number and a mergeable quantile sketch of its positive on-order quantities."""
    return quantile_sketches(active(report).filter(_on_order() > 0), ["store_id"], "qtypurchaserem")


def onorder_median_check(report: DataFrame, sketches: DataFrame, bound: float = 0.02) -> DataFrame:
    """Per store, and for all (store_id NULL), whether the median of the sketches lies within ``bound`` of the middle rank.

    The approximate medians come from the sketches alone; the report is read once to count the rows below and up to them.
    """
    whole = sketched_median(sketches, []).select(F.lit(None).cast("long").alias("store_id"), "n", "median")
    stores = sketched_median(sketches, ["store_id"]).select(F.col("store_id").cast("long").alias("store_id"), "n", "median")
    rows = active(report).filter(_on_order() > 0).groupBy("store_id", "qtypurchaserem").agg(F.count(F.lit(1)).alias("rows"))
    both = F.array(F.col("store_id").cast("long"), F.lit(None).cast("long"))
    counted = rows.select(F.explode(both).alias("of"), "qtypurchaserem", "rows").groupBy("of", "qtypurchaserem").agg(F.sum("rows").alias("rows"))
    medians = stores.unionByName(whole)
    at = F.col("qtypurchaserem").cast("double")
    below, upto = (F.coalesce(F.sum(F.when(c, F.col("rows"))), F.lit(0)) / F.col("n") for c in (at < F.col("median"), at <= F.col("median")))
    return (
        medians.join(counted, F.col("store_id").eqNullSafe(F.col("of")))
        .groupBy("store_id", "n", "median")
        .agg(((below <= 0.5 + bound) & (upto >= 0.5 - bound)).alias("within"))
        .select("store_id", "n", "within")
    )


def onorder_bucket() -> tuple[Column, Column]:
    """Label and position of the on-order range.

    Ranges are half open at the next lower bound, so a fraction such as 10.5 stays with the integer below it.
    """
    value = F.col("qtypurchaserem")
    none = value.isNull() | (value == 0)
    label, position = F.when(none, L.ONORDER_NONE).when(value < 0, L.ONORDER_NEGATIVE), F.when(none, 0)
    last = len(L.ONORDER_RANGES)
    position = position.when(value < 0, last + 1)
    for index, (name, _low, high) in enumerate(L.ONORDER_RANGES, start=1):
        if high is None:
            label, position = label.otherwise(name), position.otherwise(index)
        else:
            label, position = label.when(value < high + 1, name), position.when(value < high + 1, index)
    return label, position


def onorder_segments(report: DataFrame) -> DataFrame:
    label, position = onorder_bucket()
    grouped = (
        active(report)
        .groupBy(label.alias("segment"), position.alias("segment_no"))
        .agg(F.count(F.lit(1)).alias("cnt"), F.sum(_on_order()).alias("on_order_qty"))
    )
    return with_share(grouped, "cnt").orderBy("segment_no")


def report_store_type(code: Column, rules: RetailRules = RetailRules()) -> Column:
    return (
        F.when(code == rules.main_warehouse, L.STORE_MAIN)
        .when(code.startswith(rules.ecommerce_prefix), L.STORE_ECOMMERCE)
        .when(code.startswith(rules.shop_prefix), L.STORE_SHOP)
        .otherwise(L.OTHER)
    )


def _store_names(store: DataFrame) -> DataFrame:
    return store.select(
        F.col("id").alias("store_id"), F.col("code").alias("store_code"), F.col("name").alias("store_name")
    )


def _product_names(product: DataFrame) -> DataFrame:
    return product.select(
        F.col("id").alias("product_id"), F.col("name").alias("product_code"), F.col("value").alias("product_name")
    )


def onorder_by_store(
    report: DataFrame, store: DataFrame, limit: int = 15, rules: RetailRules = RetailRules()
) -> DataFrame:
    """Top stores by on-order quantity; totals per store id come first, names are joined on those."""
    per_store = (
        active(report)
        .groupBy("store_id")
        .agg(
            F.count("product_id").alias("sku_count"),
            F.sum("qty").alias("stock_qty"),
            F.sum(_on_order()).alias("on_order_qty"),
            count_when(_on_order() > 0).alias("sku_with_on_order"),
        )
    )
    measures = ["sku_count", "stock_qty", "on_order_qty", "sku_with_on_order"]
    return (
        per_store.join(_store_names(store), "store_id", "left")
        .groupBy("store_code", "store_name")
        .agg(*[F.sum(m).alias(m) for m in measures])
        .select("store_code", "store_name", report_store_type(F.col("store_code"), rules).alias("store_type"), *measures)
        .orderBy(F.col("on_order_qty").desc_nulls_last(), F.col("store_code").asc_nulls_last())
        .limit(limit)
    )


def _top_onorder(report: DataFrame, limit: int) -> DataFrame:
    """The rows with the largest on-order quantity. Names are looked up afterwards, for these few rows only."""
    return (
        active(report)
        .filter(_on_order() > 0)
        .orderBy(_on_order().desc(), F.col("product_id").asc(), F.col("store_id").asc())
        .limit(limit)
    )


def onorder_top_products(report: DataFrame, product: DataFrame, store: DataFrame, limit: int = 20) -> DataFrame:
    return (
        _top_onorder(report, limit)
        .join(_product_names(product), "product_id", "left")
        .join(_store_names(store), "store_id", "left")
        .select(
            "product_code", "product_name", _on_order().alias("on_order_qty"), F.col("qty").alias("stock_qty"),
            "store_code", "store_name",
        )
        .orderBy(F.col("on_order_qty").desc(), "product_code", "store_code")
    )


def onorder_sample(report: DataFrame, product: DataFrame, store: DataFrame, limit: int = 10) -> DataFrame:
    return (
        _top_onorder(report, limit)
        .join(_product_names(product), "product_id", "left")
        .join(_store_names(store), "store_id", "left")
        .select(
            "product_id", "product_code", "product_name", "store_id", "store_code", F.col("qty").alias("stock_qty"),
            _on_order().alias("on_order_qty"), "isactive",
        )
        .orderBy(F.col("on_order_qty").desc(), "product_id", "store_id")
    )


def stock_source_compare(sources: Mapping[str, DataFrame]) -> DataFrame:
    """One row per stock source: active rows, products, stores, stock."""
    return stack_rows(
        [
            _per_pair(active(df), "qty")
            .agg(
                F.coalesce(F.sum("total_rows"), F.lit(0)).alias("total_rows"),
                F.count_distinct("product_id").alias("products"),
                F.count_distinct("store_id").alias("stores"),
                F.sum("qty").cast("decimal(28,4)").alias("total_qty"),
            )
            .select(F.lit(name).alias("table_name"), "*")
            for name, df in sources.items()
        ]
    )


def stock_grain_match(left: DataFrame, right: DataFrame) -> DataFrame:
    """Compare the distinct (product, store) pairs of two sources: both, left only, right only.

    A full outer join would shuffle and sort both sides; tagging the rows and grouping once finds the same classes with
    one shuffle and partial aggregation. Pairs with a missing key never match, so they keep their side in the key.
    """

    def tagged(df: DataFrame, side: str) -> DataFrame:
        open_key = F.col("product_id").isNull() | F.col("store_id").isNull()
        return active(df).select(
            "product_id", "store_id", F.when(open_key, side).alias("unmatched_side"),
            F.lit(side == "left").alias("is_left"), F.lit(side == "right").alias("is_right"),
        )

    pairs = (
        tagged(left, "left")
        .unionByName(tagged(right, "right"))
        .groupBy("product_id", "store_id", "unmatched_side")
        .agg(F.max("is_left").alias("in_left"), F.max("is_right").alias("in_right"))
    )
    known = F.col("product_id").isNotNull()
    return pairs.agg(
        F.count(F.lit(1)).alias("total_pairs"),
        count_when(known & F.col("in_left") & F.col("in_right")).alias("in_both"),
        count_when(known & F.col("in_left") & ~F.col("in_right")).alias("left_only"),
        count_when(known & ~F.col("in_left") & F.col("in_right")).alias("right_only"),
    )


def warehouse_onorder(
    report: DataFrame, product: DataFrame, store: DataFrame, rules: RetailRules = RetailRules()
) -> DataFrame:
    """Products with on-order quantity at the main warehouse, largest first."""
    main = store.filter(F.col("code") == rules.main_warehouse).select(F.col("id").alias("store_id"))
    return (
        active(report)
        .join(main, "store_id", "left_semi")
        .groupBy("product_id")
        .agg(F.sum("qty").alias("stock_qty"), F.sum(_on_order()).alias("on_order_qty"))
        .filter(F.col("on_order_qty") > 0)
        .join(_product_names(product), "product_id", "left")
        .select("product_id", "product_code", "product_name", "stock_qty", "on_order_qty")
        .orderBy(F.col("on_order_qty").desc(), "product_id")
    )


def stock_with_onorder(
    storage: DataFrame, report: DataFrame, product: DataFrame, store: DataFrame, rules: RetailRules = RetailRules()
) -> DataFrame:
    """Stock rows of the main warehouse with on-order quantity and availability including it.

    Only active report rows may match; stock rows without a match stay, with 0 on order, and come last. The SKU ends the
    sort key, so the rows of one product can be split.
    """
    main = store.filter(F.col("code") == rules.main_warehouse).select(
        F.col("id").alias("store_id"), F.col("code").alias("store_code")
    )
    incoming = active(report).select("product_id", "store_id", _on_order().alias("on_order"))
    at_main = incoming.join(main.select("store_id"), "store_id", "left_semi")
    on_order = F.coalesce("on_order", F.lit(0))
    row_key = [c for c in ("sku_id",) if c in storage.columns]
    return (
        active(storage)
        .join(main, "store_id")
        .join(at_main, ["product_id", "store_id"], "left")
        .join(_product_names(product), "product_id", "left")
        .select(
            "product_id", "product_code", "store_id", "store_code", F.col("qty").alias("stock_qty"),
            on_order.alias("on_order_qty"), (F.col("qty") + on_order).alias("available_qty"), "on_order", *row_key,
        )
        .orderBy(F.col("on_order").desc_nulls_last(), "product_id", *row_key)
        .drop("on_order", *row_key)
    )


def onorder_scalar_subquery(
    report: DataFrame, store: DataFrame, rules: RetailRules = RetailRules()
) -> DataFrame:
    """On-order per product at the store whose code is the main warehouse, with the id from a scalar subquery."""
    main_id = store.filter(F.col("code") == rules.main_warehouse).select("id").scalar()
    return (
        active(report)
        .filter(F.col("store_id") == main_id)
        .groupBy("product_id")
        .agg(F.sum(_on_order()).alias("on_order_qty"))
    )


def stock_scorecard(report: DataFrame, column: str = "qtypurchaserem") -> DataFrame:
    """Is the report a usable on-order source?"""
    present = column in report.columns
    value = F.col(column) if present else F.lit(None).cast("long")
    one = active(report).agg(
        F.count(F.lit(1)).alias("n"), count_when(value > 0).alias("n_positive"), F.sum(value).alias("q_total")
    )
    c, passed = F.col, F.lit("PASS")
    return scorecard(
        one,
        [
            ("column_present", F.lit(int(present)), F.lit(1), F.lit("PASS" if present else "FAIL")),
            ("active_rows", c("n"), None, passed),
            ("rows_with_on_order", c("n_positive"), c("n"), passed),
            ("on_order_total", c("q_total"), None, passed),
        ],
    )


def source_candidates(tables: Mapping[str, DataFrame], column: str = "qtypurchaserem") -> DataFrame:
    """For each candidate table: rows, whether it has the column, and how far the column is filled."""
    rows = []
    for name, df in tables.items():
        present = column in df.columns
        value = F.col(column).cast("decimal(28,4)") if present else F.lit(None).cast("decimal(28,4)")
        rows.append(
            df.agg(
                F.count(F.lit(1)).alias("total_rows"),
                F.count(value).alias("filled"),
                count_when(value > 0).alias("positive"),
                F.sum(value).alias("total_qty"),
            ).select(F.lit(name).alias("table_name"), "total_rows", F.lit(present).alias("has_column"), *[
                (F.col(c) if present else F.lit(None).cast("long")).alias(c) for c in ("filled", "positive")
            ], "total_qty")
        )
    return stack_rows(rows)

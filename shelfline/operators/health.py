"""Inventory-health mart: one row per product x SKU with stock, sales, turnover, status, suggestion and grade."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline import rules as L
from shelfline.functions import as_date, count_when, date_key, money, percent, position_in, ratio, sum_when
from shelfline.operators.prefix import sliced_totals
from shelfline.rules import RetailRules

EXPORT_COLUMNS = (
    "snapshot_date", "product_id", "product_code", "product_name", "category_id", "category_name",
    "total_qty", "warehouse_qty", "cloud_qty", "purchase_rem_qty",
    "sales_qty_30d", "sales_qty_7d", "return_qty_30d", "daily_avg_sales", "daily_avg_sales_7d", "sales_velocity",
    "turnover_days", "inventory_status", "sku_grade", "suggest_qty", "etl_time",
)


def stock_totals(inventory: DataFrame, store: DataFrame, as_of, rules: RetailRules = RetailRules()) -> DataFrame:
    """Total, main-warehouse, cloud and on-order quantity per product x SKU on one snapshot day."""
    scoped = store.filter(rules.stock_scope(F.col("store_code"), F.col("is_cloud_store"))).select(
        "store_id",
        (F.col("store_code") == rules.main_warehouse).alias("at_main"),
        (F.col("is_cloud_store") == "Y").alias("at_cloud"),
    )
    return (
        inventory.filter((F.col("date_id") == date_key(as_of)) & F.col("m_productalias_id").isNotNull())
        .select("store_id", "product_id", F.col("m_productalias_id").alias("sku_id"), "qty", "qtypurchaserem")
        .join(scoped, "store_id")
        .groupBy("product_id", "sku_id")
        .agg(
            F.coalesce(F.sum("qty"), F.lit(0)).alias("total_qty"),
            sum_when(F.col("at_main"), F.col("qty")).alias("warehouse_qty"),
            sum_when(F.col("at_cloud"), F.col("qty")).alias("cloud_qty"),
            F.sum(F.coalesce("qtypurchaserem", F.lit(0))).alias("purchase_rem_qty"),
        )
    )


def sales_totals(sales: DataFrame, store: DataFrame, as_of, rules: RetailRules = RetailRules()) -> DataFrame:
    """Sales and returns per product x SKU in the two look-back windows.

    Both windows start N days before ``as_of`` and include it, so they cover N + 1 calendar days.
    """
    day = as_date(as_of)
    long_from = date_key(day - timedelta(days=rules.long_window_days))
    short_from = date_key(day - timedelta(days=rules.short_window_days))
    scoped = store.filter(rules.sales_scope(F.col("store_code"), F.col("is_cloud_store"))).select("store_id")
    return (
        sales.filter(F.col("date_id").between(long_from, date_key(day)) & F.col("m_productalias_id").isNotNull())
        .join(scoped, "store_id", "left_semi")
        .groupBy("product_id", F.col("m_productalias_id").alias("sku_id"))
        .agg(
            F.sum("sales_qty").alias("sales_qty_30d"),
            F.sum("sales_amount").alias("sales_amt_30d"),
            sum_when(F.col("date_id") >= short_from, F.col("sales_qty")).alias("sales_qty_7d"),
            F.sum("return_qty").alias("return_qty_30d"),
            F.sum("return_amount").alias("return_amount_30d"),
        )
    )


def window_totals(sales: DataFrame, store: DataFrame, as_of, rules: RetailRules = RetailRules()) -> DataFrame:
    """``sales_totals`` with the number of fact rows behind each SKU, in the form that ``moved_totals`` goes on from."""
    day = as_date(as_of) - timedelta(days=rules.long_window_days + 1)
    none = sales_totals(sales.limit(0), store, day, rules).withColumn("fact_rows", F.lit(0).cast("long"))
    inside = F.col("date_id").between(date_key(day + timedelta(days=1)), date_key(as_of))
    return moved_totals(none, sales.filter(inside), store, day, as_of, rules)


def moved_totals(
    stored: DataFrame, sales: DataFrame, store: DataFrame, before, as_of, rules: RetailRules = RetailRules(),
    replaced: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """The stored ``window_totals`` of the day ``before``, moved to a later ``as_of``.

    Only the days that enter or leave one of the windows are read and added or taken off; a window longer than the move
    keeps the rest. ``replaced`` = (old rows, new rows) brings in facts up to ``before`` that were computed again since. A
    SKU whose last fact row leaves is dropped.
    """
    old, new = as_date(before), as_date(as_of)
    if new < old:
        raise ValueError(f"as_of {new} lies before {old}")
    scoped = store.filter(rules.sales_scope(F.col("store_code"), F.col("is_cloud_store"))).select("store_id")
    date_id = F.col("date_id")

    def inside(day: date, days: int) -> Column:
        return date_id.between(date_key(day - timedelta(days=days)), date_key(day)).cast("int")

    def signed(facts: DataFrame, long_sign: Column, short_sign: Column) -> DataFrame:
        named = facts.filter(((long_sign != 0) | (short_sign != 0)) & F.col("m_productalias_id").isNotNull())
        measures = {"sales_qty_30d": "sales_qty", "sales_amt_30d": "sales_amount", "return_qty_30d": "return_qty", "return_amount_30d": "return_amount"}
        return named.join(scoped, "store_id", "left_semi").select(
            "product_id", F.col("m_productalias_id").alias("sku_id"),
            *[(F.col(c) * long_sign).alias(name) for name, c in measures.items()],
            (F.col("sales_qty") * short_sign).alias("sales_qty_7d"),
            long_sign.cast("long").alias("fact_rows"),
        )

    windows = rules.long_window_days, rules.short_window_days
    moves = [inside(new, n) - inside(old, n) for n in windows]
    first = date_key(old - timedelta(days=max(windows)))
    parts = [stored, signed(sales.filter(date_id.between(first, date_key(new))), *moves)]
    if replaced is not None:  # what the stored totals hold of these days, in the window of `before`
        was, now = [inside(old, n) for n in windows], replaced
        parts += [signed(now[0], *[-w for w in was]), signed(now[1], *was)]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    totals = ["sales_qty_30d", "sales_amt_30d", "sales_qty_7d", "return_qty_30d", "return_amount_30d", "fact_rows"]
    return every.groupBy("product_id", "sku_id").agg(*[F.sum(c).alias(c) for c in totals]).filter(F.col("fact_rows") > 0)


def turnover_metrics(df: DataFrame, rules: RetailRules = RetailRules()) -> DataFrame:
    """Daily averages, sales velocity (NULL without sales) and turnover days (sentinel without sales)."""
    long_days, short_days = rules.long_window_days, rules.short_window_days
    sold, sold_short, stock = F.col("sales_qty_30d"), F.col("sales_qty_7d"), F.col("total_qty")
    return df.withColumns(
        {
            "daily_avg_sales": ratio(sold, F.lit(long_days), 2),
            "daily_avg_sales_7d": ratio(sold_short, F.lit(short_days), 2),
            "sales_velocity": ratio(sold_short * long_days, sold * short_days, 2),
            "turnover_days": F.coalesce(ratio(stock * long_days, sold, 1), F.lit(rules.turnover_sentinel)).cast(
                "decimal(20,1)"
            ),
        }
    )


def _turnover_below(stock: Column, sold: Column, days: int, window: int) -> Column:
    """``stock / (sold / window) < days`` in exact integers, for any sign of ``sold`` other than 0."""
    return F.signum(sold.cast("double")).cast("long") * stock * window < F.abs(sold) * days


def stock_status(df: DataFrame, rules: RetailRules = RetailRules()) -> DataFrame:
    """Inventory status and its priority 1 (most urgent) to 6, from the unrounded turnover."""
    stock, sold, window = F.col("total_qty"), F.col("sales_qty_30d"), rules.long_window_days
    above_target = _turnover_below(-stock, sold, -rules.target_days, window)
    status = (
        F.when((stock > 0) & (sold == 0), L.STATUS_DEAD)
        .when((stock == 0) & (sold == 0), L.STATUS_STOPPED)
        .when(sold == 0, L.STATUS_OVERSTOCK)  # negative stock without sales has no turnover and falls through
        .when(_turnover_below(stock, sold, rules.urgent_days, window), L.STATUS_URGENT)
        .when(_turnover_below(stock, sold, rules.replenish_days, window), L.STATUS_REPLENISH)
        .when(~above_target, L.STATUS_NORMAL)
        .otherwise(L.STATUS_OVERSTOCK)
    )
    return df.withColumns(
        {"inventory_status": status, "status_priority": position_in(status, L.STATUS_ORDER).cast("int")}
    )


def suggest_qty(df: DataFrame, rules: RetailRules = RetailRules()) -> DataFrame:
    """Suggested replenishment up to the target days, less returns and on-order; negative means surplus."""
    stock, sold = F.col("total_qty"), F.col("sales_qty_30d")
    wanted = F.round(sold * rules.target_days / F.lit(rules.long_window_days), 0).cast("long")
    needed = wanted - stock - F.col("return_qty_30d") - F.col("purchase_rem_qty")
    short = _turnover_below(stock, sold, rules.target_days, rules.long_window_days)
    return df.withColumn(
        "suggest_qty", F.when(sold == 0, F.lit(0)).when(short, needed).otherwise(F.lit(0)).cast("long")
    )


def health_measures(
    inventory: DataFrame, sales: DataFrame, store: DataFrame, as_of, rules: RetailRules = RetailRules()
) -> DataFrame:
    """Keys and measures of all products in stock scope, before names and grades.

    Stock and sales are each reduced to product x SKU first, so their join needs no further shuffle and meets every key
    once.
    """
    stock = stock_totals(inventory, store, as_of, rules)
    sold = sales_totals(sales, store, as_of, rules)
    joined = stock.join(sold, ["product_id", "sku_id"], "left")

    def whole(name: str) -> Column:
        return F.coalesce(name, F.lit(0)).cast("long").alias(name)

    base = joined.select(
        "product_id", "sku_id",
        whole("total_qty"), whole("warehouse_qty"), whole("cloud_qty"), whole("purchase_rem_qty"),
        whole("sales_qty_30d"),
        money(F.col("sales_amt_30d")).alias("sales_amt_30d"),
        whole("sales_qty_7d"), whole("return_qty_30d"),
        money(F.col("return_amount_30d")).alias("return_amount_30d"),
    )
    return suggest_qty(stock_status(turnover_metrics(base, rules), rules), rules)


def with_names(measures: DataFrame, product: DataFrame, sku: DataFrame, as_of) -> DataFrame:
    """Rows of main products with the snapshot day, product and SKU names before the measures."""
    names = [
        "product_code", "product_name", "category_id", "category_name", "property_id", "property_name", "series_id", "series_name",
        "price_list",
    ]
    products = product.filter(F.col("is_main_product") == "Y").select("product_id", *names)
    skus = sku.select("sku_id", "sku_barcode", F.col("sku_color").alias("color"), F.col("sku_size").alias("size"))
    return measures.join(products, "product_id").join(skus, "sku_id", "left").select(
        F.lit(as_date(as_of)).alias("snapshot_date"), "product_id", "sku_id", "sku_barcode", "color", "size", *names,
        *[c for c in measures.columns if c not in ("product_id", "sku_id")],
    )


def inventory_health(
    inventory: DataFrame, sales: DataFrame, product: DataFrame, sku: DataFrame, store: DataFrame, as_of,
    rules: RetailRules = RetailRules(),
) -> DataFrame:
    """Health rows of main products in stock scope, before grading; names are joined on the reduced set."""
    return with_names(health_measures(inventory, sales, store, as_of, rules), product, sku, as_of)


def sabc_grade(
    df: DataFrame, amount: str = "sales_amt_30d", key: tuple[str, ...] = ("sku_id", "product_id"),
    rules: RetailRules = RetailRules(), slices: int | None = None,
) -> DataFrame:
    """Rank, share, cumulative share and grade S/A/B/C of every row by descending amount.

    S looks at the cumulative share *before* the row, A and B at the share *including* it. Rows without an amount are C.
    """
    ready = df.withColumn(amount, F.coalesce(amount, F.lit(0)))
    order = [-F.col(amount), *[c for k in key for c in (F.col(k).isNull(), F.col(k))]]
    ranked = sliced_totals(ready, order, amount, "_cum", "sales_rank", "_total", slices)
    s_cut, a_cut, b_cut = (F.lit(cut) for cut in rules.grade_cuts)
    value, cum, total = F.col(amount), F.col("_cum"), F.col("_total")
    grade = (
        F.when((total == 0) | (value == 0), "C")
        .when(cum - value < total * s_cut, "S")
        .when(cum <= total * a_cut, "A")
        .when(cum <= total * b_cut, "B")
        .otherwise("C")
    )
    return ranked.withColumns(
        {"sales_ratio": percent(value, total), "cumulative_ratio": percent(cum, total), "sku_grade": grade}
    ).drop("_cum", "_total")


def sales_trend(df: DataFrame, rules: RetailRules = RetailRules()) -> DataFrame:
    """Trend label from the velocity as stored, that is rounded to two digits."""
    up, stable, cooling = (F.lit(cut) for cut in rules.trend_cuts)
    velocity = F.col("sales_velocity")
    return df.withColumn(
        "sales_trend",
        F.when(F.col("sales_qty_30d") == 0, L.TREND_NONE)
        .when(velocity >= up, L.TREND_UP)
        .when(velocity >= stable, L.TREND_STABLE)
        .when(velocity >= cooling, L.TREND_COOLING)
        .otherwise(L.TREND_DOWN),
    )


def graded_health(
    inventory: DataFrame, sales: DataFrame, product: DataFrame, sku: DataFrame, store: DataFrame, as_of,
    rules: RetailRules = RetailRules(),
) -> DataFrame:
    """The finished mart rows: health, grade and trend in one pass. Only keys and measures are ranked; names come after."""
    main = product.filter(F.col("is_main_product") == "Y").select("product_id")
    measures = health_measures(inventory, sales, store, as_of, rules).join(main, "product_id", "left_semi")
    graded = sabc_grade(measures, rules=rules)
    return with_names(sales_trend(graded, rules), product, sku, as_of)


def status_summary(health: DataFrame) -> DataFrame:
    """SKUs and stock per status, in business order."""
    return (
        health.groupBy("inventory_status")
        .agg(F.count(F.lit(1)).alias("sku_count"), F.sum("total_qty").alias("total_qty"))
        .orderBy(position_in(F.col("inventory_status"), L.STATUS_ORDER))
    )


def grade_summary(health: DataFrame) -> DataFrame:
    """SKUs and sold quantity per grade, in order S, A, B, C."""
    return (
        health.groupBy("sku_grade")
        .agg(F.count(F.lit(1)).alias("sku_count"), F.sum("sales_qty_30d").alias("sales_qty"))
        .orderBy(position_in(F.col("sku_grade"), L.GRADE_ORDER))
    )


def replenish_summary(health: DataFrame) -> DataFrame:
    """On-order totals and positive, negative and net suggestion as one row."""
    suggest = F.col("suggest_qty")
    return health.agg(
        count_when(F.col("purchase_rem_qty") > 0).alias("sku_with_rem"),
        F.sum("purchase_rem_qty").alias("total_rem_qty"),
        sum_when(suggest > 0, suggest).alias("total_positive_suggest"),
        sum_when(suggest < 0, suggest).alias("total_negative_suggest"),
        F.sum(suggest).alias("total_suggest_qty"),
        count_when(suggest < 0).alias("sku_with_negative"),
    )


def export_health(health: DataFrame, as_of: date | str | int) -> DataFrame:
    """The published column selection of one snapshot day; ``etl_time`` appears when the table carries it."""
    day = health.filter(F.col("snapshot_date") == F.lit(as_date(as_of)))
    return day.select(*[c for c in EXPORT_COLUMNS if c in health.columns])


def replenish_product(
    retail: DataFrame, item: DataFrame, storage: DataFrame, stock_report: DataFrame, store: DataFrame,
    product: DataFrame, as_of, top: int = 20, rules: RetailRules = RetailRules(),
) -> DataFrame:
    """Top suggestions at product grain, straight from the sources; never below 0.

    Differs from the mart: every category counts, on-order comes from the main warehouse only and sales have no SKU
    filter. The active-product filter and the name join run on per-product totals.
    """
    day = as_date(as_of)
    first = date_key(day - timedelta(days=rules.long_window_days))
    code, cloud = F.col("code"), F.col("is_cloud")

    def stores(condition: Column) -> DataFrame:
        return store.filter(condition).select(F.col("id").alias("store_id"))

    headers = (
        retail.filter(
            (F.col("isactive") == "Y")
            & (F.col("status") == rules.submitted_status)
            & F.col("billdate").between(first, date_key(day))
        )
        .join(stores(rules.sales_scope(code, cloud)), "store_id", "left_semi")
        .select(F.col("id").alias("retail_id"), F.col("tot_amt_actual").alias("header_amount"))
    )
    sold = (
        item.select("retail_id", "product_id", "qty")
        .join(headers, "retail_id")
        .groupBy("product_id")
        .agg(
            sum_when(F.col("header_amount") > 0, F.col("qty")).alias("sold"),
            sum_when(F.col("header_amount") < 0, F.abs("qty")).alias("returned"),
        )
        .filter(F.col("sold") > 0)
    )
    stock = (
        storage.filter(F.col("isactive") == "Y")
        .join(stores(rules.stock_scope(code, cloud)), "store_id", "left_semi")
        .groupBy("product_id")
        .agg(F.sum("qty").alias("stock"))
    )
    on_order = (
        stock_report.filter(F.col("isactive") == "Y")
        .join(stores(code == rules.main_warehouse), "store_id", "left_semi")
        .groupBy("product_id")
        .agg(F.sum("qtypurchaserem").alias("on_order"))
    )
    names = product.filter(F.col("isactive") == "Y").select(
        F.col("id").alias("product_id"), F.col("name").alias("product_code"), F.col("value").alias("product_name")
    )
    joined = (
        sold.join(stock, "product_id", "left")
        .join(on_order, "product_id", "left")
        .join(names, "product_id")
        .select(
            "product_id", "product_code", "product_name",
            F.coalesce("stock", F.lit(0)).cast("decimal(18,4)").alias("stock"),
            F.col("sold").cast("decimal(18,4)").alias("sold"),
            F.coalesce("returned", F.lit(0)).cast("decimal(18,4)").alias("returned"),
            F.coalesce("on_order", F.lit(0)).cast("decimal(18,4)").alias("on_order"),
        )
    )
    wanted = F.col("sold") * rules.target_days / F.lit(rules.long_window_days)
    need = F.round(wanted - F.col("stock") - F.col("returned") - F.col("on_order"), 0)
    return (
        joined.select(
            "product_code",
            "product_name",
            F.col("stock").cast("double").alias("stock_qty"),
            ratio(F.col("sold"), F.lit(rules.long_window_days), 4).alias("daily_avg_sales"),
            ratio(F.col("stock") * rules.long_window_days, F.col("sold"), 1).alias("turnover_days"),
            F.col("returned").cast("double").alias("return_qty_30d"),
            F.col("on_order").cast("double").alias("purchase_rem_qty"),
            F.greatest(F.lit(0), need.cast("long")).cast("long").alias("suggest_qty"),
        )
        .orderBy(F.col("suggest_qty").desc_nulls_last(), "product_code")
        .limit(top)
    )

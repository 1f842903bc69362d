"""Daily fact builders: sales and stock at day x store x product x SKU."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions import as_date, date_key, money, quantity, sum_when
from shelfline.operators.dims import calendar_days
from shelfline.rules import RetailRules

SALES_KEY = ["date_id", "store_id", "product_id", "m_productalias_id"]
STOCK_KEY = ["store_id", "product_id", "m_productalias_id"]


def _main_products(product: DataFrame, rules: RetailRules) -> DataFrame:
    return product.filter(rules.is_main_category(F.col("m_dim4_id"))).select(F.col("id").alias("product_id"))


def _scoped_stores(store: DataFrame, scope) -> DataFrame:
    return store.filter(scope(F.col("code"), F.col("is_cloud"))).select(
        F.col("id").alias("store_id"),
        F.coalesce("code", F.lit("")).alias("store_code"),
        F.coalesce("is_cloud", F.lit("N")).alias("is_cloud_store"),
    )


def _headers(retail: DataFrame, stores: DataFrame, lo, hi, rules: RetailRules) -> DataFrame:
    """Submitted receipts of the stores with a bill date in [lo, hi] and the sign of their amount."""
    return (
        retail.filter(
            (F.col("isactive") == "Y")
            & (F.col("status") == rules.submitted_status)
            & F.col("billdate").between(date_key(lo), date_key(hi))
        )
        .join(stores.select("store_id"), "store_id", "left_semi")
        .select(
            F.col("id").alias("retail_id"),
            F.col("billdate").alias("date_id"),
            "store_id",
            F.signum(F.col("tot_amt_actual").cast("double")).alias("sign"),
        )
    )


def sale_orders(
    retail: DataFrame, item: DataFrame, store: DataFrame, product: DataFrame,
    lo: date | str | int, hi: date | str | int, rules: RetailRules = RetailRules(),
) -> DataFrame:
    """The products of every sale order behind ``sales_daily``: distinct (date_id, store_code, product_id, retail_id).

    An order has one day and one store, so its counts add up over both, but not over products, SKUs or categories.
    """
    stores = _scoped_stores(store, rules.sales_scope)
    sales = _headers(retail, stores, lo, hi, rules).filter(F.col("sign") > 0)
    lines = item.filter(F.col("sku_id").isNotNull()).select("retail_id", "product_id")
    return (
        lines.join(_main_products(product, rules), "product_id", "left_semi")
        .join(sales, "retail_id")
        .join(stores, "store_id")
        .select(F.col("date_id").cast("int").alias("date_id"), "store_code", "product_id", "retail_id")
        .distinct()
    )


def sales_daily(
    retail: DataFrame, item: DataFrame, store: DataFrame, product: DataFrame,
    lo: date | str | int, hi: date | str | int, rules: RetailRules = RetailRules(),
) -> DataFrame:
    """Sales and returns per day x store x product x SKU for bill dates in [lo, hi].

    The sign of the *header* amount makes a line a sale or a return; quantities and amounts come from the line.

    Headers are cut to the date range and the store scope before they meet the lines, so Spark's runtime bloom filter
    can drop foreign lines ahead of the shuffle. The product filter is a semi join on the aggregate: Catalyst pushes it
    below the aggregation when the products can be broadcast, and otherwise it only sees aggregated rows.

    Orders are counted by a distinct aggregate whose first shuffle includes the order id: rows of a hot SKU spread over
    the orders. Grouping by order first would save a shuffle, but it would pin the join's partitioning to the order id
    and so forbid AQE to split an order that holds a large share of all lines.
    """
    stores = _scoped_stores(store, rules.sales_scope)
    headers = _headers(retail, stores, lo, hi, rules)
    lines = item.filter(F.col("sku_id").isNotNull()).select(
        "retail_id",
        "product_id",
        F.col("sku_id").alias("m_productalias_id"),
        "qty",
        F.col("tot_amt_actual").alias("amount"),
        F.col("tot_amt_list").alias("amount_list"),
    )
    sale, back = F.col("sign") > 0, F.col("sign") < 0
    grouped = (
        lines.join(headers, "retail_id")
        .groupBy(*SALES_KEY)
        .agg(
            sum_when(sale, F.col("qty")).alias("sales_qty"),
            sum_when(sale, F.col("amount")).alias("sales_amount"),
            sum_when(sale, F.col("amount_list")).alias("sales_amount_list"),
            sum_when(back, F.abs("qty")).alias("return_qty"),
            sum_when(back, F.abs("amount")).alias("return_amount"),
            F.count_distinct(F.when(sale, F.col("retail_id"))).alias("order_count"),
        )
        .join(_main_products(product, rules), "product_id", "left_semi")
    )
    return grouped.join(stores, "store_id").select(
        F.col("date_id").cast("int").alias("date_id"),
        F.col("store_id").cast("long").alias("store_id"),
        "store_code",
        "is_cloud_store",
        F.col("product_id").cast("long").alias("product_id"),
        F.col("m_productalias_id").cast("long").alias("m_productalias_id"),
        quantity(F.col("sales_qty")).alias("sales_qty"),
        money(F.col("sales_amount")).alias("sales_amount"),
        money(F.col("sales_amount_list")).alias("sales_amount_list"),
        quantity(F.col("return_qty")).alias("return_qty"),
        money(F.col("return_amount")).alias("return_amount"),
        "order_count",
    )


def day_prints(
    retail: DataFrame, item: DataFrame, store: DataFrame, product: DataFrame,
    lo: date | str | int, hi: date | str | int, rules: RetailRules = RetailRules(),
) -> DataFrame:
    """What the source lines of each day in [lo, hi] are: (date_id, source_lines, print).

    The print is the sum of a hash of everything that ``sales_daily`` takes from a line, its header and its store. It does
    not depend on the order of rows, and a line that comes, goes or changes moves it. One row per day leaves each task.
    """
    stores = _scoped_stores(store, rules.sales_scope)
    lines = item.filter(F.col("sku_id").isNotNull()).select(
        "retail_id", "product_id", "sku_id", "qty", "tot_amt_actual", "tot_amt_list"
    )
    joined = (
        lines.join(_main_products(product, rules), "product_id", "left_semi")
        .join(_headers(retail, stores, lo, hi, rules), "retail_id")
        .join(stores, "store_id")
    )
    taken = [
        "retail_id", "store_id", "store_code", "is_cloud_store", "sign", "product_id", "sku_id", "qty", "tot_amt_actual",
        "tot_amt_list",
    ]
    # NULL does not move xxhash64, so each column goes with its own sign of absence.
    marked = [x for c in taken for x in (F.col(c), F.col(c).isNull())]
    return joined.groupBy(F.col("date_id").cast("int").alias("date_id")).agg(
        F.count(F.lit(1)).alias("source_lines"),
        F.sum(F.xxhash64(*marked).cast("decimal(38,0)")).alias("print"),
    )


def with_net(sales: DataFrame) -> DataFrame:
    """Adds ``net_qty`` and ``net_amount`` (sales minus returns)."""
    return sales.withColumn("net_qty", F.col("sales_qty") - F.col("return_qty")).withColumn(
        "net_amount", (F.col("sales_amount") - F.col("return_amount")).cast("decimal(18,2)")
    )


def inventory_daily(
    storage: DataFrame, store: DataFrame, product: DataFrame, as_of: date | str | int,
    rules: RetailRules = RetailRules(),
) -> DataFrame:
    """Stock snapshot of one day per store x product x SKU; repeated source rows are merged, zero stock is kept.

    Both filters are semi joins on grouping keys, which Catalyst moves below the aggregation when they are small.
    """
    stores = _scoped_stores(store, rules.stock_scope)
    grouped = (
        storage.filter((F.col("isactive") == "Y") & F.col("sku_id").isNotNull())
        .withColumnRenamed("sku_id", "m_productalias_id")
        .groupBy(*STOCK_KEY)
        .agg(F.sum("qty").alias("qty"), F.sum(F.coalesce("qtypurchaserem", F.lit(0))).alias("qtypurchaserem"))
        .join(stores.select("store_id"), "store_id", "left_semi")
        .join(_main_products(product, rules), "product_id", "left_semi")
    )
    return grouped.join(stores, "store_id").select(
        F.lit(date_key(as_of)).alias("date_id"),
        F.col("store_id").cast("long").alias("store_id"),
        "store_code",
        "is_cloud_store",
        F.col("product_id").cast("long").alias("product_id"),
        F.col("m_productalias_id").cast("long").alias("m_productalias_id"),
        quantity(F.col("qty")).alias("qty"),
        quantity(F.col("qty")).alias("qty_valid"),
        F.lit(0).cast("long").alias("qty_occupy"),
        quantity(F.col("qtypurchaserem")).alias("qtypurchaserem"),
    )


def missing_dates(sales: DataFrame, lo: date | str | int, hi: date | str | int) -> DataFrame:
    """Days of [lo, hi] without a single sales row."""
    present = sales.select("date_id").filter(F.col("date_id").between(date_key(lo), date_key(hi))).distinct()
    days = calendar_days(sales.sparkSession, lo, hi)
    expected = days.select(F.date_format("date_value", "yyyyMMdd").cast("int").alias("date_id"), "date_value")
    return expected.join(present, "date_id", "left_anti").orderBy("date_id")


def sales_coverage(sales: DataFrame, lo: date | str | int, hi: date | str | int) -> DataFrame:
    """Days present and missing in [lo, hi] and whether the range has to be loaded again."""
    in_range = F.col("date_id").between(date_key(lo), date_key(hi))
    days = (as_date(hi) - as_date(lo)).days + 1
    return (
        sales.filter(in_range)
        .agg(F.count_distinct("date_id").alias("day_cnt"))
        .select(
            F.lit(date_key(lo)).alias("start_date"),
            F.lit(date_key(hi)).alias("end_date"),
            F.lit(days).cast("long").alias("days_expected"),
            "day_cnt",
            (F.lit(days) - F.col("day_cnt")).cast("long").alias("days_missing"),
            (F.col("day_cnt") < days).alias("needs_backfill"),
        )
    )

"""Data-quality checks of the warehouse tables. Each returns a small DataFrame; status is PASS, WARNING or FAIL."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline import rules as L
from shelfline.functions import as_date, count_when, date_key, percent, position_in, sum_when
from shelfline.operators.profile import stack_rows
from shelfline.rules import RetailRules


def _pass_unless(problem: Column, otherwise: str) -> Column:
    return F.when(problem, otherwise).otherwise("PASS")


def dq_dim_product(product: DataFrame) -> DataFrame:
    nulls = [f"null_{name}" for name in ("code", "name", "category")]
    return product.agg(
        F.count(F.lit(1)).alias("total"),
        count_when(F.col("is_main_product") == "Y").alias("main_products"),
        count_when(F.col("is_active") == "Y").alias("active_products"),
        count_when(F.col("product_code").isNull()).alias("null_code"),
        count_when(F.col("product_name").isNull()).alias("null_name"),
        count_when(F.col("category_id").isNull()).alias("null_category"),
    ).withColumn("status", _pass_unless(F.greatest(*nulls) > 0, "WARNING"))


def dq_dim_store(store: DataFrame, rules: RetailRules = RetailRules()) -> DataFrame:
    """Stores per type, with the table-wide figures on every row; without the main warehouse the check fails.

    The window runs on the handful of rows that are left, one per store type.
    """
    whole = Window.partitionBy()
    per_type = store.groupBy("store_type").agg(
        F.count(F.lit(1)).alias("cnt"),
        count_when(F.col("is_cloud_store") == "Y").alias("cloud"),
        count_when(F.col("store_code") == rules.main_warehouse).alias("main"),
    )
    return (
        per_type.select(
            "store_type",
            "cnt",
            F.sum("cnt").over(whole).alias("total_stores"),
            F.sum("cloud").over(whole).alias("cloud_stores"),
            F.sum("main").over(whole).alias("main_warehouses"),
        )
        .withColumn("status", _pass_unless(F.col("main_warehouses") == 0, "FAIL"))
        .orderBy(F.col("cnt").desc(), "store_type")
    )


def _main_products(product: DataFrame) -> Column:
    """Number of main products, as a scalar subquery."""
    return product.agg(count_when(F.col("is_main_product") == "Y")).scalar()


def _main_stock(
    inventory: DataFrame, product: DataFrame, store: DataFrame, as_of, rules: RetailRules
) -> DataFrame:
    """Snapshot rows of main products in stock scope, by the dimension tables."""
    stores = store.filter(rules.stock_scope(F.col("store_code"), F.col("is_cloud_store"))).select("store_id")
    main = product.filter(F.col("is_main_product") == "Y").select("product_id")
    return (
        inventory.filter(F.col("date_id") == date_key(as_of))
        .join(stores, "store_id", "left_semi")
        .join(main, "product_id", "left_semi")
    )


def _against_expected(found: Column, rules: RetailRules) -> list[Column]:
    expected = F.lit(rules.expected_health_rows).cast("long")
    difference = found - expected
    return [
        expected.alias("expected"),
        difference.alias("difference"),
        percent(F.abs(difference), expected).alias("difference_pct"),
        _pass_unless(F.abs(difference) > rules.expected_tolerance, "WARNING").alias("status"),
    ]


def dq_inventory(
    inventory: DataFrame, product: DataFrame, store: DataFrame, as_of, rules: RetailRules = RetailRules()
) -> DataFrame:
    """Rows of the day and distinct main products in scope, against the expected number.

    One scan: scope and main-product membership become flags, the distinct count sees only flagged products.
    """
    stores = store.filter(rules.stock_scope(F.col("store_code"), F.col("is_cloud_store"))).select(
        "store_id", F.lit(True).alias("in_scope")
    )
    main = product.filter(F.col("is_main_product") == "Y").select("product_id", F.lit(True).alias("is_main"))
    per_pair = (
        inventory.filter(F.col("date_id") == date_key(as_of))
        .groupBy("store_id", "product_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        per_pair.join(stores, "store_id", "left")
        .join(main, "product_id", "left")
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows_today"),
            F.count_distinct(F.when(F.col("in_scope") & F.col("is_main"), F.col("product_id"))).alias("main_products"),
        )
        .select("rows_today", "main_products", *_against_expected(F.col("main_products"), rules))
    )


def dq_sales(sales: DataFrame, as_of, rules: RetailRules = RetailRules()) -> DataFrame:
    """Rows, scoped amounts and negative values of the last 30 days (by real dates, also across month ends)."""
    day = as_date(as_of)
    recent = sales.filter(
        F.col("date_id").between(date_key(day - timedelta(days=rules.long_window_days)), date_key(day))
    )
    scope = rules.sales_scope(F.col("store_code"), F.col("is_cloud_store"))
    return recent.agg(
        F.count(F.lit(1)).alias("rows_30d"),
        F.sum(F.when(scope, F.col("sales_amount"))).alias("sales_amount"),
        F.sum(F.when(scope, F.col("return_amount"))).alias("return_amount"),
        count_when((F.col("sales_qty") < 0) | (F.col("sales_amount") < 0)).alias("negative_rows"),
    ).withColumn("status", _pass_unless(F.col("negative_rows") > 0, "WARNING"))


def dq_health(health: DataFrame, rules: RetailRules = RetailRules()) -> DataFrame:
    """Row count against the expected number, distributions and replenishment sums as rows (section, item, value).

    Statuses, grades and sums are counted together per (status, grade) in one pass over the mart.
    """
    suggest = F.col("suggest_qty")
    cells = health.groupBy("inventory_status", "sku_grade").agg(
        F.count(F.lit(1)).alias("n"),
        sum_when(suggest > 0, suggest).alias("restock"),
        sum_when(suggest < 0, suggest).alias("surplus"),
        count_when(suggest < 0).alias("surplus_sku"),
    )

    def entry(section: str, item: Column, value: str) -> Column:
        return F.struct(
            F.lit(section).alias("section"), item.alias("item"), F.col(value).cast("long").alias("value")
        )

    entries = F.array(
        entry("rows", F.lit("total"), "n"),
        entry("status", F.col("inventory_status"), "n"),
        entry("grade", F.col("sku_grade"), "n"),
        entry("replenish", F.lit("restock"), "restock"),
        entry("replenish", F.lit("surplus"), "surplus"),
        entry("replenish", F.lit("surplus_sku"), "surplus_sku"),
    )
    totals = cells.select(F.inline(entries)).groupBy("section", "item").agg(F.sum("value").alias("value"))
    off = F.abs(F.col("value") - rules.expected_health_rows) > rules.expected_tolerance
    return totals.withColumn(
        "status", F.when((F.col("section") == "rows") & off, "WARNING").otherwise("PASS")
    ).orderBy("section", position_in(F.col("item"), L.STATUS_ORDER + L.GRADE_ORDER), "item")


def health_coverage(health: DataFrame, product: DataFrame, rules: RetailRules = RetailRules()) -> DataFrame:
    """Rows with stock or sales, with neither, discontinued; main products; difference from the expected number."""
    stock = F.coalesce("total_qty", F.lit(0))
    sold = F.coalesce("sales_amt_30d", F.lit(0))
    mart = health.agg(
        F.count(F.lit(1)).alias("total"),
        count_when((stock > 0) | (sold > 0)).alias("with_stock_or_sales"),
        count_when((stock == 0) & (sold == 0)).alias("zero_both"),
        count_when(F.col("inventory_status") == L.STATUS_STOPPED).alias("stopped"),
    )
    return mart.select(
        "total", "with_stock_or_sales", "zero_both", "stopped", _main_products(product).alias("main_products"),
        (F.col("total") - rules.expected_health_rows).alias("difference"),
        (F.col("with_stock_or_sales") - rules.expected_health_rows).alias("difference_filtered"),
    )


def inventory_coverage(
    inventory: DataFrame, product: DataFrame, store: DataFrame, as_of, rules: RetailRules = RetailRules()
) -> DataFrame:
    """Main products with a stock row, stock rows by store, all main products."""
    found = _main_stock(inventory, product, store, as_of, rules).agg(
        F.count_distinct("product_id").alias("products_with_stock"), F.count(F.lit(1)).alias("stock_rows")
    )
    return found.select(
        "products_with_stock", "stock_rows", _main_products(product).alias("main_products"),
        F.abs(F.col("products_with_stock") - rules.expected_health_rows).alias("difference"),
        percent(
            F.abs(F.col("products_with_stock") - rules.expected_health_rows), F.lit(rules.expected_health_rows), 1
        ).alias("difference_pct"),
    )


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return stack_rows(
        [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
         for n, df in tables.items()]
    )


def dq_rules(
    keyed: Mapping[str, tuple[DataFrame, str]], retail: DataFrame, item: DataFrame, sales: DataFrame,
    health: DataFrame, as_of,
) -> DataFrame:
    """The four published rules, one row each (completeness: one per table): checked, violations, pct, status.

    completeness: keys are never NULL; consistency: header amounts and line amounts of active headers differ by less
    than 0.1 %, in total, and document by document, where errors cannot cancel out; timeliness: the newest sales day is
    yesterday or later; accuracy: turnover below 0 or above 1000 days is flagged. Both sales rules come from one
    aggregate if ``keyed`` names the same facts.
    """
    shape = ["rule", "subject", "checked", "violations", "pct", "status"]

    def rule(df: DataFrame, name: str, subject: str, bad: str) -> DataFrame:
        return df.withColumn("rule", F.lit(name)).withColumn("subject", F.lit(subject)).withColumn(
            "status", _pass_unless(F.col("violations") > 0, bad)
        )

    checks, sales_key = [], None
    for table, (df, key) in keyed.items():
        if df is sales:
            sales_key = (table, key)
            continue
        counts = df.agg(F.count(F.lit(1)).alias("checked"), count_when(F.col(key).isNull()).alias("violations"))
        counts = counts.withColumn("pct", percent(F.col("checked") - F.col("violations"), F.col("checked")))
        checks.append(rule(counts, "completeness", f"{table}.{key}", "FAIL").select(*shape))

    headers = retail.filter(F.col("isactive") == "Y").select(F.col("id").alias("retail_id"), "tot_amt_actual")
    lines = item.groupBy("retail_id").agg(F.sum("tot_amt_actual").alias("line_amount"))
    own = F.abs(F.col("tot_amt_actual") - F.coalesce("line_amount", F.lit(0)))
    gap = (
        headers.join(lines, "retail_id", "left")
        .agg(
            F.count(F.lit(1)).alias("checked"),
            count_when((own > 0) & (own * 1000 >= F.abs("tot_amt_actual"))).alias("documents"),
            F.sum("tot_amt_actual").alias("header_sum"),
            F.coalesce(F.sum("line_amount"), F.lit(0)).alias("line_sum"),
        )
        .withColumn("pct", percent(F.abs(F.col("header_sum") - F.col("line_sum")), F.abs("header_sum"), 2))
        .withColumn(
            "violations",
            (F.abs(F.col("header_sum") - F.col("line_sum")) * 1000 >= F.abs("header_sum")).cast("long"),
        )
    )
    entries = [
        F.struct(
            F.lit("consistency").alias("rule"), F.lit("sales amount: header vs lines").alias("subject"), "checked",
            "violations", "pct", _pass_unless(F.col("violations") > 0, "WARNING").alias("status"),
        ),
        F.struct(
            F.lit("document_consistency").alias("rule"), F.lit("sales amount: header vs lines").alias("subject"), "checked",
            F.col("documents").alias("violations"),
            percent(F.col("checked") - F.col("documents"), F.col("checked"), 2).alias("pct"),
            _pass_unless(F.col("documents") > 0, "WARNING").alias("status"),
        ),
    ]
    checks.append(gap.select(F.inline(F.array(*entries))).select(*shape))

    nulls = F.lit(0).cast("long") if sales_key is None else count_when(F.col(sales_key[1]).isNull())
    facts = sales.agg(F.count(F.lit(1)).alias("checked"), F.max("date_id").alias("newest"), nulls.alias("nulls"))
    late = F.coalesce("newest", F.lit(0)) < date_key(as_date(as_of) - timedelta(days=1))
    filled = percent(F.col("checked") - F.col("nulls"), F.col("checked"))
    entries = [
        F.struct(
            F.lit("timeliness").alias("rule"), F.lit("dws_sales_daily.date_id").alias("subject"), "checked",
            late.cast("long").alias("violations"), F.lit(None).cast("decimal(20,2)").alias("pct"),
            _pass_unless(late, "WARNING").alias("status"),
        )
    ]
    if sales_key is not None:
        entries.append(
            F.struct(
                F.lit("completeness").alias("rule"), F.lit(".".join(sales_key)).alias("subject"), "checked",
                F.col("nulls").alias("violations"), filled.cast("decimal(20,2)").alias("pct"),
                _pass_unless(F.col("nulls") > 0, "FAIL").alias("status"),
            )
        )
    checks.append(facts.select(F.inline(F.array(*entries))).select(*shape))

    odd = health.agg(
        F.count(F.lit(1)).alias("checked"),
        count_when((F.col("turnover_days") < 0) | (F.col("turnover_days") > 1000)).alias("violations"),
    ).withColumn("pct", percent(F.col("violations"), F.col("checked")))
    checks.append(rule(odd, "accuracy", "ads_inventory_health.turnover_days", "WARNING").select(*shape))
    return stack_rows(checks)


def run_checks(tables: Mapping[str, DataFrame], as_of, rules: RetailRules = RetailRules()) -> DataFrame:
    """All table validations as one DataFrame (check_name, measured, status), one row per table."""
    health = tables["ads_inventory_health"]
    product, store, inventory = tables["dim_product"], tables["dim_store"], tables["dws_inventory_daily"]
    found = {
        "dim_product": dq_dim_product(product).select(F.col("total").alias("measured"), "status"),
        "dim_store": store.agg(
            F.count(F.lit(1)).alias("measured"),
            _pass_unless(count_when(F.col("store_code") == rules.main_warehouse) == 0, "FAIL").alias("status"),
        ),
        "dws_inventory_daily": dq_inventory(inventory, product, store, as_of, rules).select(
            F.col("main_products").alias("measured"), "status"
        ),
        "dws_sales_daily": dq_sales(tables["dws_sales_daily"], as_of, rules).select(
            F.col("rows_30d").alias("measured"), "status"
        ),
        "ads_inventory_health": health.agg(F.count(F.lit(1)).alias("measured")).select(
            "measured", _against_expected(F.col("measured"), rules)[-1]
        ),
    }
    return stack_rows([df.select(F.lit(name).alias("check_name"), "measured", "status") for name, df in found.items()])

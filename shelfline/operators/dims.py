"""Dimension builders (master data, rebuilt in full).

Lookup joins carry no broadcast hint: Catalyst broadcasts a lookup while its size is under
``spark.sql.autoBroadcastJoinThreshold`` and falls back to a shuffle join, with AQE skew splitting, beyond it.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline import rules as L
from shelfline.functions import as_date, day_to_key, flag_yn
from shelfline.rules import RetailRules


def _active(df: DataFrame) -> DataFrame:
    return df.filter(F.col("isactive") == "Y")


def _one_per_id(lookup: DataFrame, key: str, **columns: str) -> DataFrame:
    """A lookup as (key, columns) with one row per id, so that it multiplies nothing and falls away where nobody reads it."""
    return lookup.groupBy(F.col("id").alias(key)).agg(*[F.max(c).alias(name) for name, c in columns.items()])


def dim_product(product: DataFrame, dim: DataFrame, rules: RetailRules = RetailRules()) -> DataFrame:
    """Active products with brand, category, property and series names and the main-product flag.

    Colour and size are kept in ``dim_product_attr``.
    """
    out = _active(product)
    for column, name in (
        ("m_dim1_id", "brand"), ("m_dim4_id", "category"), ("m_dim5_id", "property"), ("m_dim6_id", "series"),
    ):
        lookup = _one_per_id(dim, f"{name}_key", **{f"{name}_name": "attribname"})
        out = out.join(lookup, F.col(column) == F.col(f"{name}_key"), "left")

    def id_or_zero(column: str):
        return F.coalesce(F.col(column), F.lit(0)).cast("long")

    def text(column: str, default: str):
        return F.coalesce(F.col(column), F.lit(default))

    return out.select(
        F.col("id").cast("long").alias("product_id"),
        F.col("name").alias("product_code"),
        F.col("value").alias("product_name"),
        id_or_zero("m_dim4_id").alias("category_id"),
        text("category_name", L.NO_CATEGORY).alias("category_name"),
        id_or_zero("m_dim5_id").alias("property_id"),
        text("property_name", L.NO_PROPERTY).alias("property_name"),
        id_or_zero("m_dim6_id").alias("series_id"),
        text("series_name", "").alias("series_name"),
        id_or_zero("m_dim1_id").alias("brand_id"),
        text("brand_name", "").alias("brand_name"),
        F.coalesce(F.col("pricelist"), F.lit(0)).cast("decimal(12,2)").alias("price_list"),
        text("fabelement", "").alias("material"),
        F.coalesce(F.col("precost"), F.lit(0)).cast("decimal(12,2)").alias("price_cost"),
        flag_yn(rules.is_main_category(F.col("m_dim4_id"))).alias("is_main_product"),
        F.col("isactive").alias("is_active"),
        F.col("creationdate").alias("created_at"),
    )


def dim_product_attr(product: DataFrame, alias: DataFrame, attr: DataFrame) -> DataFrame:
    """Distinct (product, colour, size) of active products, taken from their first active SKU; missing values become ''."""
    # min_by keeps one candidate per product and task before the shuffle, so a product with very many SKUs stays cheap.
    first_sku = _active(alias).groupBy("product_id").agg(F.min_by("attr_id", "id").alias("attr_id"))
    looks = _one_per_id(attr, "attr_id", value1="value1", value2="value2")
    first_look = first_sku.join(looks, "attr_id", "left").select("product_id", "value1", "value2")
    return (
        _active(product)
        .select(F.col("id").alias("product_id"))
        .join(first_look, "product_id", "left")
        .select(
            F.col("product_id").cast("long").alias("product_id"),
            F.coalesce("value1", F.lit("")).alias("color"),
            F.coalesce("value2", F.lit("")).alias("size"),
        )
        .distinct()
    )


def dim_sku(alias: DataFrame, attr: DataFrame) -> DataFrame:
    """Active SKUs with colour and size."""
    looks = _one_per_id(attr, "as_id", value1="value1", value2="value2")
    return (
        _active(alias)
        .join(looks, F.col("attr_id") == F.col("as_id"), "left")
        .select(
            F.col("id").cast("long").alias("sku_id"),
            F.coalesce("no", F.lit("")).alias("sku_barcode"),
            F.col("product_id").cast("long").alias("product_id"),
            F.coalesce("value1", F.lit("")).alias("sku_color"),
            F.coalesce("value2", F.lit("")).alias("sku_size"),
            F.col("isactive").alias("is_active"),
            F.col("creationdate").alias("created_at"),
        )
    )


def dim_store(store: DataFrame, area: DataFrame, rules: RetailRules = RetailRules()) -> DataFrame:
    """Active stores with area name and the type read from the store code (codes are case-sensitive)."""
    areas = _one_per_id(area, "ar_id", area_name="name")
    code = F.col("code")
    store_type = (
        F.when(code == rules.main_warehouse, L.STORE_MAIN)
        .when(code.startswith(rules.ecommerce_prefix), L.STORE_ECOMMERCE)
        .when(code.startswith(rules.shop_prefix), L.STORE_SHOP)
        .when(code.startswith(rules.test_prefix), L.STORE_TEST)
        .otherwise(L.STORE_FUNCTIONAL)
    )
    return (
        _active(store)
        .join(areas, F.col("area_id") == F.col("ar_id"), "left")
        .select(
            F.col("id").cast("long").alias("store_id"),
            code.alias("store_code"),
            F.col("name").alias("store_name"),
            F.coalesce("area_id", F.lit(0)).cast("long").alias("area_id"),
            F.coalesce("area_name", F.lit(L.NO_AREA)).alias("area_name"),
            F.coalesce("is_warehouse", F.lit(0)).cast("int").alias("is_warehouse"),
            F.coalesce("is_store", F.lit(0)).cast("int").alias("is_store"),
            F.coalesce("is_cloud", F.lit("N")).alias("is_cloud_store"),
            F.coalesce("is_center", F.lit("N")).alias("is_center"),
            store_type.alias("store_type"),
            F.col("isactive").alias("is_active"),
        )
    )


def calendar_days(spark: SparkSession, lo: date | str | int, hi: date | str | int) -> DataFrame:
    """One row per day of [lo, hi], generated on the executors."""
    start, stop = as_date(lo), as_date(hi)
    return spark.range((stop - start).days + 1).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias("date_value")
    )


def days_covering(df: DataFrame, day: str) -> DataFrame:
    """One row per day between the first and last value of a date column; empty for an empty input."""
    bounds = df.agg(F.min(day).cast("date").alias("lo"), F.max(day).cast("date").alias("hi"))
    return bounds.filter(F.col("lo").isNotNull()).select(F.explode(F.sequence("lo", "hi")).alias("date_value"))


def dim_date(days: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """Calendar attributes for a DataFrame of ``date_value``; ``holidays`` is (date_value, holiday_name)."""
    day = F.col("date_value")
    weekday = (F.weekday(day) + 1).cast("int")

    def named(names: tuple[str, ...], position):
        return F.element_at(F.array(*[F.lit(n) for n in names]), position)

    if holidays is None:
        out = days.select("date_value").withColumn("holiday_name", F.lit(None).cast("string"))
    else:
        out = days.select("date_value").join(holidays.select("date_value", "holiday_name"), "date_value", "left")
    return out.select(
        day_to_key(day).alias("date_id"),
        "date_value",
        F.year(day).alias("date_year"),
        F.month(day).alias("date_month"),
        F.dayofmonth(day).alias("date_day"),
        F.quarter(day).alias("date_quarter"),
        F.weekofyear(day).alias("week_of_year"),
        weekday.alias("day_of_week"),
        named(L.WEEKDAY_NAMES, weekday).alias("day_name_cn"),
        named(L.MONTH_NAMES, F.month(day)).alias("month_name_cn"),
        (weekday >= 6).cast("int").alias("is_weekend"),
        F.col("holiday_name").isNotNull().cast("int").alias("is_holiday"),
        "holiday_name",
        F.date_format(day, "yyyy-MM").alias("year_month"),
    )


def dim_category(product: DataFrame, dim: DataFrame, rules: RetailRules = RetailRules()) -> DataFrame:
    """Categories in use by products; main categories sort in the order of the rules, the others after them."""
    used = product.select(F.col("m_dim4_id").alias("category_id")).filter("category_id is not null").distinct()
    names = dim.select(F.col("id").alias("category_id"), F.col("attribname").alias("category_name"))
    position = F.array_position(F.array(*[F.lit(i).cast("long") for i in rules.main_category_ids]), F.col("category_id"))
    return used.join(names, "category_id", "left").select(
        F.col("category_id").cast("long").alias("category_id"),
        F.coalesce("category_name", F.lit(L.NO_CATEGORY)).alias("category_name"),
        flag_yn(rules.is_main_category(F.col("category_id"))).alias("is_main_product"),
        F.when(position > 0, position).otherwise(len(rules.main_category_ids) + 1).cast("int").alias("sort_order"),
    )


def dim_channel(mapping: DataFrame, store: DataFrame) -> DataFrame:
    """E-commerce channels: a hand-kept map of store codes to channels, active while its store is."""
    stores = store.select(F.col("code").alias("store_code"), F.col("isactive").alias("store_active"))
    return mapping.join(stores, "store_code", "left").select(
        F.col("channel_id").cast("int").alias("channel_id"),
        "channel_name",
        "channel_code",
        "store_code",
        F.coalesce("is_main", F.lit(0)).cast("int").alias("is_main"),
        "platform_type",
        F.coalesce("store_active", F.lit("N")).alias("is_active"),
    )

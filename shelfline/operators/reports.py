"""Daily e-commerce report and sales summary.

Only the column lists of these two tables are published; the formulas are this library's:
average order value = sales / orders, return rate = returns / sales, discount rate = sales / list amount,
growth = (now - then) / then, all rates in percent. Orders are counted from ``facts.sale_orders``, so an order with several
SKUs counts once in every row it belongs to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions import key_to_date, percent, ratio


def _with_channel(sales: DataFrame, channel: DataFrame) -> DataFrame:
    """Attach the channel of the store code; a store without one keeps NULL."""
    channels = channel.select("store_code", "channel_id", "channel_name")
    return sales.join(channels, "store_code", "left")


def daily_report(sales: DataFrame, channel: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per day x channel with net values, rates, last year's same day and the previous day.

    Instead of joining the daily totals to themselves twice, each total is sent to the days it is a comparison for and
    one grouping brings the three figures together. 29 February compares with 28 February of the year before.
    """
    summed = ["sales_amount", "sales_amount_list", "sales_qty", "return_amount", "return_qty"]
    measures = [*summed, "order_count"]
    counted = orders.groupBy("date_id", "store_code").agg(F.count_distinct("retail_id").alias("order_count"))
    per_store = (
        sales.groupBy("date_id", "store_code")
        .agg(*[F.sum(c).alias(c) for c in summed])
        .join(counted, ["date_id", "store_code"], "left")
        .withColumn("order_count", F.coalesce("order_count", F.lit(0)))
    )
    daily = (
        _with_channel(per_store, channel)
        .groupBy(key_to_date(F.col("date_id")).alias("day"), "channel_id", "channel_name")
        .agg(*[F.sum(c).alias(c) for c in measures])
    )

    def row(kind: str, day: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), day.alias("report_date"))

    next_year = F.add_months("day", 12)
    targets = F.array(
        row("now", F.col("day")),
        row("mom", F.date_add("day", 1)),
        row("yoy", next_year),
        row("yoy", F.date_add(next_year, 1)),
    )
    spread = daily.select("*", F.inline(targets)).filter(
        (F.col("kind") != "yoy") | (F.add_months("report_date", -12) == F.col("day"))
    )

    def of(kind: str, column: str) -> Column:
        return F.sum(F.when(F.col("kind") == kind, F.col(column)))

    merged = (
        spread.groupBy("report_date", "channel_id", "channel_name")
        .agg(
            F.max((F.col("kind") == "now").cast("int")).alias("is_day"),
            *[of("now", c).alias(c) for c in measures],
            of("yoy", "sales_amount").alias("sales_amount_yoy"),
            of("mom", "sales_amount").alias("sales_amount_mom"),
        )
        .filter(F.col("is_day") == 1)
    )
    amount, yoy, mom = F.col("sales_amount"), F.col("sales_amount_yoy"), F.col("sales_amount_mom")
    return merged.select(
        "report_date", "channel_id", "channel_name",
        amount, "sales_qty", "return_amount", "return_qty",
        (amount - F.col("return_amount")).alias("net_amount"),
        (F.col("sales_qty") - F.col("return_qty")).alias("net_qty"),
        "order_count",
        ratio(amount, F.col("order_count"), 2).alias("avg_price"),
        percent(F.col("return_amount"), amount).alias("return_rate"),
        percent(amount, F.col("sales_amount_list")).alias("discount_rate"),
        "sales_amount_yoy",
        percent(amount - yoy, yoy).alias("yoy_growth"),
        "sales_amount_mom",
        percent(amount - mom, mom).alias("mom_growth"),
    )


def sales_summary(sales: DataFrame, product: DataFrame, channel: DataFrame, orders: DataFrame) -> DataFrame:
    """Sales per period x channel x category for days, weeks (from Monday) and months, with active SKUs.

    Every fact row is laid out for its three periods and summed per SKU, with partial sums before the one large shuffle;
    a second grouping on that counts the SKUs that sold, so no distinct aggregate is needed. Orders are made distinct per
    day, store and category, after which they add up over days and stores.
    """
    categories = product.select("product_id", "category_id", "category_name")
    measures = ["sales_amount", "sales_qty", "return_amount", "return_qty"]
    facts = sales.select("date_id", "store_code", "product_id", "m_productalias_id", *measures).join(
        categories, "product_id", "left"
    )
    day = key_to_date(F.col("date_id"))
    grains = F.array(
        *[
            F.struct(F.lit(grain).alias("granularity"), start.alias("report_date"))
            for grain, start in (("day", day), ("week", F.trunc(day, "week")), ("month", F.trunc(day, "month")))
        ]
    )
    period = ["report_date", "granularity", "channel_id", "channel_name", "category_id", "category_name"]
    per_sku = (
        _with_channel(facts, channel)
        .select("*", F.inline(grains))
        .groupBy(*period, "m_productalias_id")
        .agg(*[F.sum(c).alias(c) for c in measures])
    )
    counted = (
        orders.join(categories, "product_id", "left")
        .groupBy("date_id", "store_code", "category_id", "category_name")
        .agg(F.count_distinct("retail_id").alias("order_count"))
    )
    per_period = (
        _with_channel(counted, channel)
        .select("*", F.inline(grains))
        .groupBy(*period)
        .agg(F.sum("order_count").alias("order_count"))
    )
    # Channel and category may be NULL, so orders and money meet by grouping, not by a join.
    both = per_sku.withColumn("order_count", F.lit(0).cast("long")).unionByName(per_period, allowMissingColumns=True)
    return (
        both.groupBy(*period)
        .agg(
            *[F.sum(c).alias(c) for c in [*measures, "order_count"]],
            F.count(F.when(F.col("sales_qty") > 0, F.lit(1))).alias("sku_count"),
        )
        .withColumn("net_amount", F.col("sales_amount") - F.col("return_amount"))
        .withColumn("avg_price", ratio(F.col("sales_amount"), F.col("order_count"), 2))
        .select(
            *period, "sales_amount", "sales_qty", "return_amount", "return_qty", "net_amount", "order_count",
            "sku_count", "avg_price",
        )
    )

"""The whole warehouse: from source tables to the inventory-health mart."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.functions import as_date, date_key
from shelfline.operators.dims import calendar_days, dim_category, dim_channel, dim_date, dim_product, dim_product_attr, dim_sku, dim_store
from shelfline.operators.facts import day_prints, inventory_daily, sale_orders, sales_daily
from shelfline.operators.health import graded_health
from shelfline.operators.reports import daily_report, sales_summary
from shelfline.plans.refresh import changed_days, day_runs, days_to_load
from shelfline.rules import RetailRules
from shelfline.schema import align_schema, table_schema
from shelfline.sources.sinks import overwrite_table, replace_days, replace_snapshot, stamp

#: Folders for the receipts and lines of the look-back window while a refresh runs; readers of folders skip such names.
WINDOW_TABLES = ("_window_retail", "_window_item")


def build_dims(t: Mapping[str, DataFrame], rules: RetailRules = RetailRules()) -> dict[str, DataFrame]:
    return {
        "dim_product": dim_product(t["product"], t["dim"], rules),
        "dim_product_attr": dim_product_attr(t["product"], t["alias"], t["attr"]),
        "dim_sku": dim_sku(t["alias"], t["attr"]),
        "dim_store": dim_store(t["store"], t["area"], rules),
    }


def build_all(t: Mapping[str, DataFrame], as_of, rules: RetailRules = RetailRules()) -> dict[str, DataFrame]:
    """Every warehouse table from the source tables, without writing any.

    All of them stay lazy; this call starts no job.
    """
    first = as_date(as_of) - timedelta(days=rules.long_window_days)
    out = build_dims(t, rules)
    out["dws_sales_daily"] = sales_daily(t["retail"], t["item"], t["store"], t["product"], first, as_of, rules)
    out["dws_inventory_daily"] = inventory_daily(t["storage"], t["store"], t["product"], as_of, rules)
    out["ads_inventory_health"] = graded_health(
        out["dws_inventory_daily"], out["dws_sales_daily"], out["dim_product"], out["dim_sku"], out["dim_store"],
        as_of, rules,
    )
    return out


def aligned(df: DataFrame, table: str) -> DataFrame:
    """The rows with load stamps, in the published columns of the table; columns that are new to it come last."""
    return align_schema(stamp(df, table), table_schema(table))


def backfill(
    t: Mapping[str, DataFrame], root: str, lo, hi, rules: RetailRules = RetailRules()
) -> int:
    """Compute the stored sales of the days [lo, hi] again from the sources, late rows included; the rows written."""
    fresh = sales_daily(t["retail"], t["item"], t["store"], t["product"], lo, hi, rules)
    path = f"{root.rstrip('/')}/dws_sales_daily"
    return replace_days(aligned(fresh, "dws_sales_daily"), path, date_key(lo), date_key(hi))


def store_window(
    spark: SparkSession, t: Mapping[str, DataFrame], root: str, lo, hi
) -> dict[str, DataFrame]:
    """The source tables with the receipts of the bill dates [lo, hi] and their lines in place of all.

    Both are written below ``root`` and read back, so all jobs over these days read the whole tables once, and see the
    same rows. ``drop_window`` removes them.
    """
    headers, lines = (f"{root.rstrip('/')}/{name}" for name in WINDOW_TABLES)
    inside = F.col("billdate").between(date_key(lo), date_key(hi))
    t["retail"].filter(inside).write.mode("overwrite").parquet(headers)
    retail = spark.read.schema(t["retail"].schema).parquet(headers)
    wanted = retail.select(F.col("id").alias("retail_id"))
    t["item"].join(wanted, "retail_id", "left_semi").select(*t["item"].columns).write.mode("overwrite").parquet(lines)
    return {**t, "retail": retail, "item": spark.read.schema(t["item"].schema).parquet(lines)}


def drop_window(spark: SparkSession, root: str) -> None:
    for name in WINDOW_TABLES:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{name}")
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def reload_changed(
    spark: SparkSession, t: Mapping[str, DataFrame], root: str, lo, hi, rules: RetailRules = RetailRules(),
    loaded: tuple[int, int] | None = None,
) -> list[int]:
    """Compute the stored sales of those days in [lo, hi] again whose source lines changed since the last call; the days.

    Late and corrected rows are found by the prints of the days, kept beside the facts in ``dws_sales_prints``. The prints
    are read once, as one row per day; they are stored after the facts, so a run that breaks off is made up for by the
    next. ``loaded`` names days that are fresh already.
    """
    path = f"{root.rstrip('/')}/dws_sales_prints"
    rows = day_prints(t["retail"], t["item"], t["store"], t["product"], lo, hi, rules).collect()
    current = spark.createDataFrame(rows, "date_id int, source_lines bigint, print decimal(38,0)")
    known = spark.read.parquet(path) if _exists(spark, path) else current.limit(0)
    between = known["date_id"].between(date_key(lo), date_key(hi))
    moved = [r["date_id"] for r in changed_days(known.filter(between), current).collect()]
    stale = [d for d in moved if loaded is None or not loaded[0] <= d <= loaded[1]]
    for first, last in day_runs(stale):
        backfill(t, root, first, last, rules)
    if moved:
        replace_days(current.coalesce(1), path, date_key(lo), date_key(hi), on_empty="clear")
    return sorted(stale)


def run_reports(
    spark: SparkSession, t: Mapping[str, DataFrame], root: str, lo, hi, rules: RetailRules = RetailRules()
) -> dict[str, DataFrame]:
    """Store the calendar, category and channel dimensions and both reports over the stored sales of [lo, hi]."""
    root = root.rstrip("/")
    sales = spark.read.option("mergeSchema", "true").parquet(f"{root}/dws_sales_daily")
    sales = sales.filter(sales["date_id"].between(date_key(lo), date_key(hi)))
    orders = sale_orders(t["retail"], t["item"], t["store"], t["product"], lo, hi, rules)
    channel = dim_channel(t["channel_map"], t["store"])
    product = spark.read.parquet(f"{root}/dim_product")
    tables = {
        "dim_date": dim_date(calendar_days(spark, lo, hi)),
        "dim_category": dim_category(t["product"], t["dim"]),
        "dim_channel": channel,
        "ads_daily_report": daily_report(sales, channel, orders),
        "ads_sales_summary": sales_summary(sales, product, channel, orders),
    }
    for table, df in tables.items():
        overwrite_table(aligned(df, table), f"{root}/{table}")
    return {table: spark.read.parquet(f"{root}/{table}") for table in tables}


def run_all(
    spark: SparkSession, t: Mapping[str, DataFrame], root: str, as_of, rules: RetailRules = RetailRules(),
    days: tuple | None = None,
) -> dict[str, DataFrame]:
    """Refresh the stored warehouse below ``root`` for one day and return its tables as read back.

    Tables are written layer by layer and read back, so the mart starts from pruned day partitions instead of the
    sources. Facts are partitioned by ``date_id``, the mart by ``snapshot_date``. ``days`` = (first, last) chooses the
    sales days to load; without it they are the day itself, or the look-back window where stored days are missing, and
    stored days of the window whose source lines have changed; both are computed from the receipts and lines of the window,
    which are taken from the whole tables once. Every table is brought to its published columns before it is written, and parts of different age are merged on reading.
    """
    root = root.rstrip("/")

    def path(table: str) -> str:
        return f"{root}/{table}"

    def stored(table: str) -> DataFrame:
        return spark.read.option("mergeSchema", "true").parquet(path(table))

    for table, df in build_dims(t, rules).items():
        # Products and stores are replaced whatever arrives; an empty SKU extract keeps the stored SKUs.
        known_skus = table == "dim_sku" and _exists(spark, path(table))
        overwrite_table(aligned(df, table), path(table), "keep" if known_skus else "replace")

    sales_path = path("dws_sales_daily")
    known = stored("dws_sales_daily") if _exists(spark, sales_path) else None
    lo, hi = days or days_to_load(known, as_of, rules)
    if days is None:
        first = as_date(as_of) - timedelta(days=rules.long_window_days)
        window = store_window(spark, t, root, first, as_of)
        backfill(window, root, lo, hi, rules)
        reload_changed(spark, window, root, first, as_of, rules, (date_key(lo), date_key(hi)))
        drop_window(spark, root)
    else:
        backfill(t, root, lo, hi, rules)

    snapshot = inventory_daily(t["storage"], t["store"], t["product"], as_of, rules)
    replace_snapshot(aligned(snapshot, "dws_inventory_daily"), path("dws_inventory_daily"), date_key(as_of))

    health = graded_health(
        stored("dws_inventory_daily"), stored("dws_sales_daily"), stored("dim_product"), stored("dim_sku"),
        stored("dim_store"), as_of, rules,
    )
    replace_snapshot(
        aligned(health, "ads_inventory_health"), path("ads_inventory_health"), as_date(as_of), "snapshot_date", "clear"
    )
    names = [
        "dim_product", "dim_product_attr", "dim_sku", "dim_store", "dws_sales_daily", "dws_inventory_daily",
        "ads_inventory_health",
    ]
    return {name: stored(name) for name in names}


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)

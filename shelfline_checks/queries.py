"""The registered queries: each job run on the retail view of a test-data folder.

Decimals are handed out as doubles, because the two engines print decimals differently; they are exact until then.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline_checks.adapter import AS_OF, Sources, view
from shelfline.functions import date_key
from shelfline.operators import dims, facts, health, purchase, quality, reports, stock, transfer
from shelfline.plans import refresh, warehouse
from shelfline.schema import align_schema
from shelfline.sources import readers, sinks

FIRST_DAY, LAST_DAY = date(1995, 1, 1), AS_OF
WINDOW_START = AS_OF - timedelta(days=30)
COVERAGE = (AS_OF - timedelta(days=30), AS_OF - timedelta(days=1))
REFRESH = (date(2001, 6, 1), date(2001, 7, 15))

Query = Callable[[SparkSession, str], DataFrame]


class Warehouse(Sources):
    """Warehouse tables computed from the sources of one folder."""

    @view
    def dim_product(self) -> DataFrame:
        return dims.dim_product(self.product(), self.dim())

    @view
    def dim_product_attr(self) -> DataFrame:
        return dims.dim_product_attr(self.product(), self.alias(), self.attr())

    @view
    def dim_sku(self) -> DataFrame:
        return dims.dim_sku(self.alias(), self.attr())

    @view
    def dim_store(self) -> DataFrame:
        return dims.dim_store(self.store(), self.area())

    @view
    def dim_channel(self) -> DataFrame:
        return dims.dim_channel(self.channel_map(), self.store())

    @view
    def sales(self, lo: date = FIRST_DAY, hi: date = LAST_DAY) -> DataFrame:
        whole = (lo, hi) == (FIRST_DAY, LAST_DAY)
        retail = self.retail() if whole else self.retail(lo, hi)
        return facts.sales_daily(retail, self.retail_item(), self.store(), self.product(), lo, hi)

    @view
    def orders(self) -> DataFrame:
        return facts.sale_orders(self.retail(), self.retail_item(), self.store(), self.product(), FIRST_DAY, LAST_DAY)

    @view
    def recent_sales(self) -> DataFrame:
        return self.sales(WINDOW_START, AS_OF)

    @view
    def inventory(self) -> DataFrame:
        return facts.inventory_daily(self.storage(), self.store(), self.product(), AS_OF)

    @view
    def health(self) -> DataFrame:
        return health.inventory_health(
            self.inventory(), self.recent_sales(), self.dim_product(), self.dim_sku(), self.dim_store(), AS_OF
        )

    @view
    def graded(self) -> DataFrame:
        return health.graded_health(
            self.inventory(), self.recent_sales(), self.dim_product(), self.dim_sku(), self.dim_store(), AS_OF
        )


def _sku_window(w: Warehouse) -> DataFrame:
    """Stock, 30-day and 7-day sales per product x SKU for the indicator queries."""
    stock_side = health.stock_totals(w.inventory(), w.dim_store(), AS_OF)
    sales_side = health.sales_totals(w.recent_sales(), w.dim_store(), AS_OF)
    joined = stock_side.join(sales_side, ["product_id", "sku_id"], "left")
    measures = ("total_qty", "purchase_rem_qty", "sales_qty_30d", "sales_qty_7d", "return_qty_30d")
    return joined.select("product_id", "sku_id", *[F.coalesce(m, F.lit(0)).alias(m) for m in measures])


def _category_trend(w: Warehouse) -> DataFrame:
    """Velocity and trend per category, where all trend classes can occur."""
    per_category = (
        w.recent_sales()
        .join(w.dim_product().select("product_id", "category_id"), "product_id")
        .groupBy("category_id")
        .agg(
            F.sum("sales_qty").alias("sales_qty_30d"),
            F.sum(F.when(F.col("date_id") >= date_key(AS_OF - timedelta(days=7)), F.col("sales_qty")).otherwise(0)).alias(
                "sales_qty_7d"
            ),
            F.lit(0).alias("total_qty"),
        )
    )
    metrics = health.turnover_metrics(per_category)
    return health.sales_trend(metrics).select(
        "category_id", "sales_qty_30d", "sales_qty_7d", "sales_velocity", "sales_trend"
    )


def _table_counts(w: Warehouse) -> DataFrame:
    return quality.table_counts(
        {
            "dim_product": w.dim_product(), "dim_sku": w.dim_sku(), "dim_store": w.dim_store(),
            "dws_sales_daily": w.sales(), "dws_inventory_daily": w.inventory(), "ads_inventory_health": w.health(),
        }
    )


def _dq_rules(w: Warehouse) -> DataFrame:
    keyed = {
        "dim_product": (w.dim_product(), "product_id"), "dim_sku": (w.dim_sku(), "sku_id"),
        "dim_store": (w.dim_store(), "store_id"), "dws_sales_daily": (w.recent_sales(), "m_productalias_id"),
    }
    return quality.dq_rules(keyed, w.retail(), w.retail_item(), w.recent_sales(), w.health(), AS_OF)


def _run_checks(w: Warehouse) -> DataFrame:
    return quality.run_checks(
        {
            "dim_product": w.dim_product(), "dim_store": w.dim_store(), "dws_inventory_daily": w.inventory(),
            "dws_sales_daily": w.recent_sales(), "ads_inventory_health": w.health(),
        },
        AS_OF,
    )


def _replaced_range(w: Warehouse) -> DataFrame:
    """Facts of the whole history; in one range, those of a revised extract that counts one more piece per row."""
    lo, hi = REFRESH
    fresh = w.sales(lo, hi).withColumn("sales_qty", F.col("sales_qty") + 1)
    return refresh.replace_range(w.sales(), fresh, date_key(lo), date_key(hi))


def _replaced_snapshot(w: Warehouse) -> DataFrame:
    """Two snapshot days; the second is replaced by one that counts on-order quantity as stock."""
    today = w.inventory()
    before = today.withColumn("date_id", F.lit(date_key(AS_OF - timedelta(days=1))))
    revised = today.withColumn("qty", F.col("qty") + F.col("qtypurchaserem"))
    return refresh.replace_snapshot(before.unionByName(today), revised, date_key(AS_OF))


def _backfilled(w: Warehouse) -> DataFrame:
    lo, hi = REFRESH
    stored = w.sales().filter(~F.col("date_id").between(date_key(lo), date_key(hi)))
    return refresh.backfill_sales(
        stored, w.retail(lo, hi), w.retail_item(), w.store(), w.product(), lo, hi
    )


def _changed_days(w: Warehouse) -> DataFrame:
    """Days whose sales have to be computed again after some lines came late."""
    late = (F.col("qty") == 37) & (F.col("product_id") % 7 == 2)
    prints = lambda item: facts.day_prints(w.retail(), item, w.store(), w.product(), FIRST_DAY, LAST_DAY)
    return refresh.changed_days(prints(w.retail_item().filter(~late)), prints(w.retail_item()))


def _moved_totals(w: Warehouse) -> DataFrame:
    """The window totals of ten days ago, moved to the last day; one day in between is computed again in the meantime."""
    before, day = AS_OF - timedelta(days=10), date_key(AS_OF - timedelta(days=20))
    sales, store = w.sales(AS_OF - timedelta(days=41), AS_OF), w.dim_store()
    stale = sales.withColumn("sales_qty", F.when(F.col("date_id") == day, F.col("sales_qty") + 5).otherwise(F.col("sales_qty")))
    stored = health.window_totals(stale, store, before)
    old, new = (x.filter(F.col("date_id") == day) for x in (stale, sales))
    return health.moved_totals(stored, sales, store, before, AS_OF, replaced=(old, new)).drop("fact_rows")


def _folder(w: Warehouse) -> str:
    """A new folder for a stored table: below spark.checkpoint.dir, or in the session's warehouse where that is unset."""
    shared = w.spark.conf.get("spark.checkpoint.dir", None) or f"{w.spark.conf.get('spark.sql.warehouse.dir')}/_stored"
    return f"{shared}/stored-{uuid4().hex}"


def _stored_store(w: Warehouse) -> DataFrame:
    """An older store table of other columns is overwritten; an empty extract that comes later leaves it as it is."""
    path = f"{_folder(w)}/dim_store"
    sinks.overwrite_table(w.dim_store().select("store_id", F.lit(0).alias("old_flag")), path)
    sinks.overwrite_table(w.dim_store(), path)
    sinks.overwrite_table(w.dim_store().limit(0), path, "keep")
    return w.spark.read.parquet(path)


def _stored_range(w: Warehouse) -> DataFrame:
    """The stored form of ``_replaced_range``: the facts by day, then the days of one range replaced."""
    lo, hi = REFRESH
    path = f"{_folder(w)}/dws_sales_daily"
    sinks.replace_days(w.sales(), path, date_key(FIRST_DAY), date_key(LAST_DAY))
    fresh = w.sales(lo, hi).withColumn("sales_qty", F.col("sales_qty") + 1)
    sinks.replace_days(fresh, path, date_key(lo), date_key(hi))
    sinks.replace_days(fresh.limit(0), path, date_key(FIRST_DAY), date_key(LAST_DAY))
    return w.spark.read.parquet(path)


def _stored_snapshot(w: Warehouse) -> DataFrame:
    """The stored form of ``_replaced_snapshot``; the first day is appended to the table."""
    path, today = f"{_folder(w)}/dws_inventory_daily", w.inventory()
    sinks.replace_snapshot(today, path, date_key(AS_OF))
    before = today.withColumn("date_id", F.lit(date_key(AS_OF - timedelta(days=1))))
    before.write.mode("append").partitionBy("date_id").parquet(path)
    sinks.replace_snapshot(today.withColumn("qty", F.col("qty") + F.col("qtypurchaserem")), path, date_key(AS_OF))
    return w.spark.read.parquet(path)


def _stored_csv(w: Warehouse) -> DataFrame:
    """SKUs exported as CSV with a byte order mark and read again; their texts are never NULL, so empty ones are read as such."""
    path, sku = f"{_folder(w)}/dim_sku", w.dim_sku()
    sinks.export_csv(sku, path)
    text = w.spark.read.option("header", True).option("encoding", "UTF-8").option("nullValue", "\\N").csv(path)
    return text.toDF(*(c.lstrip(sinks.BYTE_ORDER_MARK) for c in text.columns)).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in sku.schema.fields]
    )


def _stored_migration(w: Warehouse) -> DataFrame:
    """Days stored before the table had return columns, and later days with them, read as one table."""
    path, late = f"{_folder(w)}/dws_sales_daily", F.col("date_id") >= date_key(REFRESH[0])
    old = w.sales().filter(~late).drop("return_qty", "return_amount")
    old.write.partitionBy("date_id").parquet(path)
    w.sales().filter(late).write.mode("append").partitionBy("date_id").parquet(path)
    return align_schema(w.spark.read.option("mergeSchema", "true").parquet(path), w.sales().schema)


def _stored_backfill(w: Warehouse) -> DataFrame:
    """Days stored before half of their documents had come, then computed again from the stored job's sources."""
    lo, hi, root, t = *REFRESH, _folder(w), w.all_sources()
    partly = t | {"retail": t["retail"].filter(F.col("id") % 2 == 0)}
    warehouse.backfill(partly, root, lo, hi)
    warehouse.backfill(t, root, lo, hi)
    return w.spark.read.parquet(f"{root}/dws_sales_daily").select(*w.sales().columns)


def _run_all(w: Warehouse) -> DataFrame:
    """The mart of the stored pipeline, every table written and read again, without its load stamps."""
    stored = warehouse.run_all(w.spark, w.all_sources(), _folder(w), AS_OF)["ads_inventory_health"]
    return stored.select(*w.graded().columns)


def _bucketed_sales(w: Warehouse) -> DataFrame:
    """Sales from headers and lines that are stored in buckets of the header id, so that their join moves no row."""
    buckets, made = max(w.spark.sparkContext.defaultParallelism, 8), {}
    for name, df, key in (("header", w.retail(), "id"), ("line", w.retail_item(), "retail_id")):
        place = (f"bucketed_{name}_{uuid4().hex}", f"{_folder(w)}/{name}", [key], buckets)
        sinks.write_bucketed(df, *place)
        made[name] = readers.read_bucketed(w.spark, *place)
    return facts.sales_daily(made["header"], made["line"], w.store(), w.product(), FIRST_DAY, LAST_DAY)


def _median_sketch(w: Warehouse) -> DataFrame:
    """Medians of the on-order quantities from sketches that are stored per store, held against the rows they stand for."""
    path = f"{_folder(w)}/onorder_sketches"
    sinks.overwrite_table(stock.onorder_sketches(w.stock_report()), path)
    return stock.onorder_median_check(w.stock_report(), w.spark.read.parquet(path))


def _missing(w: Warehouse) -> DataFrame:
    """Days without sales over the whole history."""
    return facts.missing_dates(w.sales(), FIRST_DAY, LAST_DAY)


def _calendar(w: Warehouse) -> DataFrame:
    return dims.dim_date(dims.days_covering(w.table("orders"), "o_orderdate"))


JOBS: dict[str, Callable[[Warehouse], DataFrame]] = {
    # dimensions
    "dim_product": lambda w: w.dim_product(),
    "dim_product_attr": lambda w: w.dim_product_attr(),
    "dim_sku": lambda w: w.dim_sku(),
    "dim_store": lambda w: w.dim_store(),
    "dim_date": _calendar,
    "dim_category": lambda w: dims.dim_category(w.product(), w.dim()),
    "dim_channel": lambda w: w.dim_channel(),
    # facts
    "sales_daily": lambda w: w.sales(),
    "inventory_daily": lambda w: w.inventory(),
    "sales_daily_net": lambda w: facts.with_net(w.sales()),
    "replace_date_range": _replaced_range,
    "stored_overwrite": _stored_store,
    "stored_replace_days": _stored_range,
    "stored_snapshot": _stored_snapshot,
    "stored_csv": _stored_csv,
    "stored_migration": _stored_migration,
    "stored_backfill": _stored_backfill,
    "stored_run_all": _run_all,
    "bucketed_sales": _bucketed_sales,
    "replace_snapshot": _replaced_snapshot,
    "sales_coverage": lambda w: facts.sales_coverage(w.sales(), *COVERAGE),
    "sales_missing_dates": _missing,
    "backfill_sales": _backfilled,
    "sales_changed_days": _changed_days,
    # inventory-health mart
    "inventory_health": lambda w: w.health(),
    "stock_totals": lambda w: health.stock_totals(w.inventory(), w.dim_store(), AS_OF),
    "sales_totals": lambda w: health.sales_totals(w.recent_sales(), w.dim_store(), AS_OF),
    "sales_totals_moved": _moved_totals,
    "turnover": lambda w: health.turnover_metrics(_sku_window(w)),
    "inventory_status": lambda w: health.stock_status(_sku_window(w)),
    "suggest_qty": lambda w: health.suggest_qty(_sku_window(w)),
    "sabc_grade": lambda w: w.graded(),
    "sales_trend": _category_trend,
    "status_summary": lambda w: health.status_summary(w.health()),
    "grade_summary": lambda w: health.grade_summary(w.graded()),
    "replenish_summary": lambda w: health.replenish_summary(w.health()),
    "export_health": lambda w: health.export_health(w.graded(), AS_OF),
    "replenish_product": lambda w: health.replenish_product(
        w.retail(WINDOW_START, AS_OF), w.retail_item(), w.storage(), w.stock_report(), w.store(), w.product(), AS_OF
    ),
    "daily_report": lambda w: reports.daily_report(w.sales(), w.dim_channel(), w.orders()),
    "sales_summary": lambda w: reports.sales_summary(
        w.sales(), w.dim_product(), w.dim_channel(), w.orders()
    ),
    # data quality
    "dq_dim_product": lambda w: quality.dq_dim_product(w.dim_product()),
    "dq_dim_store": lambda w: quality.dq_dim_store(w.dim_store()),
    "dq_inventory": lambda w: quality.dq_inventory(w.inventory(), w.dim_product(), w.dim_store(), AS_OF),
    "dq_sales": lambda w: quality.dq_sales(w.recent_sales(), AS_OF),
    "dq_health": lambda w: quality.dq_health(w.graded()),
    "health_coverage": lambda w: quality.health_coverage(w.health(), w.dim_product()),
    "inventory_coverage": lambda w: quality.inventory_coverage(w.inventory(), w.dim_product(), w.dim_store(), AS_OF),
    "table_counts": _table_counts,
    "dq_rules": _dq_rules,
    "run_checks": _run_checks,
    # purchases
    "purchase_profile": lambda w: purchase.purchase_profile(w.purchase(), w.purchase_item()),
    "purchase_sample": lambda w: purchase.purchase_sample(w.purchase()),
    "purchase_in_status": lambda w: purchase.purchase_in_status(w.purchase()),
    "purchase_datein_fill": lambda w: purchase.purchase_datein_fill(w.purchase()),
    "purchase_qtyin_stats": lambda w: purchase.purchase_qtyin_stats(w.purchase()),
    "purchase_amtin_stats": lambda w: purchase.purchase_amtin_stats(w.purchase()),
    "purchase_receiver_fill": lambda w: purchase.purchase_receiver_fill(w.purchase()),
    "purchase_receipt_compare": lambda w: purchase.purchase_receipt_compare(w.purchase()),
    "purchase_completion": lambda w: purchase.purchase_completion(w.purchase()),
    "purchase_monthly": lambda w: purchase.purchase_monthly(w.purchase()),
    "purchase_by_supplier": lambda w: purchase.purchase_by_supplier(w.purchase()),
    "purchase_by_store": lambda w: purchase.purchase_by_store(w.purchase()),
    "purchase_item_stats": lambda w: purchase.purchase_item_stats(w.purchase_item()),
    "purchase_item_completion": lambda w: purchase.purchase_item_completion(w.purchase_item()),
    "purchase_consistency": lambda w: purchase.purchase_consistency(
        w.counted_header("tot_qtyin"), w.counted_item("purchase_id", "qtyin")
    ),
    "purchase_scorecard": lambda w: purchase.purchase_scorecard(w.purchase()),
    # transfers
    "transfer_profile": lambda w: transfer.transfer_profile(w.transfer(), w.transfer_item()),
    "transfer_sample": lambda w: transfer.transfer_sample(w.transfer()),
    "transfer_by_type": lambda w: transfer.transfer_by_type(w.transfer()),
    "transfer_status": lambda w: transfer.transfer_status(w.transfer()),
    "transfer_confirm": lambda w: transfer.transfer_confirm(w.transfer()),
    "transfer_out": lambda w: transfer.transfer_out(w.transfer()),
    "transfer_in": lambda w: transfer.transfer_in(w.transfer()),
    "transfer_top_origin": lambda w: transfer.transfer_top_origin(w.transfer(), w.store()),
    "transfer_top_dest": lambda w: transfer.transfer_top_dest(w.transfer(), w.store()),
    "transfer_flow": lambda w: transfer.transfer_flow(w.transfer(), w.store()),
    "transfer_date_fill": lambda w: transfer.transfer_date_fill(w.transfer()),
    "transfer_qty_compare": lambda w: transfer.transfer_qty_compare(w.transfer()),
    "transfer_consistency": lambda w: transfer.transfer_consistency(
        w.counted_header("tot_qty"), w.counted_item("transfer_id", "qty")
    ),
    "transfer_monthly": lambda w: transfer.transfer_monthly(w.transfer()),
    "transfer_cloud": lambda w: transfer.transfer_cloud(w.transfer()),
    "transfer_cloud_direction": lambda w: transfer.transfer_cloud_direction(w.transfer(), w.store()),
    "transfer_scorecard": lambda w: transfer.transfer_scorecard(w.transfer()),
    "transfer_completed": lambda w: transfer.transfer_completed(w.transfer(), w.store()),
    # stock report
    "stock_overview": lambda w: stock.stock_overview(w.stock_report()),
    "onorder_fill": lambda w: stock.onorder_fill(w.stock_report()),
    "onorder_distribution": lambda w: stock.onorder_distribution(w.stock_report()),
    "onorder_median_sketch": _median_sketch,
    "onorder_segments": lambda w: stock.onorder_segments(w.stock_report()),
    "onorder_by_store": lambda w: stock.onorder_by_store(w.stock_report(), w.store()),
    "onorder_top_products": lambda w: stock.onorder_top_products(w.stock_report(), w.product(), w.store()),
    "stock_source_compare": lambda w: stock.stock_source_compare(
        {"FA_STORAGE": w.storage(), "RP_SIMPLESTORAGE": w.stock_report()}
    ),
    "stock_grain_match": lambda w: stock.stock_grain_match(w.storage(), w.stock_report()),
    "onorder_sample": lambda w: stock.onorder_sample(w.stock_report(), w.product(), w.store()),
    "warehouse_onorder": lambda w: stock.warehouse_onorder(w.stock_report(), w.product(), w.store()),
    "stock_with_onorder": lambda w: stock.stock_with_onorder(w.storage(), w.stock_report(), w.product(), w.store()),
    "onorder_scalar_subquery": lambda w: stock.onorder_scalar_subquery(w.stock_report(), w.store()),
    "stock_scorecard": lambda w: stock.stock_scorecard(w.stock_report()),
    "source_candidates": lambda w: stock.source_candidates(
        {"RP_SIMPLESTORAGE": w.stock_report(), "FA_STORAGE": w.storage(), "M_PURCHASE": w.purchase()}
    ),
}


def comparable(df: DataFrame) -> DataFrame:
    return df.select(
        *[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
          for f in df.schema.fields]
    )


def _query(job: Callable[[Warehouse], DataFrame]) -> Query:
    return lambda spark, folder: comparable(job(Warehouse(spark, folder)))


def queries() -> dict[str, Query]:
    return {name: _query(job) for name, job in JOBS.items()}

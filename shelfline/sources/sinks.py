"""Writers of the warehouse tables: full overwrite, replacement of a range of days, buckets, CSV export."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Load-time columns of each table.
STAMPS = {
    "dim_sku": ("updated_at",),
    "dim_store": ("created_at",),
    "dws_sales_daily": ("etl_time",),
    "dws_inventory_daily": ("etl_time",),
    "ads_inventory_health": ("etl_time", "created_at"),
}
BYTE_ORDER_MARK = "\ufeff"


def stamp(df: DataFrame, table: str) -> DataFrame:
    """Add the load-time columns; they are only set on the way into a table, so job results stay reproducible."""
    for column in STAMPS.get(table, ()):
        df = df.withColumn(column, F.current_timestamp())
    return df


def overwrite_table(df: DataFrame, path: str, on_empty: str = "replace") -> bool:
    """Replace the whole table, schema included; tells whether it was written.

    With ``on_empty="keep"`` an empty input leaves the stored table as it is.
    """
    if on_empty not in ("keep", "replace"):
        raise ValueError(f"on_empty must be 'keep' or 'replace', not {on_empty!r}")
    if on_empty == "keep" and df.isEmpty():
        return False
    df.write.mode("overwrite").parquet(path)
    return True


def _day_folders(spark: SparkSession, path: str, column: str) -> dict[str, object]:
    """Stored partition values and their folders; one entry per day, listed without reading data."""
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(path)
    system = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = system.globStatus(jvm.org.apache.hadoop.fs.Path(base, f"{column}=*")) or []
    return {status.getPath().getName().split("=", 1)[1]: (system, status.getPath()) for status in found}


def replace_days(df: DataFrame, path: str, lo, hi, column: str = "date_id", on_empty: str = "keep") -> int:
    """Replace the days [lo, hi] of a table partitioned by day; returns the number of rows written.

    Days that have rows are overwritten by dynamic partition overwrite; days of the range that have none any more are
    dropped afterwards, so nothing stale survives. An empty input leaves the range as it is (``on_empty="keep"``) or
    clears it (``"clear"``). Running the same call again gives the same table, which is also the way to recover from
    a failure between the two steps; a reader in between can see new days beside stale ones.

    The rebalance hint lets AQE split a day that is much larger than the others over several tasks and files. Row count
    and days come from observed metrics of the write itself, so the input is computed once.
    """
    if on_empty not in ("keep", "clear"):
        raise ValueError(f"on_empty must be 'keep' or 'clear', not {on_empty!r}")
    spark = df.sparkSession
    written = Observation()
    rows = df.filter(F.col(column).between(F.lit(lo), F.lit(hi))).hint("rebalance", column)
    (
        rows.observe(
            written, F.count(F.lit(1)).alias("n"), F.collect_set(F.col(column).cast("string")).alias("days")
        )
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )
    count, days = written.get["n"], set(written.get["days"])
    if count == 0 and on_empty == "keep":
        return 0
    for day, (system, folder) in _day_folders(spark, path, column).items():
        if str(lo) <= day <= str(hi) and day not in days:
            system.delete(folder, True)
    return count


def replace_snapshot(df: DataFrame, path: str, day, column: str = "date_id", on_empty: str = "keep") -> int:
    return replace_days(df, path, day, day, column, on_empty)


def write_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int) -> None:
    """Replace the table at ``path`` by files dealt out to ``buckets`` by the hash of ``keys``.

    Two tables with equal keys and numbers of buckets join or group on the keys without an exchange (``read_bucketed``).
    One exchange here places each bucket in one file; the keys are laid down sorted, so a merge join may skip its sort.
    """
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {table}")
    dealt = df.repartition(buckets, *keys)
    dealt.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(table)


def export_csv(df: DataFrame, path: str, bom: bool = True, files: int | None = None) -> None:
    """CSV with header. With ``bom`` the header starts with U+FEFF in every part file, which spreadsheet programs expect;
    ``files`` sets the number of part files (by default one per partition)."""
    out = df.repartition(files) if files else df
    if bom and df.columns:
        out = out.withColumnRenamed(df.columns[0], BYTE_ORDER_MARK + df.columns[0])
    out.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", batch_size: int = 5000, **options) -> None:
    """Write to a database table in batches, by all tasks in parallel."""
    df.write.format("jdbc").options(url=url, dbtable=table, batchsize=str(batch_size), **options).mode(mode).save()

"""Readers for the source tables: Parquet folders, JDBC tables, and the renaming of ERP columns."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ERP table and column names (lower case) and the names the jobs use for them.
ERP_COLUMNS: dict[str, dict[str, str]] = {
    "m_retail": {"c_store_id": "store_id"},
    "m_retailitem": {
        "m_retail_id": "retail_id", "m_product_id": "product_id", "m_productalias_id": "sku_id",
    },
    "fa_storage": {"c_store_id": "store_id", "m_product_id": "product_id", "m_productalias_id": "sku_id"},
    "m_product": {},
    "m_dim": {},
    "m_product_alias": {"m_product_id": "product_id", "m_attributesetinstance_id": "attr_id"},
    "m_attributesetinstance": {},
    "c_store": {
        "c_area_id": "area_id", "dm_iswarehouse": "is_warehouse", "dm_isstore": "is_store",
        "is_allo2ostorage": "is_cloud", "iscenter": "is_center",
    },
    "c_area": {},
    "m_purchase": {"c_store_id": "store_id", "c_supplier_id": "supplier_id"},
    "m_purchaseitem": {"m_purchase_id": "purchase_id"},
    "m_transfer": {"c_orig_id": "orig_id", "c_dest_id": "dest_id"},
    "m_transferitem": {"m_transfer_id": "transfer_id"},
    "rp_simplestorage": {"m_product_id": "product_id", "c_store_id": "store_id"},
}


def from_erp(df: DataFrame, table: str) -> DataFrame:
    """Rename the columns of an ERP table for the jobs; empty strings become NULL, as the ERP database stores them."""
    names = ERP_COLUMNS[table.lower()]
    columns = []
    for field in df.schema.fields:
        lower = field.name.lower()
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.CharType, T.VarcharType)):
            value = F.when(value != "", value)
        columns.append(value.alias(names.get(lower, lower)))
    return df.select(*columns)


def read_parquet(spark: SparkSession, root: str, tables: Iterable[str]) -> dict[str, DataFrame]:
    """Lazy DataFrames of ``root/<table>`` for each table."""
    return {name: spark.read.parquet(f"{root.rstrip('/')}/{name}") for name in tables}


def read_bucketed(spark: SparkSession, table: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """The table that ``write_bucketed`` left at ``path``; a session whose catalog does not know it declares it again.

    A bucket is read by one task. Where one key holds a large share of the rows, read the same files with
    ``read_parquet`` instead: they are then split by size, and the join shuffles and splits the hot key.
    """
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
        by = ", ".join(f"`{k}`" for k in keys)
        order = f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {int(buckets)} BUCKETS"
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {order} LOCATION '{path}'")
    return spark.table(table)


def jdbc_options(
    url: str, table: str, *, user: str | None = None, password: str | None = None, driver: str | None = None,
    partition_column: str | None = None, lower: object = None, upper: object = None, partitions: int | None = None,
    fetch_size: int = 10000,
) -> dict[str, str]:
    """Options for ``spark.read.format("jdbc")``; ``table`` may be a query in parentheses with an alias.

    With ``partition_column`` the table is read by ``partitions`` tasks over [lower, upper]; the bounds only place the
    stride, rows outside are still read.
    """
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), "pushDownAggregate": "true"}
    for key, value in (("user", user), ("password", password), ("driver", driver)):
        if value is not None:
            options[key] = value
    if partition_column is not None:
        if lower is None or upper is None or not partitions:
            raise ValueError("a partitioned read needs lower, upper and partitions")
        options |= {
            "partitionColumn": partition_column, "lowerBound": str(lower), "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**options)).load()

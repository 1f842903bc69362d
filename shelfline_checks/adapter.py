"""Retail source tables laid over the given test tables, so that every job runs on whole tables.

``shelfline_checks/oracle.py`` states the same mapping for the oracle engine. Column values are derived with plain expressions; the
rules that make NULLs, inactive rows, negative lines and unknown codes give every branch of the jobs something to do.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.functions import as_date

AS_OF = date(2001, 8, 1)

# Columns of the given tables; reading with a schema saves a footer-reading job per table.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,
        l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,
        l_shipdate timestamp_ntz""",
}

# Expressions used by several views.
STORE_NO = "lpad(cast(n_nationkey as string), 2, '0')"
ORDER_KEY = "year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate)"
ORDER_ACTIVE = "if(o_orderstatus = 'P' and o_orderpriority = '1-URGENT', 'N', 'Y') as isactive"
LINE_ACTIVE = "if(l_linenumber = 7, 'N', 'Y') as isactive"
LINE_ID = "l_orderkey * 8 + l_linenumber as id"
SKU = "if(l_quantity = 50, null, l_partkey * 2 + l_linenumber % 2) as sku_id"
PRIORITY = "substr(o_orderpriority, 1, 1)"
TOTAL = "cast(o_totalprice as decimal(18,2))"
UNITS = "cast(floor(o_totalprice / 1000) as bigint)"
PART_IDS = {
    "m_dim1_id": "cast(substr(p_brand, 7) as bigint) + 1000",
    "m_dim4_id": """cast(case when p_size = 50 then null when p_type = 'STANDARD' then 133 when p_type = 'MEDIUM' then 134
        when p_type = 'LARGE' then 136 when p_type = 'SMALL' then 137 when p_type = 'PROMO' then 201
        when p_type = 'ECONOMY' then 202 end as bigint)""",
    "m_dim5_id": "cast(case when p_size <= 20 then 224 when p_size <= 35 then 225 when p_size <= 45 then 127 end as bigint)",
    "m_dim6_id": "cast(if(p_size <= 25, p_size + 3000, null) as bigint)",
}
CREATED = "timestamp_ntz'2000-01-01' + make_dt_interval(p_size) as creationdate"


def pending(priority: str) -> str:
    return f"(o_orderstatus = 'P' and o_orderpriority like '{priority}%')"


def key_after(days: int) -> str:
    return f"cast(date_format(date_add(cast(o_orderdate as date), {days}), 'yyyyMMdd') as int)"


def view(build: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Build a table once per folder; asking again returns the same lazy DataFrame."""

    @wraps(build)
    def cached(self: Sources, *args) -> DataFrame:
        slot = (build.__name__, *args)
        if slot not in self.views:
            self.views[slot] = build(self, *args)
        return self.views[slot]

    return cached


class Sources:
    """Lazy source tables of one test-data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.views: dict[tuple, DataFrame] = {}

    @view
    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.folder}/{name}.parquet")

    # -- master data ---------------------------------------------------------------------------------------------

    @view
    def store(self) -> DataFrame:
        return self.table("nation").selectExpr(
            "cast(n_nationkey as bigint) as id",
            f"""case when n_nationkey = 0 then '001' when n_nationkey <= 8 then concat('DS', {STORE_NO})
                when n_nationkey <= 16 then concat('RT', {STORE_NO}) when n_nationkey <= 18 then concat('CS', {STORE_NO})
                else concat('FN', {STORE_NO}) end as code""",
            "n_name as name",
            "if(n_nationkey = 7, null, cast(n_regionkey as bigint)) as area_id",
            "case when n_nationkey = 0 or n_nationkey >= 19 then 1 when n_nationkey <= 8 then 0 end as is_warehouse",
            "case when n_nationkey between 9 and 16 then 1 end as is_store",
            "case when n_nationkey % 5 = 1 then null when n_nationkey % 3 = 0 then 'Y' else 'N' end as is_cloud",
            "case when n_nationkey = 0 then 'Y' when n_nationkey <= 8 then 'N' end as is_center",
            "if(n_nationkey = 24, 'N', 'Y') as isactive",
        )

    @view
    def area(self) -> DataFrame:
        return self.table("region").selectExpr("cast(r_regionkey as bigint) as id", "r_name as name")

    @view
    def product(self) -> DataFrame:
        return self.table("part").selectExpr(
            "p_partkey as id",
            "concat('P', lpad(cast(p_partkey as string), 10, '0')) as name",
            "if(p_size = 13, null, p_name) as value",
            *[f"{expression} as {name}" for name, expression in PART_IDS.items()],
            "if(p_size = 49, null, cast(p_retailprice as decimal(12,2))) as pricelist",
            "if(p_size < 40, split_part(p_name, ' ', 2), null) as fabelement",
            "cast(p_retailprice - 500 as decimal(12,2)) as precost",
            "if(p_size = 47, 'N', 'Y') as isactive",
            CREATED,
        )

    @view
    def dim(self) -> DataFrame:
        """Lookup of brands, categories, properties and series, from one scan of the parts."""
        labels = {
            "m_dim1_id": "p_brand",
            "m_dim4_id": "p_type",
            "m_dim5_id": "case when p_size <= 20 then 'on sale' when p_size <= 35 then 'new' end",
            "m_dim6_id": "concat('Series ', cast(p_size as string))",
        }
        entries = ", ".join(
            f"named_struct('id', {PART_IDS[name]}, 'attribname', {label})" for name, label in labels.items()
        )
        return self.table("part").selectExpr(f"inline(array({entries}))").filter("id is not null").distinct()

    @view
    def _skus(self) -> DataFrame:
        return self.table("part").selectExpr("*", "explode(array(0, 1)) as v")

    @view
    def alias(self) -> DataFrame:
        return self._skus().selectExpr(
            "p_partkey * 2 + v as id",
            "if(p_size = 46, null, concat('69', lpad(cast(p_partkey * 2 + v as string), 10, '0'))) as no",
            "p_partkey as product_id",
            "if(p_size = 45 and v = 1, null, p_partkey * 2 + v) as attr_id",
            "if(p_size = 44 and v = 0, 'N', 'Y') as isactive",
            CREATED,
        )

    @view
    def attr(self) -> DataFrame:
        return self._skus().selectExpr(
            "p_partkey * 2 + v as id",
            "split_part(p_name, ' ', 1) as value1",
            "if(v = 1, concat('S', cast(p_size as string)), null) as value2",
        )

    @view
    def channel_map(self) -> DataFrame:
        """One channel per e-commerce store code, one of them without a store."""
        return self.table("nation").filter("n_nationkey between 1 and 8").selectExpr(
            "n_nationkey as channel_id",
            "concat('Channel ', cast(n_nationkey as string)) as channel_name",
            "concat('CH', cast(n_nationkey as string)) as channel_code",
            f"if(n_nationkey = 8, 'DS99', concat('DS', {STORE_NO})) as store_code",
            "case when n_nationkey = 1 then 1 when n_nationkey <= 5 then 0 end as is_main",
            "if(n_nationkey <= 4, 'marketplace', 'own') as platform_type",
        )

    # -- sales and stock -----------------------------------------------------------------------------------------

    @view
    def retail(self, lo: date | None = None, hi: date | None = None) -> DataFrame:
        """Orders as receipts; a date range also becomes a predicate on the stored column, so the scan can skip files."""
        orders = self.table("orders")
        if lo is not None:
            first, last = (F.lit(as_date(d)).cast("timestamp_ntz") for d in (lo, hi))
            orders = orders.filter(F.col("o_orderdate").between(first, last))
        return orders.selectExpr(
            "o_orderkey as id",
            f"{ORDER_KEY} as billdate",
            "o_custkey % 25 as store_id",
            f"cast(if(o_orderpriority = '5-LOW', -{TOTAL}, {TOTAL}) as decimal(18,2)) as tot_amt_actual",
            "if(o_orderstatus = 'P', 1, 2) as status",
            ORDER_ACTIVE,
        )

    @view
    def retail_item(self) -> DataFrame:
        sign = "if(l_returnflag = 'R' and l_linenumber = 7, -1, 1)"
        listed = "cast(l_extendedprice as decimal(12,2))"
        paid = f"cast({listed} * cast(1 - l_discount as decimal(3,2)) as decimal(14,2))"
        return self.table("lineitem").selectExpr(
            "l_orderkey as retail_id",
            "l_partkey as product_id",
            SKU,
            f"cast({sign} * l_quantity as bigint) as qty",
            f"cast({sign} * {paid} as decimal(14,2)) as tot_amt_actual",
            f"cast({sign} * {listed} as decimal(14,2)) as tot_amt_list",
        )

    @view
    def storage(self) -> DataFrame:
        """Every line is a stock row; only those of open lines are active."""
        return self.table("lineitem").selectExpr(
            "l_suppkey % 25 as store_id",
            "l_partkey as product_id",
            SKU,
            """cast(case when l_quantity = 49 then null when l_suppkey % 4 = 0 then l_quantity when l_suppkey % 4 = 1 then 0
               when l_suppkey % 4 = 2 then l_quantity % 5 else l_quantity % 3 end as bigint) as qty""",
            "if(l_returnflag = 'N', cast(l_quantity as bigint), null) as qtypurchaserem",
            "if(l_linestatus = 'O' and not (l_linenumber = 7 and l_returnflag = 'A'), 'Y', 'N') as isactive",
        )

    @view
    def stock_report(self) -> DataFrame:
        """All lines per product x store; rows without an accepted or new line are inactive, so keys of either side stay alone."""
        return (
            self.table("lineitem")
            .groupBy(F.expr("l_partkey as product_id"), F.expr("l_suppkey % 25 as store_id"))
            .agg(
                F.expr("sum(if(l_returnflag in ('N', 'A'), cast(l_quantity as bigint), 0)) as qty"),
                F.expr("count_if(l_returnflag in ('N', 'A')) as lines"),
                F.expr(
                    "sum(if(l_returnflag = 'N', cast(if(l_linenumber = 7, -l_quantity, l_quantity) as bigint), null))"
                    " as qtypurchaserem"
                ),
            )
            .selectExpr("product_id", "store_id", "qty", "qtypurchaserem", "if(qty = 13 or lines = 0, 'N', 'Y') as isactive")
        )

    # -- purchases and transfers ---------------------------------------------------------------------------------

    @view
    def purchase(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "o_orderkey as id",
            f"{ORDER_KEY} as billdate",
            f"case when {pending('5')} then null when {pending('4')} then 0 else {key_after(3)} end as datein",
            "if(o_orderstatus = 'P', 1, 2) as in_status",
            f"if({pending('3')}, null, o_custkey % 25) as store_id",
            f"if({pending('2')}, null, o_custkey) as supplier_id",
            f"{UNITS} as tot_qty",
            f"""cast(case when o_orderstatus = 'F' then {UNITS}
                when o_orderstatus = 'O' then {UNITS} + case {PRIORITY} when '1' then -1 when '2' then 1 else 0 end
                when {PRIORITY} = '1' then 0 when {PRIORITY} = '2' then null else {UNITS} end as bigint) as tot_qtyin""",
            f"{TOTAL} as tot_amt_actual",
            f"""cast(case when o_orderstatus <> 'P' then {TOTAL} when {PRIORITY} <= '2' then 0 end as decimal(18,2))
                as tot_amtin_actual""",
            "if(o_orderstatus = 'P', null, o_custkey) as inerid",
            f"if({pending('5')}, null, o_orderdate) as intime",
            ORDER_ACTIVE,
            f"if({pending('4')}, null, o_orderdate) as creationdate",
        )

    @view
    def purchase_item(self) -> DataFrame:
        qty = "cast(if(l_quantity = 50, 0, l_quantity) as bigint)"
        return self.table("lineitem").selectExpr(
            LINE_ID,
            "l_orderkey as purchase_id",
            f"{qty} as qty",
            f"""cast(case when l_returnflag = 'R' then {qty} when l_returnflag = 'A' then l_quantity - 1
                when l_linestatus = 'O' then null else {qty} + 1 end as bigint) as qtyin""",
            LINE_ACTIVE,
            "l_shipdate as creationdate",
        )

    @view
    def transfer(self) -> DataFrame:
        arrived = f"(o_orderstatus = 'F' or (o_orderstatus = 'O' and {PRIORITY} >= '4'))"
        return self.table("orders").selectExpr(
            "o_orderkey as id",
            "concat('TF', lpad(cast(o_orderkey as string), 12, '0')) as docno",
            f"case when {pending('5')} then null when {pending('4')} then 0 else {ORDER_KEY} end as billdate",
            """case o_custkey % 9 when 0 then 'ORD' when 1 then 'NOR' when 2 then 'ADD' when 3 then 'DIF' when 4 then 'OUT'
               when 5 then 'IN' when 6 then 'EOR' when 7 then 'XXX' end as transfertype""",
            "o_custkey % 27 as orig_id",
            f"if({pending('3')}, null, o_orderkey % 25) as dest_id",
            f"{UNITS} as tot_qty",
            f"if(o_orderstatus = 'P', 0, {UNITS}) as tot_qtyout",
            f"""cast(case when o_orderstatus = 'F' then {UNITS} when o_orderstatus = 'P' then 0
                when {PRIORITY} = '1' then {UNITS} - 1 when {PRIORITY} = '2' then 0 else {UNITS} end as bigint) as tot_qtyin""",
            f"{TOTAL} as tot_amtqty_list",
            f"case {PRIORITY} when '1' then 1 when '2' then 3 when '3' then null else 2 end as status",
            "if(o_orderstatus = 'P', 1, 2) as confirm_status",
            "if(o_orderstatus = 'P', 1, 2) as out_status",
            f"if({arrived}, 2, 1) as in_status",
            f"if(o_orderstatus = 'P', null, {key_after(1)}) as dateout",
            f"if({arrived}, {key_after(2)}, null) as datein",
            ORDER_ACTIVE,
            f"if({pending('4')}, null, o_orderdate) as creationdate",
        )

    @view
    def transfer_item(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            LINE_ID, "l_orderkey as transfer_id", "cast(l_quantity as bigint) as qty", LINE_ACTIVE,
            "l_shipdate as creationdate",
        )

    @view
    def counted_header(self, total: str) -> DataFrame:
        """Document headers whose total is counted from the active lines: exact, one too many, or missing by status."""
        lines = (
            self.table("lineitem")
            .filter("l_linenumber <> 7")
            .groupBy("l_orderkey")
            .agg(F.expr("sum(cast(l_quantity as bigint)) as n"))
        )
        return self.table("orders").join(lines, F.expr("o_orderkey = l_orderkey"), "left").selectExpr(
            "o_orderkey as id",
            f"""case when {pending('3')} then null when o_orderpriority = '2-HIGH' then coalesce(n, 0) + 1
                else coalesce(n, 0) end as {total}""",
            ORDER_ACTIVE,
        )

    @view
    def counted_item(self, key: str, qty: str) -> DataFrame:
        return self.table("lineitem").selectExpr(
            f"l_orderkey as {key}", f"cast(l_quantity as bigint) as {qty}", LINE_ACTIVE
        )

    def all_sources(self) -> dict[str, DataFrame]:
        return {
            "store": self.store(), "area": self.area(), "product": self.product(), "dim": self.dim(),
            "alias": self.alias(), "attr": self.attr(), "retail": self.retail(), "item": self.retail_item(),
            "storage": self.storage(),
        }

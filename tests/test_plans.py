"""Shapes of physical plans that have to hold at scale."""

from __future__ import annotations

import re

import pytest

from shelfline_checks.queries import Warehouse, queries
from shelfline.operators import facts, stock, transfer
from shelfline_checks.adapter import AS_OF

FOLDER = "/root/testdata/sf0.001"


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def warehouse(spark):
    return Warehouse(spark, FOLDER)


@pytest.fixture
def no_broadcast(spark):
    """As if no side were small enough to be broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_scans_read_only_needed_columns(warehouse):
    plan = physical(warehouse.inventory())
    lineitem = next(scan for scan in re.findall(r"FileScan parquet \[([^\]]*)\]", plan) if "l_suppkey" in scan)
    assert "l_shipdate" not in lineitem and "l_extendedprice" not in lineitem and "l_tax" not in lineitem
    # The view keeps every line as a stock row; the job's own filter is the only one.
    assert "EqualTo(l_linestatus" not in plan and "isactive" not in lineitem


def test_date_range_reaches_the_scan(warehouse):
    assert "GreaterThanOrEqual(o_orderdate,2001-07-02" in physical(warehouse.recent_sales())


def test_small_filters_run_before_the_aggregation(warehouse):
    """Small products and stores: the semi joins sit on the scan of the lines, below the first aggregate."""
    plan = physical(warehouse.sales())
    semi, aggregate = plan.rindex("LeftSemi"), plan.rindex("HashAggregate")
    assert plan.count("LeftSemi") == 2 and semi > aggregate


def test_large_products_only_meet_aggregated_rows(warehouse, no_broadcast):
    plan = physical(warehouse.sales())
    product_join = plan.index("LeftSemi")
    assert product_join < plan.index("HashAggregate") and "BroadcastExchange" not in plan


@pytest.mark.parametrize("name", ["sales", "inventory", "recent_sales", "health", "dim_product", "dim_sku", "dim_product_attr"])
def test_nothing_runs_in_one_partition(spark, name):
    plan = physical(getattr(Warehouse(spark, FOLDER), name)())
    assert "SinglePartition" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.fixture
def eager_skew_handling(spark, no_broadcast):
    """Skew thresholds scaled down to test data."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2.0",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) if k == "spark.sql.shuffle.partitions" else None for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v else spark.conf.unset(k)


def test_a_hot_order_is_split(spark, frame, eager_skew_handling):
    """A third of all lines in one order: AQE splits its partition, and the result is that of an even spread."""
    item = spark.range(60000, numPartitions=8).selectExpr(
        "if(id % 3 = 0, 7, id % 20000) as retail_id", "cast(100 as bigint) as product_id", "id % 50 as sku_id",
        "cast(1 as decimal(18,4)) as qty", "cast(2 as decimal(18,2)) as tot_amt_actual", "cast(3 as decimal(18,2)) as tot_amt_list",
    )
    retail = spark.range(20000).selectExpr(
        "id", "20260110 as billdate", "2 + id % 2 as store_id", "cast(if(id % 5 = 4, -9, 9) as decimal(18,2)) as tot_amt_actual",
        "2 as status", "'Y' as isactive",
    )
    store = frame([(2, "DS01", "N"), (3, "RT01", "Y")], "id bigint, code string, is_cloud string")
    product = frame([(100, 134)], "id bigint, m_dim4_id bigint")
    out = facts.sales_daily(retail, item, store, product, 20260101, 20260131)
    rows = out.collect()
    assert sum(r.sales_qty + r.return_qty for r in rows) == 60000
    orders = item.filter("retail_id % 5 <> 4").selectExpr("retail_id % 2 + 2 as store_id", "retail_id", "sku_id").distinct()
    counted = {(r.store_id, r.sku_id): r["count"] for r in orders.groupBy("store_id", "sku_id").count().collect()}
    assert {(r.store_id, r.m_productalias_id): r.order_count for r in rows if r.order_count} == counted
    assert "skew=true" in physical(out)


def test_stock_and_sales_totals_join_without_another_shuffle(warehouse, no_broadcast):
    plan = physical(warehouse.health())
    keys = re.findall(r"Exchange hashpartitioning\(product_id#\d+L, (?:sku_id|m_productalias_id)#\d+L", plan)
    assert len(keys) == 2  # one per aggregation; the join on both keys reuses their partitioning


def test_top_rows_are_found_before_names_are_joined(warehouse):
    plan = physical(stock.onorder_top_products(warehouse.stock_report(), warehouse.product(), warehouse.store()))
    assert plan.rindex("TakeOrderedAndProject") > plan.rindex("LeftOuter")


def test_transfers_are_reduced_before_the_store_joins(warehouse):
    plan = physical(transfer.transfer_flow(warehouse.transfer(), warehouse.store()))
    assert plan.rindex("HashAggregate") > plan.rindex("LeftOuter")


def test_grain_match_needs_one_shuffle_per_row(warehouse):
    plan = physical(stock.stock_grain_match(warehouse.storage(), warehouse.storage()))
    assert plan.count("Exchange hashpartitioning") == 1 and "FullOuter" not in plan


def test_coverage_is_lazy_and_unsorted(warehouse):
    plan = physical(facts.sales_coverage(warehouse.sales(), AS_OF, AS_OF))
    assert "rangepartitioning" not in plan


def test_no_query_depends_on_broadcasts(spark, no_broadcast):
    """With every table too large to broadcast: no cross or nested-loop joins, no Python operators, and the only forced
    broadcast is the one row per slice of the running totals."""
    forced = set()
    for name, query in queries().items():
        plan = physical(query(spark, FOLDER))
        assert not re.search("CartesianProduct|NestedLoop|Python|InPandas", plan), name
        if "BroadcastExchange" in plan:
            forced.add(name)
    assert forced == {"sabc_grade", "grade_summary", "export_health", "dq_health", "onorder_distribution"}


def final(df) -> str:
    """The plan as it ran, without the parts that another place has already run."""
    df.collect()
    plan = physical(df)
    return plan[: plan.index("== Initial Plan ==")]


def test_grading_moves_narrow_rows_once_by_slice(spark, warehouse):
    """Three readers share one evaluation; the sources are scanned once, no names move and nothing runs before the result is used."""
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    graded = warehouse.graded()
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before
    plan = final(graded)
    by_slice = [line for line in plan.splitlines() if re.search(r"Exchange hashpartitioning\(_slice", line) and "ReusedExchange" not in line]
    assert len(by_slice) == 1
    assert plan.count("FileScan parquet [l_") <= 2  # stock and sales; other readers reuse their exchanges
    ranked = plan[plan.index("RoundRobinPartitioning") :].splitlines()[1]
    assert "product_name" not in ranked and "sku_barcode" not in ranked


def test_replacement_scans_the_new_facts_once(warehouse):
    from shelfline.functions import date_key
    from shelfline.plans import refresh
    from shelfline_checks.queries import REFRESH

    lo, hi = REFRESH
    fresh = warehouse.sales(lo, hi)
    stored = fresh.sparkSession.createDataFrame(fresh.head(5), fresh.schema)
    out = refresh.replace_range(stored, fresh, date_key(lo), date_key(hi))
    assert out.count() == fresh.count()
    assert final(out).count("FileScan parquet [l_") == 1

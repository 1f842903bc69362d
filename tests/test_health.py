from __future__ import annotations

from datetime import date, timedelta
from decimal import Decimal

import pytest
from conftest import values
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfline.functions import as_date, date_key
from shelfline.operators import health
from shelfline.operators.prefix import exact_median, running_totals, sliced_totals

AS_OF = date(2026, 3, 5)
INVENTORY = "date_id int, store_id bigint, product_id bigint, m_productalias_id bigint, qty bigint, qtypurchaserem bigint"
SALES = """date_id int, store_id bigint, product_id bigint, m_productalias_id bigint, sales_qty bigint,
    sales_amount decimal(18,2), return_qty bigint, return_amount decimal(18,2)"""
PRODUCT = """product_id bigint, product_code string, product_name string, category_id bigint, category_name string,
    property_id bigint, property_name string, series_id bigint, series_name string, price_list decimal(12,2),
    is_main_product string"""
SKU = "sku_id bigint, sku_barcode string, sku_color string, sku_size string"
STORE = "store_id bigint, store_code string, is_cloud_store string"
D = Decimal


def product_row(id, main="Y"):
    return (id, f"P{id}", "name", 134, "cat", 224, "prop", 1, "ser", D("9.90"), main)


@pytest.fixture(scope="module")
def store(frame):
    return frame([(1, "001", "N"), (2, "DS01", "N"), (3, "RT01", "Y"), (4, "RT02", "N"), (5, "001", "Y")], STORE)


def test_windows_cover_31_and_8_days(frame, store):
    days = {20260202: "out", 20260203: "30", 20260225: "30", 20260226: "7", 20260305: "7", 20260306: "out"}
    sales = frame([(d, 2, 1, 10, 1, D("1.00"), 0, D("0.00")) for d in days], SALES)
    row = health.sales_totals(sales, store, AS_OF).first()
    assert (row.sales_qty_30d, row.sales_qty_7d) == (4, 2)


def test_moved_totals_equal_the_whole_window_for_ten_days(frame, store):
    """Each day goes on from the one before; on the fifth, rows of an earlier day are computed again."""
    days = [as_date(20260115) + timedelta(days=i) for i in range(60)]
    rows = [(date_key(d), 2 + i % 3, 1, 10 + (i * j) % 7, j, D(j), i % 2, D(i)) for i, d in enumerate(days) for j in range(3)]
    sales = frame(rows, SALES)
    columns = ["product_id", "sku_id", "sales_qty_30d", "sales_amt_30d", "sales_qty_7d", "return_qty_30d", "return_amount_30d"]
    stored = health.window_totals(sales, store, AS_OF)
    assert values(stored, *columns) == values(health.sales_totals(sales, store, AS_OF), *columns)
    for step in range(1, 11):
        day, replaced = AS_OF + timedelta(days=step), None
        if step == 5:
            late = F.col("date_id") == 20260301
            again = [*rows, (20260301, 3, 1, 99, 4, D(4), 0, D(0))]
            fresh = frame(again, SALES)
            replaced, sales = (sales.filter(late), fresh.filter(late)), fresh
        moved = health.moved_totals(stored, sales, store, day - timedelta(days=1), day, replaced=replaced)
        stored = frame([tuple(r) for r in moved.collect()], moved.schema)
        assert values(stored, *columns) == values(health.sales_totals(sales, store, day), *columns), day
    with pytest.raises(ValueError):
        health.moved_totals(stored, sales, store, AS_OF, AS_OF - timedelta(days=1))


def test_scopes_of_stock_and_sales_differ(frame, store):
    stock = frame([(20260305, s, 1, 10, 10 ** (s - 1), s) for s in range(1, 6)] + [(20260304, 1, 1, 10, 5, 5)], INVENTORY)
    row = health.stock_totals(stock, store, AS_OF).first()
    assert (row.total_qty, row.warehouse_qty, row.cloud_qty, row.purchase_rem_qty) == (10101, 10001, 10100, 1 + 3 + 5)
    sales = frame([(20260305, s, 1, 10, 10 ** (s - 1), D("1.00"), 0, D("0.00")) for s in range(1, 6)], SALES)
    assert health.sales_totals(sales, store, AS_OF).first().sales_qty_30d == 10110


METRICS = "total_qty bigint, sales_qty_30d bigint, sales_qty_7d bigint, return_qty_30d bigint, purchase_rem_qty bigint"


@pytest.mark.parametrize(
    "stock, sold, status, priority, days",
    [
        (5, 0, "滞销", 5, "9999.0"), (0, 0, "停售", 6, "9999.0"), (-3, 0, "库存过高", 4, "9999.0"),
        (0, 10, "紧急缺货", 1, "0.0"), (9, 10, "紧急缺货", 1, "27.0"), (10, 10, "需补货", 2, "30.0"),
        (23, 10, "需补货", 2, "69.0"), (24, 10, "正常", 3, "72.0"), (30, 10, "正常", 3, "90.0"),
        (31, 10, "库存过高", 4, "93.0"), (-3, 10, "紧急缺货", 1, "-9.0"), (7, 3, "正常", 3, "70.0"),
        (5, -10, "紧急缺货", 1, "-15.0"), (-40, -10, "库存过高", 4, "120.0"),
    ],
)
def test_status_boundaries(frame, stock, sold, status, priority, days):
    df = frame([(stock, sold, 0, 0, 0)], METRICS)
    row = health.stock_status(health.turnover_metrics(df)).first()
    assert (row.inventory_status, row.status_priority, row.turnover_days) == (status, priority, D(days))


def test_suggestion(frame):
    rows = [(10, 10, 0, 2, 3), (30, 10, 0, 0, 0), (5, 10, 0, 40, 0), (5, 0, 0, 1, 1), (29, 10, 0, 0, 5), (-5, 10, 0, 0, 0)]
    out = health.suggest_qty(frame(rows, METRICS)).collect()
    assert [r.suggest_qty for r in out] == [15, 0, -15, 0, -4, 35]


def test_trend_uses_the_rounded_velocity(frame):
    # velocity = 30 * s7 / (7 * s30); 1.295 exactly would be 2590 / 2000, so pairs that round to the cut are used
    pairs = {(0, 0): "无销售", (0, 10): "快速下滑", (7, 30): "稳定", (1, 3): "快速上升", (16, 100): "快速下滑"}
    pairs |= {(259, 857): "快速上升", (49, 300): "降温", (48, 300): "快速下滑", (69, 300): "降温", (70, 300): "稳定"}
    pairs |= {(91, 300): "快速上升", (90, 300): "稳定"}
    df = frame([(0, s30, s7, 0, 0) for s7, s30 in pairs], METRICS)
    out = health.sales_trend(health.turnover_metrics(df)).collect()
    assert {(r.sales_qty_7d, r.sales_qty_30d): r.sales_trend for r in out} == pairs
    edge = next(r for r in out if r.sales_qty_7d == 259)
    assert edge.sales_velocity == D("1.30") and 30 * 259 / (7 * 857) < 1.3
    assert next(r for r in out if r.sales_qty_30d == 0).sales_velocity is None


def graded(frame, amounts, slices=None):
    rows = [(i + 1, 1, D(str(a))) for i, a in enumerate(amounts)]
    df = frame(rows, "sku_id bigint, product_id bigint, sales_amt_30d decimal(18,2)")
    return {r.sku_id: r for r in health.sabc_grade(df, slices=slices).collect()}


def test_grades_at_the_cuts(frame):
    out = graded(frame, [30, 40, 20, 10])
    assert out[2].sku_grade == "S" and out[2].sales_rank == 1  # nothing before it
    assert out[1].sku_grade == "A" and out[1].cumulative_ratio == D("70.00")  # exactly .70 including it
    assert out[3].sku_grade == "B" and out[3].cumulative_ratio == D("90.00")
    assert out[4].sku_grade == "C" and out[4].cumulative_ratio == D("100.00")


def test_grade_jumps_from_s_range_to_b(frame):
    out = graded(frame, [31, 45, 24])
    assert out[2].sku_grade == "S"
    assert out[1].sku_grade == "B" and out[1].cumulative_ratio == D("76.00")  # .45 before it, .76 with it


def test_grade_ties_zero_and_single(frame):
    tie = graded(frame, [50, 50])
    assert (tie[1].sales_rank, tie[2].sales_rank) == (1, 2)
    zero = graded(frame, [0, 0])
    assert {r.sku_grade for r in zero.values()} == {"C"} and zero[1].sales_ratio is None and zero[1].cumulative_ratio is None
    assert graded(frame, [7])[1].sku_grade == "S" and graded(frame, [7])[1].sales_ratio == D("100.00")
    mixed = graded(frame, [10, 0])
    assert mixed[2].sku_grade == "C" and mixed[2].cumulative_ratio == D("100.00")


@pytest.mark.parametrize("slices", [1, 2, 7, None])
def test_running_totals_equal_the_plain_window(frame, slices):
    """Also with one amount on a third of the rows: it may span slices because the key follows the amount."""
    rows = [(i, i % 5, D(0) if i % 3 == 0 else D((i * 7919) % 101)) for i in range(400)]
    df = frame(rows, "sku_id bigint, product_id bigint, amt decimal(18,2)")
    order = [F.col("amt").desc_nulls_last(), F.col("sku_id").asc(), F.col("product_id").asc()]
    got = running_totals(df, order, "amt", "cum", "rank", "total", slices)
    w = Window.orderBy(*order)
    want = (
        df.withColumn("cum", F.sum("amt").over(w.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("rank", F.row_number().over(w).cast("long"))
        .withColumn("total", F.sum("amt").over(Window.partitionBy()))
    )
    columns = ("sku_id", "amt", "cum", "rank", "total")
    assert values(got, *columns) == values(want, *columns) and got.count() == 400
    ranks = sorted(r["rank"] for r in got.collect())
    assert ranks == list(range(1, 401))


@pytest.mark.parametrize("slices", [1, 2, 7, None])
def test_sliced_totals_equal_the_plain_window(frame, slices):
    """A third of the rows share the first amount and a tenth of the SKUs are NULL."""
    rows = [(None if i % 10 == 9 else i, i, D(0) if i % 3 == 0 else D((i * 7919) % 101)) for i in range(400)]
    df = frame(rows, "sku_id bigint, product_id bigint, amt decimal(18,2)").repartition(3)
    got = sliced_totals(df, [-F.col("amt"), F.col("sku_id").isNull(), F.col("sku_id"), F.col("product_id")], "amt", "cum", "rank", "total", slices)
    w = Window.orderBy(F.col("amt").desc(), F.col("sku_id").asc_nulls_last(), "product_id")
    want = (
        df.withColumn("cum", F.sum("amt").over(w.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("rank", F.row_number().over(w).cast("long"))
        .withColumn("total", F.sum("amt").over(Window.partitionBy()))
    )
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=lambda r: r[4]) == sorted(map(tuple, want.collect()), key=lambda r: r[4])


def test_many_slices_are_searched_by_halving(frame):
    """A row meets as many bounds as it takes to halve them away, once per reader; the sample passes no single task's limit."""
    rows = [(None if i % 10 == 9 else i, i, D(i // 40)) for i in range(120)]
    df = frame(rows, "sku_id bigint, product_id bigint, amt decimal(18,2)").repartition(3)
    order = [-F.col("amt"), F.col("sku_id").isNull(), F.col("sku_id"), F.col("product_id")]
    got = sliced_totals(df, order, "amt", "cum", "rank", "total", 600)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "size(filter(" not in plan and "GlobalLimit" not in plan
    assert plan.count("aggregate([512,256,128,64,32,16,8,4,2,1]") == 2
    w = Window.orderBy(F.col("amt").desc(), F.col("sku_id").asc_nulls_last(), "product_id")
    want = df.withColumn("cum", F.sum("amt").over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("rank", F.row_number().over(w))
    assert values(got, "product_id", "cum", "rank") == values(want, "product_id", "cum", "rank") and got.count() == 120


def test_sliced_totals_of_nothing_and_of_one(frame):
    ddl = "sku_id bigint, amt bigint"
    assert sliced_totals(frame([], ddl), [F.col("sku_id")], "amt", "cum", "rank", "total").count() == 0
    assert values(sliced_totals(frame([(1, None)], ddl), [F.col("sku_id")], "amt", "cum", "rank", "total"), "cum", "rank") == {(0, 1)}


def test_running_totals_of_nothing(frame):
    df = frame([], "sku_id bigint, amt bigint")
    assert running_totals(df, [F.col("sku_id").asc()], "amt", "cum", "rank", "total").count() == 0


@pytest.mark.parametrize(
    "numbers, expected", [([3], 3), ([1, 2], 1.5), ([5, 1, 3], 3), ([1] * 9 + [7, 9, 9], 1), ([1, 1, 4, 9], 2.5), ([], None)]
)
def test_exact_median(frame, numbers, expected):
    df = frame([(n,) for n in [*numbers, None]], "v bigint")
    assert exact_median(df, "v").first()[0] == expected


@pytest.fixture(scope="module")
def mart(frame, store):
    inventory = frame(
        [
            (20260305, 1, 1, 10, 20, 5), (20260305, 3, 1, 10, 5, 0), (20260305, 1, 2, 10, 7, 0),  # one SKU id, two products
            (20260305, 1, 1, 11, 0, 0), (20260305, 1, 3, 30, 9, 0), (20260305, 1, 4, 40, 3, 0), (20260304, 1, 1, 12, 3, 0),
        ],
        INVENTORY,
    )
    sales = frame(
        [
            (20260301, 2, 1, 10, 4, D("400.00"), 1, D("10.00")), (20260210, 3, 1, 10, 6, D("600.00"), 0, D("0.00")),
            (20260301, 2, 2, 10, 1, D("50.00"), 0, D("0.00")), (20260301, 4, 1, 11, 9, D("9.00"), 0, D("0.00")),
        ],
        SALES,
    )
    product = frame([product_row(1), product_row(2), product_row(3, "N")], PRODUCT)
    sku = frame([(10, "bar", "red", "M")], SKU)
    return health.graded_health(inventory, sales, product, sku, store, AS_OF)


def test_mart_rows(mart):
    rows = {(r.product_id, r.sku_id): r for r in mart.collect()}
    assert set(rows) == {(1, 10), (2, 10), (1, 11)}  # not main and unknown products are out; other days too
    first = rows[1, 10]
    assert first.snapshot_date == AS_OF and (first.total_qty, first.warehouse_qty, first.cloud_qty) == (25, 20, 5)
    assert (first.sales_qty_30d, first.sales_qty_7d, first.sales_amt_30d) == (10, 4, D("1000.00"))
    assert (first.return_qty_30d, first.return_amount_30d, first.purchase_rem_qty) == (1, D("10.00"), 5)
    assert (first.turnover_days, first.inventory_status, first.suggest_qty) == (D("75.0"), "正常", 30 - 25 - 1 - 5)
    assert (first.daily_avg_sales, first.daily_avg_sales_7d, first.sales_velocity) == (D("0.33"), D("0.57"), D("1.71"))
    assert (first.sales_rank, first.sku_grade, first.sales_trend) == (1, "S", "快速上升")
    assert (first.sku_barcode, first.color, first.size) == ("bar", "red", "M")
    second, third = rows[2, 10], rows[1, 11]
    assert (second.sales_rank, second.sku_grade, second.sales_ratio) == (2, "C", D("4.76"))
    assert (third.sku_barcode, third.sales_qty_30d, third.inventory_status, third.sku_grade) == (None, 0, "停售", "C")
    assert third.sales_velocity is None and third.sales_trend == "无销售" and third.suggest_qty == 0


def test_summaries(mart):
    assert [tuple(r) for r in health.status_summary(mart).collect()] == [
        ("正常", 1, 25), ("库存过高", 1, 7), ("停售", 1, 0),
    ]
    assert [tuple(r) for r in health.grade_summary(mart).collect()] == [("S", 1, 10), ("C", 2, 1)]
    row = health.replenish_summary(mart).first()
    assert (row.sku_with_rem, row.total_rem_qty, row.total_positive_suggest, row.total_negative_suggest) == (1, 5, 0, -1)
    assert row.total_suggest_qty == row.total_positive_suggest + row.total_negative_suggest and row.sku_with_negative == 1


def test_export_columns(mart):
    out = health.export_health(mart.withColumn("etl_time", F.current_timestamp()), AS_OF)
    assert out.columns == list(health.EXPORT_COLUMNS) and len(out.columns) == 21 and out.count() == 3
    assert health.export_health(mart, date(2026, 3, 4)).count() == 0


def test_replenish_product(frame):
    retail = frame(
        [(1, 20260301, 2, D("10.00"), 2, "Y"), (2, 20260302, 2, D("-5.00"), 2, "Y"), (3, 20260101, 2, D("10.00"), 2, "Y")],
        "id bigint, billdate int, store_id bigint, tot_amt_actual decimal(18,2), status int, isactive string",
    )
    item = frame([(1, 7, 10), (2, 7, -1), (1, 8, 4), (3, 9, 50), (1, 5, 3)], "retail_id bigint, product_id bigint, qty bigint")
    storage = frame([(1, 7, 12, "Y"), (2, 7, 99, "Y"), (1, 8, 40, "Y")], "store_id bigint, product_id bigint, qty bigint, isactive string")
    report = frame([(7, 1, 2, "Y"), (7, 2, 50, "Y")], "product_id bigint, store_id bigint, qtypurchaserem bigint, isactive string")
    store = frame([(1, "001", "N"), (2, "DS01", "N")], "id bigint, code string, is_cloud string")
    product = frame(
        [(7, "P7", "a", "Y"), (8, "P8", "b", "Y"), (9, "P9", "c", "Y"), (5, "P5", "d", "N")],
        "id bigint, name string, value string, isactive string",
    )
    out = health.replenish_product(retail, item, storage, report, store, product, AS_OF).collect()
    assert [(r.product_code, r.suggest_qty) for r in out] == [("P7", 30 - 12 - 1 - 2), ("P8", 0)]  # never below 0
    assert out[0].turnover_days == D("36.0") and out[0].daily_avg_sales == D("0.3333")

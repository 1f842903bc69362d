from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from conftest import values

from shelfline.operators import quality, reports

D = Decimal
SALES = """date_id int, store_id bigint, store_code string, is_cloud_store string, product_id bigint, m_productalias_id bigint,
    sales_qty bigint, sales_amount decimal(18,2), sales_amount_list decimal(18,2), return_qty bigint,
    return_amount decimal(18,2), order_count bigint"""
ORDERS = "date_id int, store_code string, product_id bigint, retail_id bigint"
CHANNEL = "channel_id int, channel_name string, store_code string"


def sale(day, code="DS01", sku=10, product=1, qty=1, amount="100.00", back="0.00", orders=1):
    return (day, 2, code, "N", product, sku, qty, D(amount), D("200.00"), 0, D(back), orders)


@pytest.fixture(scope="module")
def channel(frame):
    return frame([(1, "one", "DS01"), (2, "two", "DS02")], CHANNEL)


def test_daily_report_compares_days(frame, channel):
    sales = frame(
        [
            sale(20230228, amount="80.00"), sale(20240228, amount="50.00"), sale(20240229, amount="100.00", back="25.00", orders=2),
            sale(20240229, code="DS02", amount="40.00"), sale(20240229, code="XX", amount="7.00"), sale(20240301, amount="0.00", orders=0),
        ],
        SALES,
    )
    orders = frame([(20230228, "DS01", 1, 1), (20240228, "DS01", 1, 2), (20240229, "DS01", 1, 3), (20240229, "DS01", 2, 3), (20240229, "DS01", 1, 4), (20240229, "DS02", 1, 5)], ORDERS)
    rows = {(r.report_date, r.channel_id): r for r in reports.daily_report(sales, channel, orders).collect()}
    assert {k: r.order_count for k, r in rows.items() if k[0] == date(2024, 2, 29)} == {(date(2024, 2, 29), 1): 2, (date(2024, 2, 29), 2): 1, (date(2024, 2, 29), None): 0}
    assert len(rows) == 6
    leap = rows[date(2024, 2, 29), 1]
    assert (leap.sales_amount_yoy, leap.yoy_growth) == (D("80.00"), D("25.00"))  # 28 February the year before
    assert (leap.sales_amount_mom, leap.mom_growth) == (D("50.00"), D("100.00"))
    assert (leap.net_amount, leap.avg_price, leap.return_rate, leap.discount_rate) == (D("75.00"), D("50.00"), D("25.00"), D("50.00"))
    assert rows[date(2024, 2, 28), 1].sales_amount_yoy == D("80.00")
    assert rows[date(2024, 2, 29), 2].sales_amount_mom is None  # other channels are not mixed in
    assert rows[date(2024, 2, 29), None].sales_amount == D("7.00")
    empty = rows[date(2024, 3, 1), 1]
    assert (empty.avg_price, empty.return_rate, empty.sales_amount_mom) == (None, None, D("100.00"))


def test_sales_summary_grains(frame, channel):
    sales = frame(
        [sale(20240129, sku=10), sale(20240131, sku=10), sale(20240201, sku=11, amount="50.00"), sale(20240201, sku=12, qty=0, amount="0.00")],
        SALES,
    )
    product = frame([(1, 134, "rings")], "product_id bigint, category_id bigint, category_name string")
    orders = frame([(20240129, "DS01", 1, 1), (20240131, "DS01", 1, 2), (20240201, "DS01", 1, 3)], ORDERS)
    out = reports.sales_summary(sales, product, channel, orders)
    assert values(out, "granularity", "report_date", "sales_amount", "sku_count", "order_count") == {
        ("day", date(2024, 1, 29), D("100.00"), 1, 1), ("day", date(2024, 1, 31), D("100.00"), 1, 1),
        ("day", date(2024, 2, 1), D("50.00"), 1, 1), ("week", date(2024, 1, 29), D("250.00"), 2, 3),
        ("month", date(2024, 1, 1), D("200.00"), 1, 2), ("month", date(2024, 2, 1), D("50.00"), 1, 1),
    }


def test_dim_checks(frame):
    ddl = "product_code string, product_name string, category_id bigint, is_main_product string, is_active string"
    good, bad = ("a", "b", 1, "Y", "Y"), ("a", None, 1, "N", "Y")
    assert quality.dq_dim_product(frame([good], ddl)).first().status == "PASS"
    row = quality.dq_dim_product(frame([good, bad], ddl)).first()
    assert (row.total, row.main_products, row.null_name, row.status) == (2, 1, 1, "WARNING")
    stores = "store_code string, store_type string, is_cloud_store string"
    rows = [("001", "总仓", "N"), ("DS1", "电商", "Y"), ("DS2", "电商", "N")]
    out = [tuple(r) for r in quality.dq_dim_store(frame(rows, stores)).collect()]
    assert out == [("电商", 2, 3, 1, 1, "PASS"), ("总仓", 1, 3, 1, 1, "PASS")]
    assert values(quality.dq_dim_store(frame(rows[1:], stores)), "status") == {("FAIL",)}


def test_sales_check_uses_real_dates(frame):
    """30 days before 5 March is 3 February; 20260305 - 30 as an integer would start at 20260275."""
    row = quality.dq_sales(frame([sale(20260203), sale(20260202), sale(20260301, amount="-1.00"), sale(20260301, code="RT1")], SALES), 20260305).first()
    assert (row.rows_30d, row.sales_amount, row.negative_rows, row.status) == (3, D("99.00"), 1, "WARNING")


@pytest.mark.parametrize("found, status", [(2503, "PASS"), (2513, "PASS"), (2502, "WARNING"), (2514, "WARNING")])
def test_expected_rows_with_tolerance(spark, frame, found, status):
    inventory = spark.range(found).selectExpr("20260305 as date_id", "cast(1 as bigint) as store_id", "id as product_id")
    product = spark.range(found).selectExpr("id as product_id", "'Y' as is_main_product")
    store = frame([(1, "001", "N")], "store_id bigint, store_code string, is_cloud_store string")
    row = quality.dq_inventory(inventory, product, store, 20260305).first()
    assert (row.main_products, row.difference, row.status) == (found, found - 2508, status)
    covered = quality.inventory_coverage(inventory, product, store, 20260305).first()
    assert (covered.products_with_stock, covered.stock_rows, covered.main_products) == (found, found, found)


HEALTH = """inventory_status string, sku_grade string, suggest_qty bigint, total_qty bigint, sales_amt_30d decimal(18,2),
    turnover_days decimal(20,1)"""


def test_health_checks(frame):
    health = frame(
        [("正常", "S", 5, 10, D("9.00"), D("30.0")), ("正常", "C", -2, 10, D("0.00"), D("2000.0")),
         ("停售", "C", 0, 0, D("0.00"), D("9999.0")), ("库存过高", "C", 0, -1, D("0.00"), D("-1.0"))],
        HEALTH,
    )
    assert values(quality.dq_health(health), "section", "item", "value", "status") == {
        ("rows", "total", 4, "WARNING"), ("status", "正常", 2, "PASS"), ("status", "停售", 1, "PASS"), ("status", "库存过高", 1, "PASS"),
        ("grade", "S", 1, "PASS"), ("grade", "C", 3, "PASS"), ("replenish", "restock", 5, "PASS"),
        ("replenish", "surplus", -2, "PASS"), ("replenish", "surplus_sku", 1, "PASS"),
    }
    row = quality.health_coverage(health, frame([("Y",), ("N",)], "is_main_product string")).first()
    assert (row.total, row.with_stock_or_sales, row.zero_both, row.stopped, row.main_products, row.difference) == (4, 2, 1, 1, 1, -2504)


def test_rules(frame):
    health = frame([("正常", "S", 0, 1, D("1.00"), D(days)) for days in ("5.0", "-0.1", "1000.1", "1000.0")], HEALTH)
    retail = frame([(1, D("1000.00"), "Y"), (2, D("77.00"), "N")], "id bigint, tot_amt_actual decimal(18,2), isactive string")
    keys = frame([(1,), (None,)], "k bigint")

    def run(line_amount, newest):
        item = frame([(1, D(line_amount)), (2, D("1.00"))], "retail_id bigint, tot_amt_actual decimal(18,2)")
        out = quality.dq_rules({"t": (keys, "k")}, retail, item, frame([(newest,)], "date_id int"), health, 20260301)
        return {r.rule: (r.violations, r.status) for r in out.collect()}

    fine = run("999.01", 20260228)
    assert fine["completeness"] == (1, "FAIL") and fine["accuracy"] == (2, "WARNING")
    assert fine["document_consistency"] == (0, "PASS")
    assert fine["consistency"] == (0, "PASS") and fine["timeliness"] == (0, "PASS")
    off = run("999.00", 20260227)
    assert off["document_consistency"] == (1, "WARNING")
    assert off["consistency"] == (1, "WARNING") and off["timeliness"] == (1, "WARNING")


def test_table_counts(spark):
    assert values(quality.table_counts({"a": spark.range(3), "b": spark.range(0)})) == {("a", 3), ("b", 0)}

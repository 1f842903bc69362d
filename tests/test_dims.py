from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import values

from shelfline.operators import dims
from shelfline.schema import align_schema, table_schema

PRODUCT = """id bigint, name string, value string, m_dim1_id bigint, m_dim4_id bigint, m_dim5_id bigint, m_dim6_id bigint,
    pricelist decimal(12,2), fabelement string, precost decimal(12,2), isactive string, creationdate timestamp_ntz"""
ALIAS = "id bigint, no string, product_id bigint, attr_id bigint, isactive string, creationdate timestamp_ntz"
STORE = """id bigint, code string, name string, area_id bigint, is_warehouse int, is_store int, is_cloud string,
    is_center string, isactive string"""
NOW = datetime(2026, 1, 1)


@pytest.fixture(scope="module")
def product(frame):
    return frame(
        [
            (1, "P1", "ring", 10, 134, 224, 30, Decimal("99.00"), "silver", Decimal("20.00"), "Y", NOW),
            (2, "P2", None, None, None, None, None, None, None, None, "Y", NOW),
            (3, "P3", "old", 10, 999, 225, 30, Decimal("1.00"), "", Decimal("1.00"), "N", NOW),
            (4, "P4", "other", 11, 999, 404, 30, Decimal("5.00"), "gold", Decimal("2.00"), "Y", NOW),
        ],
        PRODUCT,
    )


@pytest.fixture(scope="module")
def lookup(frame):
    return frame([(10, "B"), (134, "rings"), (224, "sale"), (30, "S"), (999, None)], "id bigint, attribname string")


@pytest.fixture(scope="module")
def alias(frame):
    return frame(
        [
            (9, "z", 1, 90, "N", NOW),   # lower id, but inactive
            (12, "b", 1, 92, "Y", NOW),
            (11, "a", 1, 91, "Y", NOW),  # first active one of product 1
            (21, None, 2, None, "Y", NOW),
        ],
        ALIAS,
    )


@pytest.fixture(scope="module")
def attr(frame):
    return frame([(90, "black", "S"), (91, "red", None), (92, "blue", "L")], "id bigint, value1 string, value2 string")


def test_product_fills_and_flags(product, lookup):
    out = dims.dim_product(product, lookup)
    rows = {r.product_id: r for r in out.collect()}
    assert set(rows) == {1, 2, 4}
    assert (rows[1].brand_name, rows[1].category_name, rows[1].property_name, rows[1].series_name) == ("B", "rings", "sale", "S")
    assert rows[1].is_main_product == "Y" and rows[4].is_main_product == "N"
    empty = rows[2]
    assert (empty.category_id, empty.category_name) == (0, "未分类")
    assert (empty.property_id, empty.property_name) == (0, "未知")
    assert (empty.series_name, empty.brand_name, empty.material) == ("", "", "")
    assert (empty.price_list, empty.price_cost, empty.is_main_product) == (Decimal("0.00"), Decimal("0.00"), "N")
    assert rows[4].category_name == "未分类" and rows[4].property_name == "未知"  # id known, name not
    assert out.columns == table_schema("dim_product").fieldNames()


def test_product_attr_takes_first_active_sku(product, alias, attr):
    assert values(dims.dim_product_attr(product, alias, attr)) == {(1, "red", ""), (2, "", ""), (4, "", "")}


def test_sku(alias, attr):
    out = dims.dim_sku(alias, attr)
    assert values(out, "sku_id", "sku_barcode", "sku_color", "sku_size") == {
        (12, "b", "blue", "L"), (11, "a", "red", ""), (21, "", "", ""),
    }


def test_store_types_and_fills(frame):
    stores = frame(
        [
            (1, "001", "main", 7, 1, None, None, "Y", "Y"),
            (2, "DS01", "shop", 7, None, 1, "Y", None, "Y"),
            (3, "RT01", "street", None, None, None, "N", None, "Y"),
            (4, "CS01", "test", 8, 0, 0, None, None, "Y"),
            (5, "X1", "func", 7, 0, 0, None, None, "Y"),
            (6, "ds01", "lower", 7, 0, 0, None, None, "Y"),
            (7, "DS02", "gone", 7, 0, 0, None, None, "N"),
        ],
        STORE,
    )
    out = dims.dim_store(stores, frame([(7, "north")], "id bigint, name string"))
    rows = {r.store_code: r for r in out.collect()}
    assert {c: r.store_type for c, r in rows.items()} == {
        "001": "总仓", "DS01": "电商", "RT01": "门店", "CS01": "测试", "X1": "功能仓", "ds01": "功能仓",
    }
    assert rows["RT01"].area_name == rows["CS01"].area_name == "未知区域" and rows["RT01"].area_id == 0
    assert rows["001"].is_cloud_store == "N" and rows["DS01"].is_cloud_store == "Y" and rows["DS01"].is_center == "N"
    assert (rows["DS01"].is_warehouse, rows["DS01"].is_store) == (0, 1)
    assert out.columns == table_schema("dim_store").fieldNames()


def test_calendar(spark, frame):
    holidays = frame([(date(2024, 2, 29), "leap")], "date_value date, holiday_name string")
    out = dims.dim_date(dims.calendar_days(spark, 20240228, 20240303), holidays)
    rows = {r.date_id: r for r in out.collect()}
    assert sorted(rows) == [20240228, 20240229, 20240301, 20240302, 20240303]
    leap, sunday = rows[20240229], rows[20240303]
    assert (leap.is_holiday, leap.holiday_name, leap.day_name_cn, leap.month_name_cn) == (1, "leap", "周四", "二月")
    assert (sunday.day_of_week, sunday.is_weekend, sunday.week_of_year, sunday.year_month) == (7, 1, 9, "2024-03")
    assert rows[20240301].date_quarter == 1 and rows[20240301].is_holiday == 0
    assert out.columns == table_schema("dim_date").fieldNames()


def test_days_covering(frame):
    df = frame([(date(2026, 1, 30),), (date(2026, 2, 2),), (None,)], "d date")
    assert dims.days_covering(df, "d").count() == 4
    assert dims.days_covering(df.limit(0), "d").count() == 0


def test_category_and_channel(frame, product, lookup):
    assert values(dims.dim_category(product, lookup)) == {(134, "rings", "Y", 1), (999, "未分类", "N", 13)}
    mapping = frame(
        [(1, "a", "A", "DS01", 1, "own"), (2, "b", "B", "DS02", None, "own"), (3, "c", "C", "DS03", 0, "own")],
        "channel_id int, channel_name string, channel_code string, store_code string, is_main int, platform_type string",
    )
    stores = frame([("DS01", "Y"), ("DS02", "N")], "code string, isactive string")
    assert values(dims.dim_channel(mapping, stores), "channel_id", "is_main", "is_active") == {
        (1, 1, "Y"), (2, 0, "N"), (3, 0, "N"),
    }


def test_align_schema_adds_casts_and_keeps(frame):
    df = frame([("5", "x")], "sku_id string, extra string")
    out = align_schema(df, table_schema("dim_sku"), {"is_active": "Y"})
    assert out.columns == table_schema("dim_sku").fieldNames() + ["extra"]
    row = out.first()
    assert (row.sku_id, row.is_active, row.sku_color, row.extra) == (5, "Y", None, "x")
    assert out.schema["sku_id"].dataType.typeName() == "long"

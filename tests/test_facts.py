from __future__ import annotations

from datetime import date, timedelta
from decimal import Decimal

import pytest
from conftest import values

from shelfline.operators import facts
from shelfline.plans import refresh

RETAIL = "id bigint, billdate int, store_id bigint, tot_amt_actual decimal(18,2), status int, isactive string"
ITEM = """retail_id bigint, product_id bigint, sku_id bigint, qty decimal(18,4), tot_amt_actual decimal(18,2),
    tot_amt_list decimal(18,2)"""
STORE = "id bigint, code string, is_cloud string"
PRODUCT = "id bigint, m_dim4_id bigint"
STORAGE = "store_id bigint, product_id bigint, sku_id bigint, qty decimal(18,4), qtypurchaserem bigint, isactive string"
D = Decimal


@pytest.fixture(scope="module")
def store(frame):
    return frame(
        [(1, "001", None), (2, "DS01", "N"), (3, "RT01", "Y"), (4, "RT02", "N"), (5, "ds01", None), (6, None, "Y")], STORE
    )


@pytest.fixture(scope="module")
def product(frame):
    return frame([(100, 134), (200, 999), (300, None)], PRODUCT)


def header(id, day=20260110, store=2, amount="10.00", status=2, active="Y"):
    return (id, day, store, D(amount), status, active)


def line(header, product=100, sku=1000, qty="1", amount="5.00", listed="6.00"):
    return (header, product, sku, D(qty), D(amount), D(listed))


def sales(frame, store, product, headers, lines, lo=20260101, hi=20260131):
    return facts.sales_daily(frame(headers, RETAIL), frame(lines, ITEM), store, product, lo, hi)


def test_header_sign_decides(frame, store, product):
    out = sales(
        frame, store, product,
        [header(1, amount="10.00"), header(2, amount="-10.00"), header(3, amount="0.00")],
        [line(1, qty="2"), line(1, qty="1"), line(2, qty="-3", amount="-7.00"), line(2, qty="1", amount="2.00"), line(3, qty="9")],
    )
    row = out.collect()
    assert len(row) == 1
    row = row[0]
    assert (row.sales_qty, row.sales_amount, row.sales_amount_list) == (3, D("10.00"), D("12.00"))
    assert (row.return_qty, row.return_amount) == (4, D("9.00"))  # absolute values on returns only
    assert row.order_count == 1


def test_zero_header_still_makes_a_row(frame, store, product):
    row = sales(frame, store, product, [header(3, amount="0.00")], [line(3, qty="9")]).first()
    assert (row.sales_qty, row.return_qty, row.order_count, row.sales_amount) == (0, 0, 0, D("0.00"))


def test_scope_filters(frame, store, product):
    headers = [header(i, store=i) for i in range(1, 7)] + [header(7, store=99)]
    out = sales(frame, store, product, headers, [line(i) for i in range(1, 8)])
    # e-commerce prefix (case-sensitive) or cloud; an unknown store is out; missing codes and flags are filled
    assert values(out, "store_id", "store_code", "is_cloud_store") == {(2, "DS01", "N"), (3, "RT01", "Y"), (6, "", "Y")}


def test_row_filters(frame, store, product):
    headers = [header(1), header(2, active="N"), header(3, status=1), header(4, day=20251231), header(5, day=20260201)]
    lines = [line(1, product=200), line(1, product=300), line(1, sku=None), line(9)] + [line(i) for i in range(2, 6)]
    assert sales(frame, store, product, headers, lines).count() == 0


def test_distinct_orders_per_group(frame, store, product):
    out = sales(frame, store, product, [header(1), header(2)], [line(1), line(1), line(2), line(2, sku=1001)])
    assert values(out, "m_productalias_id", "order_count", "sales_qty") == {(1000, 2, 3), (1001, 1, 1)}


def test_range_is_the_union_of_its_days(frame, store, product):
    headers = [header(i, day=20260101 + i % 5) for i in range(20)]
    lines = [line(i, sku=1000 + i % 3) for i in range(20)]
    whole = sales(frame, store, product, headers, lines, 20260101, 20260105)
    days = [sales(frame, store, product, headers, lines, d, d) for d in range(20260101, 20260106)]
    union = set().union(*(values(d) for d in days))
    assert values(whole) == union and whole.count() == sum(d.count() for d in days)


def test_hot_order_and_hot_sku(frame, store, product):
    """One order and one SKU hold most of the lines."""
    headers = [header(i) for i in range(50)]
    lines = [line(0, sku=1000 + i % 4) for i in range(900)] + [line(i) for i in range(1, 50)]
    out = {r.m_productalias_id: r for r in sales(frame, store, product, headers, lines).collect()}
    assert (out[1000].sales_qty, out[1000].order_count) == (225 + 49, 50)
    assert (out[1003].sales_qty, out[1003].order_count) == (225, 1)


def test_net(frame, store, product):
    out = facts.with_net(
        sales(frame, store, product, [header(1), header(2, amount="-1.00")], [line(1, qty="5"), line(2, qty="2", amount="1.50")])
    ).first()
    assert (out.net_qty, out.net_amount) == (3, D("3.50"))


def test_inventory_merges_and_keeps_zero(frame, store, product):
    storage = frame(
        [
            (1, 100, 1000, D("3"), 2, "Y"), (1, 100, 1000, D("4"), None, "Y"),  # same key twice
            (3, 100, 1001, D("0"), None, "Y"), (3, 100, 1002, None, 5, "Y"),
            (2, 100, 1000, D("9"), 1, "Y"),  # e-commerce store, not in stock scope
            (1, 200, 1000, D("9"), 1, "Y"), (1, 100, None, D("9"), 1, "Y"), (1, 100, 1000, D("9"), 1, "N"),
        ],
        STORAGE,
    )
    out = facts.inventory_daily(storage, store, product, date(2026, 1, 10))
    assert values(out, "date_id", "store_code", "is_cloud_store", "m_productalias_id", "qty", "qty_valid", "qtypurchaserem") == {
        (20260110, "001", "N", 1000, 7, 7, 2),
        (20260110, "RT01", "Y", 1001, 0, 0, 0),
        (20260110, "RT01", "Y", 1002, 0, 0, 5),
    }
    assert values(out, "qty_occupy") == {(0,)}


DAYS = "date_id int, v int"


def test_replace_range(frame):
    old = frame([(20260101, 1), (20260102, 1), (20260103, 1), (20260104, 1)], DAYS)
    new = frame([(20260102, 2), (20260104, 9)], DAYS)
    out = refresh.replace_range(old, new, 20260102, 20260103)
    expected = {(20260101, 1), (20260102, 2), (20260104, 1)}  # the 3rd is gone, the 4th is out of range
    assert values(out) == expected and out.count() == 3
    again = refresh.replace_range(out, new, 20260102, 20260103)
    assert values(again) == expected and again.count() == 3


def test_replace_range_with_nothing_new(frame):
    old = frame([(20260101, 1), (20260102, 1)], DAYS)
    nothing = old.limit(0)
    assert values(refresh.replace_range(old, nothing, 20260102, 20260103)) == {(20260101, 1), (20260102, 1)}
    assert values(refresh.replace_range(old, nothing, 20260102, 20260103, on_empty="clear")) == {(20260101, 1)}
    with pytest.raises(ValueError):
        refresh.replace_range(old, nothing, 1, 2, on_empty="other")


def test_replace_snapshot(frame):
    old = frame([(20260101, 1), (20260102, 1)], DAYS)
    assert values(refresh.replace_snapshot(old, frame([(20260102, 5)], DAYS), 20260102)) == {(20260101, 1), (20260102, 5)}


def test_coverage_over_a_month_end(frame):
    lo, hi = date(2026, 2, 3), date(2026, 3, 4)
    days = [lo + timedelta(n) for n in range(30)]
    full = frame([(int(d.strftime("%Y%m%d")), 1) for d in days], DAYS)
    gap = full.filter("date_id <> 20260228")
    assert facts.sales_coverage(full, lo, hi).first().needs_backfill is False
    row = facts.sales_coverage(gap, lo, hi).first()
    assert (row.day_cnt, row.days_missing, row.needs_backfill) == (29, 1, True)
    assert values(facts.missing_dates(gap, lo, hi)) == {(20260228, date(2026, 2, 28))}
    assert refresh.days_to_load(full, date(2026, 3, 5)) == (20260305, 20260305)
    assert refresh.days_to_load(gap, date(2026, 3, 5)) == (20260203, 20260305)
    assert refresh.days_to_load(None, date(2026, 3, 5)) == (20260203, 20260305)


def test_backfill(frame, store, product):
    headers, lines = [header(1, day=20260110), header(2, day=20260111)], [line(1), line(2)]
    stored = sales(frame, store, product, headers, lines)
    out = refresh.backfill_sales(stored, frame(headers[1:], RETAIL), frame(lines, ITEM), store, product, 20260110, 20260111)
    assert values(out, "date_id") == {(20260111,)}

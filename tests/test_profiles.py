from __future__ import annotations

from decimal import Decimal

import pytest
from conftest import values

from shelfline.operators import prefix, purchase, stock, transfer
from shelfline.operators.profile import header_item_consistency

D = Decimal
PURCHASE = """id bigint, billdate int, datein int, in_status int, store_id bigint, supplier_id bigint, tot_qty bigint,
    tot_qtyin bigint, tot_amt_actual decimal(18,2), tot_amtin_actual decimal(18,2), inerid bigint, intime timestamp_ntz,
    isactive string, creationdate timestamp_ntz"""


def order(id, qty=10, got=10, status=2, datein=20260110, amount="5.00", supplier=1, active="Y", store=1):
    amount = None if amount is None else D(amount)
    return (id, 20260101, datein, status, store, supplier, qty, got, D("5.00"), amount, 1, None, active, None)


@pytest.fixture(scope="module")
def orders(frame):
    return lambda *rows: frame(list(rows), PURCHASE)


def test_completion_classes(orders):
    df = orders(
        order(1), order(2, got=4), order(3, got=12), order(4, status=1), order(5, qty=0, got=0), order(6, got=0),
        order(7, got=None), order(8, qty=0, got=3, status=1), order(9, active="N"),
    )
    out = {r.receipt_class: r for r in purchase.purchase_completion(df).collect()}
    assert {k: r.cnt for k, r in out.items()} == {"完全入库": 1, "部分入库": 1, "超量入库": 1, "未入库": 2, "无采购数量": 1, "其他": 2}
    assert out["部分入库"].completion_pct == D("40.00") and out["无采购数量"].completion_pct is None
    assert sum(r.cnt for r in out.values()) == 8 and out["未入库"].pct == D("25.00")


def test_item_completion_is_null_aware(frame):
    rows = [(10, 10), (10, 4), (10, 12), (10, 0), (10, None), (0, 5), (None, 5)]
    df = frame([(*r, "Y") for r in rows], "qty bigint, qtyin bigint, isactive string")
    out = {r.receipt_class: r.cnt for r in purchase.purchase_item_completion(df).collect()}
    assert out == {"完全入库": 1, "部分入库": 1, "超量入库": 1, "未入库": 2, "无采购数量": 1, "其他": 1}


def test_monthly_skips_zero_and_null_dates(orders):
    df = orders(order(1), order(2, datein=None), order(3, datein=0), order(4, datein=20251231), order(5, datein=20260102))
    assert [(r.month, r.receipts) for r in purchase.purchase_monthly(df).collect()] == [("2026-01", 2), ("2025-12", 1)]
    assert [r.month for r in purchase.purchase_monthly(df, 1).collect()] == ["2026-01"]


def test_top_by_puts_null_sums_last_and_breaks_ties(orders):
    df = orders(
        order(1, supplier=1, amount=None), order(2, supplier=2, amount="3.00"), order(3, supplier=3, amount="3.00"),
        order(4, supplier=4, amount="9.00"), order(5, supplier=None, amount="99.00"),
    )
    assert [r.supplier_id for r in purchase.purchase_by_supplier(df).collect()] == [4, 2, 3, 1]
    assert [r.supplier_id for r in purchase.purchase_by_supplier(df, 2).collect()] == [4, 2]


def test_consistency_tolerance_and_missing_totals(frame):
    header = frame(
        [(1, D("10.00"), "Y"), (2, D("10.01"), "Y"), (3, D("10.02"), "Y"), (4, None, "Y"), (5, D("0.00"), "Y"), (6, D("1.00"), "Y"), (7, D("9"), "N")],
        "id bigint, total decimal(18,2), isactive string",
    )
    item = frame(
        [(i, D("5.00"), "Y") for i in (1, 2, 3, 4) for _ in range(2)] + [(1, D("7.00"), "N")], "doc bigint, qty decimal(18,2), isactive string"
    )
    row = header_item_consistency(header, item, "total", "doc", "qty").first()
    assert (row.documents, row.consistent, row.inconsistent, row.consistent_pct) == (6, 3, 2, D("50.00"))


def test_receipt_statistics(orders):
    df = orders(order(1, got=4, amount="1.00"), order(2, got=0, amount="0.00"), order(3, got=None, amount=None), order(4, got=11, qty=0))
    stats = purchase.purchase_qtyin_stats(df).first()
    assert tuple(stats) == (4, 2, 1, 1, 15, D("5.00"))
    assert tuple(purchase.purchase_amtin_stats(df).first()) == (4, 2, 1, D("6.00"), D("2.00"))
    assert tuple(purchase.purchase_receipt_compare(df).first()) == (3, 3, 1, 0, 1, 0, 2)
    assert tuple(purchase.purchase_receiver_fill(df).first()) == (4, 4, 0, 0)


def test_scorecards(orders):
    full = [order(i) for i in range(19)] + [order(19, datein=None)]
    out = {r["item"]: r for r in purchase.purchase_scorecard(orders(*full)).collect()}
    assert out["receipt_date"].rate == D("95.00") and out["receipt_date"].verdict == "PASS"
    assert (out["dimensions"].hits, out["measures"].hits, out["full_receipts"].verdict) == (4, 2, "PASS")
    weak = orders(*[order(i, datein=None, got=1, store=None, supplier=None, amount=None) for i in range(3)])
    out = {r["item"]: r.verdict for r in purchase.purchase_scorecard(weak).collect()}
    assert out == {
        "receipt_date": "FAIL", "receipt_status": "PASS", "receipt_quantity": "PASS", "dimensions": "WARNING",
        "measures": "WARNING", "full_receipts": "WARNING",
    }
    nothing = {r["item"]: r.rate for r in purchase.purchase_scorecard(orders(order(1, active="N"))).collect()}
    assert nothing["receipt_date"] == D("0.00")


TRANSFER = """id bigint, transfertype string, orig_id bigint, dest_id bigint, tot_qty bigint, tot_qtyout bigint, tot_qtyin bigint,
    tot_amtqty_list decimal(18,2), status int, confirm_status int, out_status int, in_status int, billdate int, isactive string"""
STORES = "id bigint, code string, name string, is_cloud string"


@pytest.fixture(scope="module")
def transfers(frame):
    rows = [
        (1, "ORD", 1, 2, 5, 5, 5, D("1.00"), 2, 2, 2, 2, 20260101, "Y"), (2, "EOR", 1, 3, 5, 0, 0, D("2.00"), 1, 1, 1, 1, 20260201, "Y"),
        (3, None, 3, 3, 5, 5, 0, D("3.00"), 3, None, 2, 1, None, "Y"), (4, "ZZZ", 9, None, 5, 5, 3, D("4.00"), 7, 2, 2, 2, 0, "Y"),
        (5, "IN", 1, 2, 5, 5, 5, D("5.00"), 2, 2, 2, 2, 20260101, "N"),
    ]
    return frame(rows, TRANSFER)


@pytest.fixture(scope="module")
def stores(frame):
    return frame([(1, "001", "main", None), (2, "DS01", "web", "N"), (3, "RT01", "shop", "Y")], STORES)


def test_transfer_distributions(transfers):
    assert values(transfer.transfer_by_type(transfers), "transfertype", "label", "cnt", "pct") == {
        ("ORD", "订单调拨", 1, D("25.00")), ("EOR", "云仓调拨", 1, D("25.00")), (None, "其他", 1, D("25.00")), ("ZZZ", "其他", 1, D("25.00")),
    }
    assert [(r.status, r.label) for r in transfer.transfer_status(transfers).collect()] == [(1, "未提交"), (2, "已提交"), (3, "待批"), (7, "其他")]
    assert [(r.confirm_status, r.label) for r in transfer.transfer_confirm(transfers).collect()] == [(1, "未确认"), (2, "已确认"), (None, "其他")]
    assert values(transfer.transfer_out(transfers), "label", "cnt") == {("未出库", 1), ("已出库", 3)}
    assert values(transfer.transfer_in(transfers), "label", "cnt") == {("未入库", 2), ("已入库", 2)}


def test_transfer_ends_and_flows(transfers, stores):
    assert [tuple(r) for r in transfer.transfer_top_origin(transfers, stores).collect()] == [
        ("001", "main", 2, 10, 5), ("RT01", "shop", 1, 5, 5), (None, None, 1, 5, 5),
    ]
    assert [r.store_code for r in transfer.transfer_top_dest(transfers, stores, 1).collect()] == ["RT01"]
    assert values(transfer.transfer_flow(transfers, stores), "origin_class", "dest_class", "documents") == {
        ("总仓(001)", "电商(DS%)", 1), ("总仓(001)", "门店(RT%)", 1), ("门店(RT%)", "门店(RT%)", 1), ("其他", "其他", 1),
    }
    assert values(transfer.transfer_cloud_direction(transfers, stores), "direction", "documents", "pct") == {
        ("非云仓→云仓", 1, D("25.00")), ("云仓→云仓", 1, D("25.00")), ("非云仓→非云仓", 2, D("50.00")),
    }


def test_transfer_quantities_and_fill(transfers):
    row = transfer.transfer_qty_compare(transfers).first()
    assert tuple(row) == (4, 20, 15, 8, 1, 1, 1, 1, 1)
    out = {r["item"]: r for r in transfer.transfer_scorecard(transfers).collect()}
    assert out["origin"].verdict == out["destination"].verdict == "WARNING" and out["destination"].rate == D("75.00")
    assert (out["transfer_types"].hits, out["planned_qty"].hits, out["planned_qty"].total) == (3, 20, None)
    cloud = transfer.transfer_cloud(transfers).first()
    assert (cloud.documents, cloud.total_qty, cloud.total_amount) == (1, 5, D("2.00"))
    assert [(r.month, r.documents) for r in transfer.transfer_monthly(transfers).collect()] == [("2026-02", 1), ("2026-01", 1)]


REPORT = "product_id bigint, store_id bigint, qty bigint, qtypurchaserem decimal(18,4), isactive string"


def test_onorder_segments(frame):
    numbers = [None, "0", "0.5", "1", "10", "10.5", "11", "50", "51", "100", "101", "500", "501", "1000", "1001", "-1"]
    df = frame([(1, 1, 1, None if n is None else D(n), "Y") for n in numbers], REPORT)
    out = [(r.segment, r.segment_no, r.cnt) for r in stock.onorder_segments(df).collect()]
    assert out == [
        ("无欠数", 0, 2), ("1-10件", 1, 4), ("11-50件", 2, 2), ("51-100件", 3, 2), ("101-500件", 4, 2), ("501-1000件", 5, 2),
        (">1000件", 6, 1), ("负数(异常)", 7, 1),
    ]
    fill = stock.onorder_fill(df).first()
    assert (fill.total_rows, fill.filled, fill.positive, fill.none, fill.negative) == (16, 15, 13, 2, 1)


def test_grain_match_with_missing_keys(frame):
    ddl = "product_id bigint, store_id bigint, isactive string"
    left = frame([(1, 1, "Y"), (1, 1, "Y"), (2, 1, "Y"), (3, None, "Y"), (None, 1, "Y"), (9, 9, "N")], ddl)
    right = frame([(1, 1, "Y"), (4, 1, "Y"), (3, None, "Y"), (None, 1, "Y"), (2, 1, "N")], ddl)
    assert tuple(stock.stock_grain_match(left, right).first()) == (7, 1, 2, 2)


def test_stock_with_onorder_keeps_unmatched(frame, stores):
    storage = frame([(1, 1, 5, "Y"), (2, 1, 6, "Y"), (3, 1, 7, "Y"), (1, 2, 8, "Y")], "product_id bigint, store_id bigint, qty bigint, isactive string")
    report = frame([(1, 1, 0, D("4"), "Y"), (2, 1, 0, D("4"), "N"), (3, 1, 0, None, "Y")], REPORT)
    product = frame([(1, "P1", "a"), (3, "P3", "c")], "id bigint, name string, value string")
    out = stock.stock_with_onorder(storage, report, product, stores).collect()
    assert [(r.product_id, r.product_code, r.on_order_qty, r.available_qty) for r in out] == [
        (1, "P1", D("4"), D("9")), (2, None, D("0"), D("6")), (3, "P3", D("0"), D("7")),
    ]
    assert values(stock.onorder_scalar_subquery(report, stores)) == {(1, D("4")), (3, None)}
    assert values(stock.warehouse_onorder(report, product, stores), "product_id", "product_code", "on_order_qty") == {(1, "P1", D("4"))}


def test_stock_with_onorder_puts_unmatched_last(frame, stores):
    storage = frame([(p, 1, 5, s, "Y") for p, s in ((1, 12), (1, 11), (2, 20), (3, 30))], "product_id bigint, store_id bigint, qty bigint, sku_id bigint, isactive string")
    report = frame([(1, 1, 0, D("4"), "Y"), (3, 1, 0, D("-2"), "Y")], REPORT)
    product = frame([], "id bigint, name string, value string")
    out = stock.stock_with_onorder(storage, report, product, stores)
    assert out.columns[-1] == "available_qty"
    assert [(r.product_id, r.on_order_qty) for r in out.collect()] == [(1, D("4")), (1, D("4")), (3, D("-2")), (2, D("0"))]


def test_candidates_and_scorecard_without_the_column(frame):
    with_it = frame([(1, 1, 1, D("4"), "Y"), (1, 1, 1, None, "Y")], REPORT)
    without = frame([(1, "Y")], "id bigint, isactive string")
    assert values(stock.source_candidates({"a": with_it, "b": without})) == {("a", 2, True, 1, 1, D("4")), ("b", 1, False, None, None, None)}
    assert stock.stock_scorecard(without).first().verdict == "FAIL"
    assert stock.stock_scorecard(with_it).first().verdict == "PASS"


def test_distribution_of_onorder(frame):
    df = frame([(1, 1, 1, D(n), "Y") for n in ("1", "2", "10", "0", "-5")] + [(1, 1, 1, D("99"), "N")], REPORT)
    assert tuple(stock.onorder_distribution(df).first()) == (D("1"), D("10"), D("4.33"), D("2"), D("13"))


def test_quantile_sketches(spark, frame):
    """Merged sketches give a median near the exact one, also with a hot key; NULLs and empty tables count for nothing."""
    rows = [(i % 7 if i % 3 else 0, (i * 7919 % 40009) ** 2) for i in range(40009)] + [(1, None), (9, None)]
    df = frame(rows, "day int, v long").repartition(5)
    sketches = prefix.quantile_sketches(df, ["day"], "v")
    assert {r["day"] for r in sketches.collect()} == set(range(7))
    values = sorted(v for _, v in rows if v is not None)
    whole = prefix.sketched_median(sketches, []).first()
    assert whole["n"] == len(values)
    assert abs(values.index(whole["median"]) / len(values) - 0.5) < 0.02
    assert prefix.exact_median(df, "v").first()[0] == values[len(values) // 2]
    for row in prefix.sketched_median(sketches, ["day"]).collect():
        own = sorted(v for d, v in rows if d == row["day"] and v is not None)
        assert row["n"] == len(own) and abs(own.index(row["median"]) / len(own) - 0.5) < 0.02
    few = prefix.quantile_sketches(frame([(1, 5), (1, 5), (1, 9)], "day int, v long"), ["day"], "v")
    assert prefix.sketched_median(few, ["day"]).first()["median"] == 5
    none = prefix.quantile_sketches(df.limit(0), ["day"], "v")
    assert none.isEmpty() and prefix.sketched_median(none, []).isEmpty()


def test_median_check_tells_a_wrong_sketch(frame):
    report = frame([(1, s, v, "Y") for s in (1, 2) for v in range(1, 40)], "product_id int, store_id int, qtypurchaserem int, isactive string")
    sketches = stock.onorder_sketches(report)
    assert {(r["store_id"], r["n"], r["within"]) for r in stock.onorder_median_check(report, sketches).collect()} == {(1, 39, True), (2, 39, True), (None, 78, True)}
    low = stock.onorder_sketches(report.filter("qtypurchaserem < 10"))
    assert not any(r["within"] for r in stock.onorder_median_check(report, low.withColumn("n", low["n"] * 0 + 39)).collect())

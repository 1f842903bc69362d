"""Business constants of the warehouse.

The ids, codes, cut points and Chinese labels below are fixed values: they are part of the
published results and must not be translated or reordered.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels of inventory_status, most urgent first (position = status_priority).
STATUS_URGENT = "紧急缺货"
STATUS_REPLENISH = "需补货"
STATUS_NORMAL = "正常"
STATUS_OVERSTOCK = "库存过高"
STATUS_DEAD = "滞销"
STATUS_STOPPED = "停售"
STATUS_ORDER = (
    STATUS_URGENT, STATUS_REPLENISH, STATUS_NORMAL, STATUS_OVERSTOCK, STATUS_DEAD, STATUS_STOPPED,
)
GRADE_ORDER = ("S", "A", "B", "C")

# Labels of sales_trend.
TREND_NONE = "无销售"
TREND_UP = "快速上升"
TREND_STABLE = "稳定"
TREND_COOLING = "降温"
TREND_DOWN = "快速下滑"

# Labels of store_type, and of the store classes used by the transfer and stock reports.
STORE_MAIN = "总仓"
STORE_ECOMMERCE = "电商"
STORE_SHOP = "门店"
STORE_TEST = "测试"
STORE_FUNCTIONAL = "功能仓"
OTHER = "其他"
FLOW_MAIN = "总仓(001)"
FLOW_ECOMMERCE = "电商(DS%)"
FLOW_SHOP = "门店(RT%)"

# What replaces a missing attribute.
NO_CATEGORY = "未分类"
NO_PROPERTY = "未知"
NO_AREA = "未知区域"

# Decoded transfer types and document states.
TRANSFER_TYPES = {
    "ORD": "订单调拨",
    "NOR": "正常调拨",
    "ADD": "补货调拨",
    "DIF": "差异调拨",
    "OUT": "代销出库",
    "IN": "代销退货",
    "EOR": "云仓调拨",
}
SUBMIT_STATES = {1: "未提交", 2: "已提交", 3: "待批"}
CONFIRM_STATES = {1: "未确认", 2: "已确认"}
OUTBOUND_STATES = {1: "未出库", 2: "已出库"}
INBOUND_STATES = {1: "未入库", 2: "已入库"}

# Receipt completion classes of purchase orders and lines.
RECEIPT_FULL = "完全入库"
RECEIPT_PARTIAL = "部分入库"
RECEIPT_OVER = "超量入库"
RECEIPT_NONE = "未入库"
RECEIPT_NO_QTY = "无采购数量"

# Directions of a transfer between cloud and other stores.
CLOUD_TO_CLOUD = "云仓→云仓"
CLOUD_TO_OTHER = "云仓→非云仓"
OTHER_TO_CLOUD = "非云仓→云仓"
OTHER_TO_OTHER = "非云仓→非云仓"

# On-order ranges, in report order; each entry is (label, low, high), inclusive integers.
ONORDER_NONE = "无欠数"
ONORDER_NEGATIVE = "负数(异常)"
ONORDER_RANGES = (
    ("1-10件", 1, 10),
    ("11-50件", 11, 50),
    ("51-100件", 51, 100),
    ("101-500件", 101, 500),
    ("501-1000件", 501, 1000),
    (">1000件", 1001, None),
)

# Names in the calendar dimension.
WEEKDAY_NAMES = ("周一", "周二", "周三", "周四", "周五", "周六", "周日")
MONTH_NAMES = ("一月", "二月", "三月", "四月", "五月", "六月", "七月", "八月", "九月", "十月", "十一月", "十二月")


@dataclass(frozen=True)
class RetailRules:
    """Ids, codes and thresholds; the defaults are the published business rules."""

    main_category_ids: tuple[int, ...] = (134, 142, 139, 138, 141, 143, 133, 136, 140, 137, 144, 145)
    property_on_sale: tuple[int, ...] = (224, 296, 297)
    property_new: tuple[int, ...] = (225, 298, 299)
    property_discontinued: tuple[int, ...] = (127, 126, 152)
    main_warehouse: str = "001"
    ecommerce_prefix: str = "DS"
    shop_prefix: str = "RT"
    test_prefix: str = "CS"
    submitted_status: int = 2
    long_window_days: int = 30
    short_window_days: int = 7
    urgent_days: int = 30
    replenish_days: int = 70
    target_days: int = 90
    turnover_sentinel: int = 9999
    grade_cuts: tuple[Decimal, Decimal, Decimal] = (Decimal("0.30"), Decimal("0.70"), Decimal("0.90"))
    trend_cuts: tuple[Decimal, Decimal, Decimal] = (Decimal("1.3"), Decimal("1.0"), Decimal("0.7"))
    expected_health_rows: int = 2508
    expected_tolerance: int = 5

    def sales_scope(self, code: Column, cloud: Column) -> Column:
        """Stores whose sales count: e-commerce codes and cloud stores."""
        return code.startswith(self.ecommerce_prefix) | (cloud == F.lit("Y"))

    def stock_scope(self, code: Column, cloud: Column) -> Column:
        """Stores whose stock counts: the main warehouse and cloud stores."""
        return (code == F.lit(self.main_warehouse)) | (cloud == F.lit("Y"))

    def is_main_category(self, category_id: Column) -> Column:
        return category_id.isin(*self.main_category_ids)

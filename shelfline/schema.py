"""Column lists of the warehouse tables and the additive schema alignment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Names and types of the warehouse tables (business columns; load stamps are added by the sinks).
DDL = {
    "dim_product": """product_id bigint, product_code string, product_name string, category_id bigint,
        category_name string, property_id bigint, property_name string, series_id bigint, series_name string,
        brand_id bigint, brand_name string, price_list decimal(12,2), material string, price_cost decimal(12,2),
        is_main_product string, is_active string, created_at timestamp_ntz""",
    "dim_product_attr": "product_id bigint, color string, size string",
    "dim_sku": """sku_id bigint, sku_barcode string, product_id bigint, sku_color string, sku_size string,
        is_active string, created_at timestamp_ntz""",
    "dim_store": """store_id bigint, store_code string, store_name string, area_id bigint, area_name string,
        is_warehouse int, is_store int, is_cloud_store string, is_center string, store_type string,
        is_active string""",
    "dim_date": """date_id int, date_value date, date_year int, date_month int, date_day int, date_quarter int,
        week_of_year int, day_of_week int, day_name_cn string, month_name_cn string, is_weekend int,
        is_holiday int, holiday_name string, year_month string""",
    "dim_category": "category_id bigint, category_name string, is_main_product string, sort_order int",
    "dim_channel": """channel_id int, channel_name string, channel_code string, store_code string, is_main int,
        platform_type string, is_active string""",
    "dws_sales_daily": """date_id int, store_id bigint, store_code string, is_cloud_store string,
        product_id bigint, m_productalias_id bigint, sales_qty bigint, sales_amount decimal(18,2),
        sales_amount_list decimal(18,2), return_qty bigint, return_amount decimal(18,2), order_count bigint""",
    "dws_inventory_daily": """date_id int, store_id bigint, store_code string, is_cloud_store string,
        product_id bigint, m_productalias_id bigint, qty bigint, qty_valid bigint, qty_occupy bigint,
        qtypurchaserem bigint""",
    "ads_inventory_health": """snapshot_date date, product_id bigint, sku_id bigint, sku_barcode string,
        color string, size string, product_code string, product_name string, category_id bigint,
        category_name string, property_id bigint, property_name string, series_id bigint, series_name string,
        price_list decimal(12,2), total_qty bigint, warehouse_qty bigint, cloud_qty bigint,
        purchase_rem_qty bigint, sales_qty_30d bigint, sales_amt_30d decimal(18,2), sales_qty_7d bigint,
        return_qty_30d bigint, return_amount_30d decimal(18,2), daily_avg_sales decimal(20,2),
        daily_avg_sales_7d decimal(20,2), sales_velocity decimal(20,2), turnover_days decimal(20,1),
        inventory_status string, status_priority int, suggest_qty bigint, sales_rank bigint,
        sales_ratio decimal(20,2), cumulative_ratio decimal(20,2), sku_grade string, sales_trend string""",
    "ads_daily_report": """report_date date, channel_id int, channel_name string, sales_amount decimal(18,2),
        sales_qty bigint, return_amount decimal(18,2), return_qty bigint, net_amount decimal(18,2), net_qty bigint,
        order_count bigint, avg_price decimal(20,2), return_rate decimal(20,2), discount_rate decimal(20,2),
        sales_amount_yoy decimal(18,2), yoy_growth decimal(20,2), sales_amount_mom decimal(18,2),
        mom_growth decimal(20,2)""",
    "ads_sales_summary": """report_date date, granularity string, channel_id int, channel_name string,
        category_id bigint, category_name string, sales_amount decimal(18,2), sales_qty bigint,
        return_amount decimal(18,2), return_qty bigint, net_amount decimal(18,2), order_count bigint, sku_count bigint,
        avg_price decimal(20,2)""",
}


def table_schema(name: str) -> T.StructType:
    """Schema of a warehouse table (needs an active session, as any DDL string does)."""
    return T.StructType.fromDDL(DDL[name])


def align_schema(df: DataFrame, schema: T.StructType, defaults: dict | None = None) -> DataFrame:
    """Bring ``df`` to ``schema``: cast and order its columns and add each missing one as a default or NULL.

    Columns which the schema does not name are kept at the end, as an additive migration would.
    """
    defaults = defaults or {}
    known = [
        (F.col(f.name) if f.name in df.columns else F.lit(defaults.get(f.name))).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]
    extra = [F.col(c) for c in df.columns if c not in schema.fieldNames()]
    return df.select(*known, *extra)

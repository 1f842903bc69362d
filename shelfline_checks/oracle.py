"""Oracle SQL for the registered queries, written for DuckDB over the given tables.

``CTES`` holds the retail view of the tables and the warehouse tables in SQL; a query takes the ones it names. Ratios are
rounded half up in integers, independently of the decimal arithmetic of the jobs.
"""

from __future__ import annotations

import re

from shelfline import rules as L

AS_OF, AS_OF_KEY = "DATE '2001-08-01'", 20010801
D30, D7, D1 = 20010702, 20010725, 20010731
LO, HI = 20010601, 20010715
EXPECTED = 2508


def by_code(code: str, main: str, prefixes: list[tuple[str, str]], other: str) -> str:
    """The class of a store by its code: the main warehouse, then the first prefix that fits."""
    cases = "".join(f" WHEN {code} LIKE '{prefix}%' THEN '{label}'" for prefix, label in prefixes)
    return f"CASE WHEN {code} = '001' THEN '{main}'{cases} ELSE '{other}' END"


def rnd(n: str, d: str, k: int) -> str:
    """n / d rounded half away from zero to k digits, as DOUBLE; n and d are integer expressions."""
    n, d = f"CAST({n} AS HUGEINT)", f"CAST({d} AS HUGEINT)"
    return (
        f"(CASE WHEN {d} = 0 THEN NULL ELSE CAST(sign({n}) * sign({d}) * ((2 * abs({n}) * {10**k} + abs({d}))"
        f" // (2 * abs({d}))) AS DOUBLE) / {10**k} END)"
    )


def pct(n: str, d: str, k: int = 2) -> str:
    return rnd(f"100 * ({n})", d, k)


def cents(x: str) -> str:
    """An amount with two digits as integer cents."""
    return f"CAST(({x}) * 100 AS HUGEINT)"


def key(d: str) -> str:
    return f"CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS INTEGER)"


MAIN = "(134, 142, 139, 138, 141, 143, 133, 136, 140, 137, 144, 145)"
SALES_SCOPE = "(code LIKE 'DS%' OR is_cloud = 'Y')"
STOCK_SCOPE = "(code = '001' OR is_cloud = 'Y')"
W_SALES_SCOPE = "(s.store_code LIKE 'DS%' OR s.is_cloud_store = 'Y')"
W_STOCK_SCOPE = "(s.store_code = '001' OR s.is_cloud_store = 'Y')"
NATION2 = "lpad(CAST(n_nationkey AS VARCHAR), 2, '0')"
ORDER_ACTIVE = "CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 'N' ELSE 'Y' END"
PRIO = "substr(o_orderpriority, 1, 1)"


def pending(p: str) -> str:
    return f"(o_orderstatus = 'P' AND o_orderpriority LIKE '{p}%')"


def sales_sql(lo: int, hi: int) -> str:
    """Receipts of the scoped stores, their lines of main products, one row per day x store x SKU."""
    return f"""
    SELECT billdate AS date_id, store_id, coalesce(code, '') AS store_code, coalesce(is_cloud, 'N') AS is_cloud_store,
           product_id, sku_id AS m_productalias_id,
           CAST(coalesce(sum(qty) FILTER (WHERE sign = 1), 0) AS BIGINT) AS sales_qty,
           CAST(coalesce(sum(paid) FILTER (WHERE sign = 1), 0) AS DECIMAL(18,2)) AS sales_amount,
           CAST(coalesce(sum(listed) FILTER (WHERE sign = 1), 0) AS DECIMAL(18,2)) AS sales_amount_list,
           CAST(coalesce(sum(abs(qty)) FILTER (WHERE sign = -1), 0) AS BIGINT) AS return_qty,
           CAST(coalesce(sum(abs(paid)) FILTER (WHERE sign = -1), 0) AS DECIMAL(18,2)) AS return_amount,
           count(DISTINCT receipt) FILTER (WHERE sign = 1) AS order_count
    FROM (SELECT id AS receipt, billdate, store_id, sign(tot_amt_actual) AS sign FROM src_retail
          WHERE isactive = 'Y' AND status = 2 AND billdate BETWEEN {lo} AND {hi}) receipts
    JOIN (SELECT retail_id AS receipt, product_id, sku_id, qty, tot_amt_actual AS paid, tot_amt_list AS listed FROM src_item
          WHERE sku_id IS NOT NULL AND product_id IN (SELECT id FROM src_product WHERE m_dim4_id IN {MAIN})) lines
         USING (receipt)
    JOIN (SELECT id AS store_id, code, is_cloud FROM src_store WHERE {SALES_SCOPE}) shops USING (store_id)
    GROUP BY ALL"""


SOLD, STOCK, SHORT = "sales_qty_30d", "total_qty", "sales_qty_7d"


def status_case(stock: str, sold: str, labels: list[str]) -> str:
    """Quotient comparisons in integers: 30 * stock / sold against 30, 70 and 90, for either sign of sold."""
    a, b = f"(30 * ({stock}) * sign({sold}))", f"abs({sold})"
    return (
        f"CASE WHEN {stock} > 0 AND {sold} = 0 THEN {labels[4]} WHEN {stock} = 0 AND {sold} = 0 THEN {labels[5]}"
        f" WHEN {sold} <> 0 AND {a} < 30 * {b} THEN {labels[0]} WHEN {sold} <> 0 AND {a} < 70 * {b} THEN {labels[1]}"
        f" WHEN {sold} <> 0 AND {a} <= 90 * {b} THEN {labels[2]} ELSE {labels[3]} END"
    )


STATUS = [f"'{label}'" for label in L.STATUS_ORDER]
PRIORITY = ["1", "2", "3", "4", "5", "6"]


def suggest(stock: str, sold: str, ret: str, rem: str) -> str:
    a, b = f"(30 * ({stock}) * sign({sold}))", f"abs({sold})"
    return (
        f"CAST(CASE WHEN {sold} = 0 THEN 0 WHEN {a} >= 90 * {b} THEN 0"
        f" ELSE 3 * ({sold}) - ({stock}) - ({ret}) - ({rem}) END AS BIGINT)"
    )


def trend(sold: str, short: str) -> str:
    v = rnd(f"30 * ({short})", f"7 * ({sold})", 2)
    return (
        f"CASE WHEN {sold} = 0 THEN '{L.TREND_NONE}' WHEN {v} >= 1.3 THEN '{L.TREND_UP}' WHEN {v} >= 1.0 THEN '{L.TREND_STABLE}'"
        f" WHEN {v} >= 0.7 THEN '{L.TREND_COOLING}' ELSE '{L.TREND_DOWN}' END"
    )


HEALTH_COLUMNS = f"""
    SELECT {AS_OF} AS snapshot_date, product_id, sku_id, sku_barcode, sku_color AS color, sku_size AS size, product_code,
           product_name, category_id, category_name, property_id, property_name, series_id, series_name, price_list,
           total_qty, warehouse_qty, cloud_qty, purchase_rem_qty, {SOLD}, sales_amt_30d, {SHORT}, return_qty_30d,
           return_amount_30d,
           {rnd(SOLD, "30", 2)} AS daily_avg_sales, {rnd(SHORT, "7", 2)} AS daily_avg_sales_7d,
           {rnd(f"30 * {SHORT}", f"7 * {SOLD}", 2)} AS sales_velocity,
           coalesce({rnd(f"30 * {STOCK}", SOLD, 1)}, 9999) AS turnover_days,
           {status_case(STOCK, SOLD, STATUS)} AS inventory_status,
           CAST({status_case(STOCK, SOLD, PRIORITY)} AS INTEGER) AS status_priority,
           {suggest(STOCK, SOLD, "return_qty_30d", "purchase_rem_qty")} AS suggest_qty
    FROM sku_window JOIN (SELECT * FROM dim_product WHERE is_main_product = 'Y') USING (product_id)
    LEFT JOIN (SELECT sku_id, sku_barcode, sku_color, sku_size FROM dim_sku) USING (sku_id)"""

CTES: dict[str, str] = {
    # -- the retail view of the given tables
    "src_store": f"""
    SELECT CAST(n_nationkey AS BIGINT) AS id,
           CASE WHEN n_nationkey = 0 THEN '001' WHEN n_nationkey <= 8 THEN 'DS' || {NATION2}
                WHEN n_nationkey <= 16 THEN 'RT' || {NATION2} WHEN n_nationkey <= 18 THEN 'CS' || {NATION2}
                ELSE 'FN' || {NATION2} END AS code,
           n_name AS name, CASE WHEN n_nationkey <> 7 THEN CAST(n_regionkey AS BIGINT) END AS area_id,
           CASE WHEN n_nationkey = 0 OR n_nationkey >= 19 THEN 1 WHEN n_nationkey <= 8 THEN 0 END AS is_warehouse,
           CASE WHEN n_nationkey BETWEEN 9 AND 16 THEN 1 END AS is_store,
           CASE WHEN n_nationkey % 5 = 1 THEN NULL WHEN n_nationkey % 3 = 0 THEN 'Y' ELSE 'N' END AS is_cloud,
           CASE WHEN n_nationkey = 0 THEN 'Y' WHEN n_nationkey <= 8 THEN 'N' END AS is_center,
           CASE WHEN n_nationkey = 24 THEN 'N' ELSE 'Y' END AS isactive
    FROM nation""",
    "src_area": "SELECT CAST(r_regionkey AS BIGINT) AS id, r_name AS name FROM region",
    "part_ids": """
    SELECT *, CAST(substr(p_brand, 7, 4) AS BIGINT) + 1000 AS m_dim1_id,
           CAST(CASE WHEN p_size = 50 THEN NULL WHEN p_type = 'STANDARD' THEN 133 WHEN p_type = 'MEDIUM' THEN 134
                WHEN p_type = 'LARGE' THEN 136 WHEN p_type = 'SMALL' THEN 137 WHEN p_type = 'PROMO' THEN 201
                WHEN p_type = 'ECONOMY' THEN 202 END AS BIGINT) AS m_dim4_id,
           CAST(CASE WHEN p_size <= 20 THEN 224 WHEN p_size <= 35 THEN 225 WHEN p_size <= 45 THEN 127 END AS BIGINT)
               AS m_dim5_id,
           CAST(CASE WHEN p_size <= 25 THEN 3000 + p_size END AS BIGINT) AS m_dim6_id,
           TIMESTAMP '2000-01-01' + to_days(p_size) AS creationdate
    FROM part""",
    "src_product": """
    SELECT p_partkey AS id, 'P' || lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS name,
           CASE WHEN p_size <> 13 THEN p_name END AS value, m_dim1_id, m_dim4_id, m_dim5_id, m_dim6_id,
           CASE WHEN p_size <> 49 THEN CAST(p_retailprice AS DECIMAL(12,2)) END AS pricelist,
           CASE WHEN p_size < 40 THEN split_part(p_name, ' ', 2) END AS fabelement,
           CAST(p_retailprice - 500 AS DECIMAL(12,2)) AS precost,
           CASE WHEN p_size = 47 THEN 'N' ELSE 'Y' END AS isactive, creationdate
    FROM part_ids""",
    "src_dim": """
    SELECT m_dim1_id AS id, p_brand AS attribname FROM part_ids
    UNION SELECT m_dim4_id, p_type FROM part_ids WHERE m_dim4_id IS NOT NULL
    UNION SELECT m_dim5_id, CASE WHEN p_size <= 20 THEN 'on sale' WHEN p_size <= 35 THEN 'new' END FROM part_ids
          WHERE m_dim5_id IS NOT NULL
    UNION SELECT m_dim6_id, 'Series ' || CAST(p_size AS VARCHAR) FROM part_ids WHERE m_dim6_id IS NOT NULL""",
    "skus": "SELECT *, p_partkey * 2 + v AS sku FROM part_ids, (VALUES (0), (1)) t(v)",
    "src_alias": """
    SELECT sku AS id, CASE WHEN p_size <> 46 THEN '69' || lpad(CAST(sku AS VARCHAR), 10, '0') END AS no,
           p_partkey AS product_id, CASE WHEN NOT (p_size = 45 AND v = 1) THEN sku END AS attr_id,
           CASE WHEN p_size = 44 AND v = 0 THEN 'N' ELSE 'Y' END AS isactive, creationdate
    FROM skus""",
    "src_attr": """
    SELECT sku AS id, split_part(p_name, ' ', 1) AS value1,
           CASE WHEN v = 1 THEN 'S' || CAST(p_size AS VARCHAR) END AS value2
    FROM skus""",
    "src_channel": f"""
    SELECT n_nationkey AS channel_id, 'Channel ' || CAST(n_nationkey AS VARCHAR) AS channel_name,
           'CH' || CAST(n_nationkey AS VARCHAR) AS channel_code,
           CASE WHEN n_nationkey = 8 THEN 'DS99' ELSE 'DS' || {NATION2} END AS store_code,
           CASE WHEN n_nationkey = 1 THEN 1 WHEN n_nationkey <= 5 THEN 0 END AS is_main,
           CASE WHEN n_nationkey <= 4 THEN 'marketplace' ELSE 'own' END AS platform_type
    FROM nation WHERE n_nationkey BETWEEN 1 AND 8""",
    "src_retail": f"""
    SELECT o_orderkey AS id, {key("o_orderdate")} AS billdate, o_custkey % 25 AS store_id,
           CAST(CASE WHEN o_orderpriority = '5-LOW' THEN -CAST(o_totalprice AS DECIMAL(18,2))
                ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS DECIMAL(18,2)) AS tot_amt_actual,
           CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 2 END AS status, {ORDER_ACTIVE} AS isactive
    FROM orders""",
    "src_item": """
    SELECT l_orderkey AS retail_id, l_partkey AS product_id,
           CASE WHEN l_quantity <> 50 THEN l_partkey * 2 + l_linenumber % 2 END AS sku_id,
           CAST(sgn * l_quantity AS BIGINT) AS qty,
           sgn * CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(1 - l_discount AS DECIMAL(3,2)) AS DECIMAL(14,2))
               AS tot_amt_actual,
           sgn * CAST(l_extendedprice AS DECIMAL(14,2)) AS tot_amt_list
    FROM (SELECT *, CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN -1 ELSE 1 END AS sgn FROM lineitem)""",
    "src_storage": """
    SELECT l_suppkey % 25 AS store_id, l_partkey AS product_id,
           CASE WHEN l_quantity <> 50 THEN l_partkey * 2 + l_linenumber % 2 END AS sku_id,
           CASE WHEN l_quantity = 49 THEN NULL WHEN l_suppkey % 4 = 0 THEN CAST(l_quantity AS BIGINT)
                WHEN l_suppkey % 4 = 1 THEN 0 WHEN l_suppkey % 4 = 2 THEN CAST(l_quantity AS BIGINT) % 5
                ELSE CAST(l_quantity AS BIGINT) % 3 END AS qty,
           CASE WHEN l_returnflag = 'N' THEN CAST(l_quantity AS BIGINT) END AS qtypurchaserem,
           CASE WHEN l_linestatus <> 'O' OR (l_linenumber = 7 AND l_returnflag = 'A') THEN 'N' ELSE 'Y' END AS isactive
    FROM lineitem""",
    "src_report": """
    SELECT product_id, store_id, coalesce(qty, 0) AS qty, qtypurchaserem, CASE WHEN qty IS NULL OR qty = 13 THEN 'N' ELSE 'Y' END AS isactive
    FROM (SELECT l_partkey AS product_id, l_suppkey % 25 AS store_id,
                 CAST(sum(CAST(l_quantity AS BIGINT)) FILTER (WHERE l_returnflag IN ('N', 'A')) AS BIGINT) AS qty,
                 CAST(sum(CASE WHEN l_returnflag = 'N' AND l_linenumber = 7 THEN -CAST(l_quantity AS BIGINT)
                               WHEN l_returnflag = 'N' THEN CAST(l_quantity AS BIGINT) END) AS BIGINT) AS qtypurchaserem
          FROM lineitem GROUP BY l_partkey, l_suppkey % 25)""",
    "src_purchase": f"""
    SELECT o_orderkey AS id, {key("o_orderdate")} AS billdate,
           CASE WHEN {pending("5")} THEN NULL WHEN {pending("4")} THEN 0
                ELSE {key("(CAST(o_orderdate AS DATE) + 3)")} END AS datein,
           CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 2 END AS in_status,
           CASE WHEN NOT {pending("3")} THEN o_custkey % 25 END AS store_id,
           CASE WHEN NOT {pending("2")} THEN o_custkey END AS supplier_id,
           CAST(floor(o_totalprice / 1000) AS BIGINT) AS tot_qty,
           CAST(CASE WHEN o_orderstatus = 'F' THEN floor(o_totalprice / 1000)
                     WHEN o_orderstatus = 'O' THEN floor(o_totalprice / 1000)
                          + CASE {PRIO} WHEN '1' THEN -1 WHEN '2' THEN 1 ELSE 0 END
                     WHEN {PRIO} = '1' THEN 0 WHEN {PRIO} = '2' THEN NULL
                     ELSE floor(o_totalprice / 1000) END AS BIGINT) AS tot_qtyin,
           CAST(o_totalprice AS DECIMAL(18,2)) AS tot_amt_actual,
           CAST(CASE WHEN o_orderstatus <> 'P' THEN CAST(o_totalprice AS DECIMAL(18,2))
                     WHEN {PRIO} <= '2' THEN 0 END AS DECIMAL(18,2)) AS tot_amtin_actual,
           CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS inerid,
           CASE WHEN NOT {pending("5")} THEN o_orderdate END AS intime, {ORDER_ACTIVE} AS isactive,
           CASE WHEN NOT {pending("4")} THEN o_orderdate END AS creationdate
    FROM orders""",
    "src_purchase_item": """
    SELECT l_orderkey * 8 + l_linenumber AS id, l_orderkey AS purchase_id, qty,
           CASE WHEN l_returnflag = 'R' THEN qty WHEN l_returnflag = 'A' THEN CAST(l_quantity AS BIGINT) - 1
                WHEN l_linestatus = 'O' THEN NULL ELSE qty + 1 END AS qtyin,
           CASE WHEN l_linenumber = 7 THEN 'N' ELSE 'Y' END AS isactive, l_shipdate AS creationdate
    FROM (SELECT *, CASE WHEN l_quantity = 50 THEN 0 ELSE CAST(l_quantity AS BIGINT) END AS qty FROM lineitem)""",
    "src_transfer": f"""
    SELECT *, CASE WHEN arrived THEN 2 ELSE 1 END AS in_status,
           CASE WHEN arrived THEN {key("(CAST(o_orderdate AS DATE) + 2)")} END AS datein
    FROM (
    SELECT o_orderkey AS id, 'TF' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS docno,
           CASE WHEN {pending("5")} THEN NULL WHEN {pending("4")} THEN 0 ELSE {key("o_orderdate")} END AS billdate,
           CASE o_custkey % 9 WHEN 0 THEN 'ORD' WHEN 1 THEN 'NOR' WHEN 2 THEN 'ADD' WHEN 3 THEN 'DIF' WHEN 4 THEN 'OUT'
                WHEN 5 THEN 'IN' WHEN 6 THEN 'EOR' WHEN 7 THEN 'XXX' END AS transfertype,
           o_custkey % 27 AS orig_id, CASE WHEN NOT {pending("3")} THEN o_orderkey % 25 END AS dest_id,
           CAST(floor(o_totalprice / 1000) AS BIGINT) AS tot_qty,
           CASE WHEN o_orderstatus = 'P' THEN 0 ELSE CAST(floor(o_totalprice / 1000) AS BIGINT) END AS tot_qtyout,
           CAST(CASE WHEN o_orderstatus = 'F' THEN floor(o_totalprice / 1000) WHEN o_orderstatus = 'P' THEN 0
                     WHEN {PRIO} = '1' THEN floor(o_totalprice / 1000) - 1 WHEN {PRIO} = '2' THEN 0
                     ELSE floor(o_totalprice / 1000) END AS BIGINT) AS tot_qtyin,
           CAST(o_totalprice AS DECIMAL(18,2)) AS tot_amtqty_list,
           CASE {PRIO} WHEN '1' THEN 1 WHEN '2' THEN 3 WHEN '3' THEN NULL ELSE 2 END AS status,
           CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 2 END AS confirm_status,
           CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 2 END AS out_status,
           CASE WHEN o_orderstatus <> 'P' THEN {key("(CAST(o_orderdate AS DATE) + 1)")} END AS dateout,
           {ORDER_ACTIVE} AS isactive, CASE WHEN NOT {pending("4")} THEN o_orderdate END AS creationdate,
           o_orderdate, o_orderstatus = 'F' OR (o_orderstatus = 'O' AND {PRIO} >= '4') AS arrived
    FROM orders)""",
    "src_transfer_item": """
    SELECT l_orderkey * 8 + l_linenumber AS id, l_orderkey AS transfer_id, CAST(l_quantity AS BIGINT) AS qty,
           CASE WHEN l_linenumber = 7 THEN 'N' ELSE 'Y' END AS isactive, l_shipdate AS creationdate
    FROM lineitem""",
    "counted": f"""
    SELECT o_orderkey AS id,
           CASE WHEN {pending("3")} THEN NULL
                WHEN o_orderpriority = '2-HIGH' THEN coalesce(n, 0) + 1 ELSE coalesce(n, 0) END AS total,
           {ORDER_ACTIVE} AS isactive
    FROM orders LEFT JOIN (SELECT l_orderkey, CAST(sum(l_quantity) AS BIGINT) AS n FROM lineitem WHERE l_linenumber <> 7
                           GROUP BY l_orderkey) ON l_orderkey = o_orderkey""",
    # -- warehouse tables
    "labels": "SELECT id AS label_id, attribname AS label FROM src_dim",
    "dim_product": f"""
    SELECT id AS product_id, name AS product_code, value AS product_name, coalesce(m_dim4_id, 0) AS category_id,
           coalesce(category.label, '未分类') AS category_name, coalesce(m_dim5_id, 0) AS property_id,
           coalesce(property.label, '未知') AS property_name, coalesce(m_dim6_id, 0) AS series_id,
           coalesce(series.label, '') AS series_name, coalesce(m_dim1_id, 0) AS brand_id,
           coalesce(brand.label, '') AS brand_name, CAST(coalesce(pricelist, 0) AS DOUBLE) AS price_list,
           coalesce(fabelement, '') AS material, CAST(coalesce(precost, 0) AS DOUBLE) AS price_cost,
           if(coalesce(m_dim4_id IN {MAIN}, false), 'Y', 'N') AS is_main_product, isactive AS is_active,
           creationdate AS created_at
    FROM (SELECT * FROM src_product WHERE isactive = 'Y')
    LEFT JOIN labels category ON category.label_id = m_dim4_id LEFT JOIN labels property ON property.label_id = m_dim5_id
    LEFT JOIN labels series ON series.label_id = m_dim6_id LEFT JOIN labels brand ON brand.label_id = m_dim1_id""",
    "dim_sku": """
    SELECT id AS sku_id, coalesce(no, '') AS sku_barcode, product_id, coalesce(value1, '') AS sku_color,
           coalesce(value2, '') AS sku_size, isactive AS is_active, creationdate AS created_at
    FROM (SELECT * FROM src_alias WHERE isactive = 'Y')
    LEFT JOIN (SELECT id AS attr_id, value1, value2 FROM src_attr) USING (attr_id)""",
    "dim_store": f"""
    SELECT id AS store_id, code AS store_code, name AS store_name, coalesce(area_id, 0) AS area_id,
           coalesce(area_name, '未知区域') AS area_name, coalesce(is_warehouse, 0) AS is_warehouse,
           coalesce(is_store, 0) AS is_store, coalesce(is_cloud, 'N') AS is_cloud_store,
           coalesce(is_center, 'N') AS is_center,
           {by_code("code", L.STORE_MAIN, [("DS", L.STORE_ECOMMERCE), ("RT", L.STORE_SHOP), ("CS", L.STORE_TEST)], L.STORE_FUNCTIONAL)}
               AS store_type,
           isactive AS is_active
    FROM (SELECT * FROM src_store WHERE isactive = 'Y')
    LEFT JOIN (SELECT id AS area_id, name AS area_name FROM src_area) USING (area_id)""",
    "dim_channel": """
    SELECT CAST(c.channel_id AS INTEGER) AS channel_id, c.channel_name, c.channel_code, c.store_code,
           coalesce(c.is_main, 0) AS is_main, c.platform_type, coalesce(s.isactive, 'N') AS is_active
    FROM src_channel c LEFT JOIN src_store s ON c.store_code = s.code""",
    "dws_sales": sales_sql(19950101, AS_OF_KEY),
    "dws_sales_recent": sales_sql(D30, AS_OF_KEY),
    "dws_sales_range": sales_sql(LO, HI),
    "dws_inventory": f"""
    SELECT {AS_OF_KEY} AS date_id, store_id, coalesce(code, '') AS store_code, coalesce(is_cloud, 'N') AS is_cloud_store,
           product_id, sku_id AS m_productalias_id, CAST(coalesce(sum(qty), 0) AS BIGINT) AS qty,
           CAST(coalesce(sum(qty), 0) AS BIGINT) AS qty_valid, CAST(0 AS BIGINT) AS qty_occupy,
           CAST(coalesce(sum(qtypurchaserem), 0) AS BIGINT) AS qtypurchaserem
    FROM (SELECT * FROM src_storage WHERE isactive = 'Y' AND sku_id IS NOT NULL
          AND product_id IN (SELECT id FROM src_product WHERE m_dim4_id IN {MAIN}))
    JOIN (SELECT id AS store_id, code, is_cloud FROM src_store WHERE {STOCK_SCOPE}) USING (store_id)
    GROUP BY ALL""",
    "stock_side": f"""
    SELECT product_id, m_productalias_id AS sku_id, CAST(sum(qty) AS BIGINT) AS total_qty,
           CAST(coalesce(sum(qty) FILTER (WHERE s.store_code = '001'), 0) AS BIGINT) AS warehouse_qty,
           CAST(coalesce(sum(qty) FILTER (WHERE s.is_cloud_store = 'Y'), 0) AS BIGINT) AS cloud_qty,
           CAST(sum(qtypurchaserem) AS BIGINT) AS purchase_rem_qty
    FROM dws_inventory JOIN dim_store s USING (store_id) WHERE {W_STOCK_SCOPE} GROUP BY ALL""",
    "sales_side": f"""
    SELECT product_id, m_productalias_id AS sku_id, CAST(sum(sales_qty) AS BIGINT) AS sales_qty_30d,
           CAST(sum(sales_amount) AS DECIMAL(18,2)) AS sales_amt_30d,
           CAST(coalesce(sum(sales_qty) FILTER (WHERE date_id >= {D7}), 0) AS BIGINT) AS sales_qty_7d,
           CAST(sum(return_qty) AS BIGINT) AS return_qty_30d,
           CAST(sum(return_amount) AS DECIMAL(18,2)) AS return_amount_30d
    FROM dws_sales_recent WHERE store_id IN (SELECT store_id FROM dim_store s WHERE {W_SALES_SCOPE}) GROUP BY ALL""",
    "sku_window": """
    SELECT * REPLACE (coalesce(sales_qty_30d, 0) AS sales_qty_30d, coalesce(sales_qty_7d, 0) AS sales_qty_7d,
                      coalesce(return_qty_30d, 0) AS return_qty_30d,
                      CAST(coalesce(sales_amt_30d, 0) AS DECIMAL(18,2)) AS sales_amt_30d,
                      CAST(coalesce(return_amount_30d, 0) AS DECIMAL(18,2)) AS return_amount_30d)
    FROM stock_side LEFT JOIN sales_side USING (product_id, sku_id)""",
    "sku_measures": """
    SELECT product_id, sku_id, total_qty, purchase_rem_qty, sales_qty_30d, sales_qty_7d, return_qty_30d FROM sku_window""",
    "health": HEALTH_COLUMNS,
    "ranked": """
    SELECT *, sum(sales_amt_30d) OVER () AS total_,
           sum(sales_amt_30d) OVER (ORDER BY sales_amt_30d DESC, sku_id, product_id
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_,
           row_number() OVER (ORDER BY sales_amt_30d DESC, sku_id, product_id) AS sales_rank
    FROM health""",
    "graded": f"""
    SELECT * EXCLUDE (total_, cum_), {pct(cents("sales_amt_30d"), cents("total_"))} AS sales_ratio,
           {pct(cents("cum_"), cents("total_"))} AS cumulative_ratio,
           CASE WHEN total_ = 0 OR sales_amt_30d = 0 THEN 'C'
                WHEN {cents("cum_ - sales_amt_30d")} * 10 < {cents("total_")} * 3 THEN 'S'
                WHEN {cents("cum_")} * 10 <= {cents("total_")} * 7 THEN 'A'
                WHEN {cents("cum_")} * 10 <= {cents("total_")} * 9 THEN 'B' ELSE 'C' END AS sku_grade,
           {trend("sales_qty_30d", "sales_qty_7d")} AS sales_trend
    FROM ranked""",
}

MART_DOUBLES = "* REPLACE (CAST(sales_amt_30d AS DOUBLE) AS sales_amt_30d, CAST(return_amount_30d AS DOUBLE) AS return_amount_30d)"
FACT_DOUBLES = (
    "* REPLACE (CAST(sales_amount AS DOUBLE) AS sales_amount, CAST(sales_amount_list AS DOUBLE) AS sales_amount_list,"
    " CAST(return_amount AS DOUBLE) AS return_amount)"
)


def with_ctes(body: str) -> str:
    """Put the CTEs a query names, and those they name, in front of it."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                visit(CTES[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body
    return "WITH " + ",\n".join(f"{name} AS ({CTES[name]})" for name in needed) + "\n" + body


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def share(table: str, group: str, columns: str) -> str:
    """Rows per code with their percentage of all rows."""
    return f"SELECT *, {pct('cnt', 'sum(cnt) OVER ()')} AS pct FROM (SELECT {columns} FROM {table} GROUP BY {group})"


def profile(label: str, table: str) -> str:
    return f"""SELECT '{label}' AS table_name, count(*) AS total_rows, count(DISTINCT id) AS distinct_ids,
        count(*) FILTER (WHERE isactive = 'Y') AS active_rows,
        count(*) FILTER (WHERE isactive = 'N') AS inactive_rows,
        min(creationdate) AS first_created, max(creationdate) AS last_created FROM {table}"""


def fill(table: str, *columns: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS field, count(*) AS total_rows, count({c}) AS filled, count(*) - count({c}) AS missing,"
        f" {pct(f'count({c})', 'count(*)')} AS fill_rate, min({c}) AS first_value, max({c}) AS last_value"
        f" FROM {table} WHERE isactive = 'Y'"
        for c in columns
    )


def month(c: str) -> str:
    return f"strftime(strptime(CAST({c} AS VARCHAR), '%Y%m%d'), '%Y-%m')"


def state(column: str, labels: str) -> str:
    inner = f"{column}, count(*) AS cnt"
    return (
        f"SELECT *, CASE {column} {labels} ELSE '其他' END AS label FROM ("
        + share("src_transfer WHERE isactive = 'Y'", column, inner)
        + ")"
    )


def top_receivers(column: str) -> str:
    return f"""SELECT {column}, count(*) AS orders, {big("sum(tot_qty)")} AS ordered_qty,
        {big("sum(tot_qtyin)")} AS received_qty, {pct("sum(tot_qtyin)", "sum(tot_qty)")} AS completion_pct,
        CAST(CAST(sum(tot_amtin_actual) AS DECIMAL(18,2)) AS DOUBLE) AS received_amount
        FROM src_purchase WHERE isactive = 'Y' AND {column} IS NOT NULL GROUP BY {column}
        ORDER BY sum(tot_amtin_actual) DESC NULLS LAST, {column}"""


def top_end(column: str, moved: str) -> str:
    return f"""SELECT store_code, store_name, documents, total_qty, moved_qty FROM
        (SELECT any_value(code) AS store_code, any_value(name) AS store_name, count(*) AS documents,
                {big("sum(tot_qty)")} AS total_qty, {big(f"sum({moved})")} AS moved_qty
         FROM (SELECT {column} AS end_id, * EXCLUDE (id) FROM src_transfer WHERE isactive = 'Y')
         LEFT JOIN (SELECT id AS end_id, code, name FROM src_store) USING (end_id)
         GROUP BY coalesce(code, '?'))
        ORDER BY documents DESC, store_code ASC NULLS LAST LIMIT 10"""


def flow_class(code: str) -> str:
    return by_code(code, L.FLOW_MAIN, [("DS", L.FLOW_ECOMMERCE), ("RT", L.FLOW_SHOP)], L.OTHER)


ENDS = """(SELECT * FROM src_transfer WHERE isactive = 'Y')
    LEFT JOIN (SELECT id AS orig_id, code AS orig_code, name AS orig_name, is_cloud AS orig_cloud FROM src_store) USING (orig_id)
    LEFT JOIN (SELECT id AS dest_id, code AS dest_code, name AS dest_name, is_cloud AS dest_cloud FROM src_store) USING (dest_id)"""


def flows(columns: str) -> str:
    return f"""SELECT *, {pct("documents", "sum(documents) OVER ()")} AS pct FROM (
        SELECT {columns}, count(*) AS documents, {big("sum(tot_qty)")} AS total_qty FROM {ENDS} GROUP BY ALL)"""


def consistency(qty_alias: str) -> str:
    gap = "abs(h.total - coalesce(i.n, 0))"
    return f"""SELECT count(DISTINCT h.id) AS documents, count(*) FILTER (WHERE {gap} <= 0.01) AS consistent,
        count(*) FILTER (WHERE {gap} > 0.01) AS inconsistent,
        {pct(f"count(*) FILTER (WHERE {gap} <= 0.01)", "count(DISTINCT h.id)")} AS consistent_pct
        FROM counted h LEFT JOIN (SELECT l_orderkey AS id, sum(CAST(l_quantity AS BIGINT)) AS n FROM lineitem
        WHERE l_linenumber <> 7 GROUP BY l_orderkey) i ON h.id = i.id WHERE h.isactive = 'Y'"""


def card(table: str, rows: list[tuple[str, str, str, str]]) -> str:
    """Scorecard rows (item, hits, total or NULL, verdict) over the active rows of a table."""
    parts = []
    for item, hits, total, verdict in rows:
        rate = "CAST(NULL AS DOUBLE)" if total == "NULL" else f"coalesce({pct(hits, total)}, 0)"
        parts.append(
            f"SELECT '{item}' AS item, CAST({hits} AS BIGINT) AS hits, CAST({total} AS BIGINT) AS total, {rate} AS rate,"
            f" {verdict.replace('RATE', f'({rate})')} AS verdict FROM {table} WHERE isactive = 'Y'"
        )
    return " UNION ALL ".join(parts)


def present(*conditions: str) -> str:
    return " + ".join(f"CASE WHEN {c} > 0 THEN 1 ELSE 0 END" for c in conditions)


P_DIMS = present("count(store_id)", "count(supplier_id)", "count(billdate)", "count(datein)")
P_MEAS = present("count(*) FILTER (WHERE tot_qtyin > 0)", "count(*) FILTER (WHERE tot_amtin_actual > 0)")
X_RATES = f"coalesce({pct('count(orig_id)', 'count(*)')}, 0) >= 95 AND coalesce({pct('count(dest_id)', 'count(*)')}, 0) >= 95"
X_BOTH = f"CASE WHEN {X_RATES} THEN 'PASS' ELSE 'WARNING' END"
T_SUMS = (
    f"count(*) AS documents, {big('sum(tot_qty)')} AS total_qty, {big('sum(tot_qtyout)')} AS total_out,"
    f" {big('sum(tot_qtyin)')} AS total_in, CAST(CAST(sum(tot_amtqty_list) AS DECIMAL(20,2)) AS DOUBLE) AS total_amount"
)
R_TYPE = by_code("code", L.STORE_MAIN, [("DS", L.STORE_ECOMMERCE), ("RT", L.STORE_SHOP)], L.OTHER)
SEGMENT_NO = (
    "CASE WHEN qtypurchaserem IS NULL OR qtypurchaserem = 0 THEN 0 WHEN qtypurchaserem BETWEEN 1 AND 10 THEN 1"
    " WHEN qtypurchaserem BETWEEN 11 AND 50 THEN 2 WHEN qtypurchaserem BETWEEN 51 AND 100 THEN 3"
    " WHEN qtypurchaserem BETWEEN 101 AND 500 THEN 4 WHEN qtypurchaserem BETWEEN 501 AND 1000 THEN 5"
    " WHEN qtypurchaserem > 1000 THEN 6 ELSE 7 END"
)
SEGMENT_NAMES = str([L.ONORDER_NONE, *(label for label, _, _ in L.ONORDER_RANGES), L.ONORDER_NEGATIVE])
TOP_ROWS = """(SELECT * FROM src_report WHERE isactive = 'Y' AND qtypurchaserem > 0
    ORDER BY qtypurchaserem DESC, product_id, store_id LIMIT {n})"""
NAMES = """LEFT JOIN (SELECT id AS product_id, name AS product_code, value AS product_name FROM src_product) USING (product_id)
    LEFT JOIN (SELECT id AS store_id, code AS store_code, name AS store_name FROM src_store) USING (store_id)"""
BY_QUANTITY = (
    f"CASE WHEN {{got}} < {{ordered}} THEN '{L.RECEIPT_PARTIAL}' WHEN {{got}} = {{ordered}} THEN '{L.RECEIPT_FULL}'"
    f" WHEN {{got}} > {{ordered}} THEN '{L.RECEIPT_OVER}' END"
)
H_CLASS = (
    f"CASE WHEN in_status = 2 AND tot_qtyin > 0 AND tot_qty > 0 THEN {BY_QUANTITY.format(got='tot_qtyin', ordered='tot_qty')}"
    f" WHEN in_status = 1 THEN '{L.RECEIPT_NONE}' WHEN tot_qty = 0 THEN '{L.RECEIPT_NO_QTY}' ELSE '{L.OTHER}' END"
)
I_CLASS = (
    f"CASE WHEN qty = 0 THEN '{L.RECEIPT_NO_QTY}' WHEN qty > 0 AND coalesce(qtyin, 0) = 0 THEN '{L.RECEIPT_NONE}'"
    f" WHEN qty > 0 AND qtyin > 0 THEN {BY_QUANTITY.format(got='qtyin', ordered='qty')} ELSE '{L.OTHER}' END"
)
MEASURES = ("sales_amount", "sales_qty", "return_amount", "return_qty")


def period_orders(grain: str, start: str) -> str:
    """Distinct sale orders per period, channel and category, from the receipts and their lines."""
    return f"""SELECT '{grain}' AS granularity, CAST({start} AS DATE) AS report_date, c.channel_id, p.category_id, p.category_name,
        count(DISTINCT o.receipt) AS order_count
        FROM (SELECT *, strptime(CAST(date_id AS VARCHAR), '%Y%m%d') AS day FROM order_lines) o
        LEFT JOIN dim_channel c ON o.store_code = c.store_code LEFT JOIN dim_product p ON o.product_id = p.product_id GROUP BY ALL"""


def period_rows(grain: str, start: str) -> str:
    return f"""SELECT '{grain}' AS granularity, CAST({start} AS DATE) AS report_date, f.*, c.channel_id, c.channel_name,
        p.category_id, p.category_name
        FROM (SELECT *, strptime(CAST(date_id AS VARCHAR), '%Y%m%d') AS day FROM dws_sales) f
        LEFT JOIN dim_channel c ON f.store_code = c.store_code LEFT JOIN dim_product p ON f.product_id = p.product_id"""


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


DIFF = f"(count(*) - {EXPECTED})"
ORACLES: dict[str, str] = {
    "dim_product": "SELECT * FROM dim_product",
    "dim_product_attr": """SELECT product_id, coalesce(value1, '') AS color, coalesce(value2, '') AS size
        FROM (SELECT id AS product_id FROM src_product WHERE isactive = 'Y')
        LEFT JOIN (SELECT product_id, min({'first': id, 'attr': attr_id}).attr AS attr_id FROM src_alias
                   WHERE isactive = 'Y' GROUP BY product_id) USING (product_id)
        LEFT JOIN (SELECT id AS attr_id, value1, value2 FROM src_attr) USING (attr_id)""",
    "dim_sku": "SELECT * FROM dim_sku",
    "dim_store": "SELECT * FROM dim_store",
    "dim_date": f"""SELECT {key("d")} AS date_id, d AS date_value, CAST(year(d) AS INTEGER) AS date_year,
        CAST(month(d) AS INTEGER) AS date_month, CAST(day(d) AS INTEGER) AS date_day,
        CAST(quarter(d) AS INTEGER) AS date_quarter, CAST(weekofyear(d) AS INTEGER) AS week_of_year,
        CAST(isodow(d) AS INTEGER) AS day_of_week,
        ['周一', '周二', '周三', '周四', '周五', '周六', '周日'][isodow(d)] AS day_name_cn,
        ['一月', '二月', '三月', '四月', '五月', '六月', '七月', '八月', '九月', '十月', '十一月', '十二月'][month(d)]
            AS month_name_cn,
        CAST(isodow(d) >= 6 AS INTEGER) AS is_weekend, 0 AS is_holiday, CAST(NULL AS VARCHAR) AS holiday_name,
        strftime(d, '%Y-%m') AS year_month
        FROM (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS d FROM orders)""",
    "dim_category": f"""SELECT u.category_id, coalesce(d.attribname, '未分类') AS category_name,
        CASE WHEN u.category_id IN {MAIN} THEN 'Y' ELSE 'N' END AS is_main_product,
        CAST(coalesce(list_position([134, 142, 139, 138, 141, 143, 133, 136, 140, 137, 144, 145], u.category_id), 13) AS INTEGER)
            AS sort_order
        FROM (SELECT DISTINCT m_dim4_id AS category_id FROM src_product WHERE m_dim4_id IS NOT NULL) u
        LEFT JOIN src_dim d ON d.id = u.category_id""",
    "dim_channel": "SELECT * FROM dim_channel",
    "sales_daily": f"SELECT {FACT_DOUBLES} FROM dws_sales",
    "inventory_daily": "SELECT * FROM dws_inventory",
    "sales_daily_net": f"""SELECT {FACT_DOUBLES}, sales_qty - return_qty AS net_qty,
        CAST(CAST(sales_amount - return_amount AS DECIMAL(18,2)) AS DOUBLE) AS net_amount FROM dws_sales""",
    "replace_date_range": f"""SELECT {FACT_DOUBLES} FROM (SELECT * FROM dws_sales WHERE date_id < {LO} OR date_id > {HI}
        UNION ALL SELECT * REPLACE (sales_qty + 1 AS sales_qty) FROM dws_sales_range)""",
    "replace_snapshot": f"""SELECT * REPLACE ({D1} AS date_id) FROM dws_inventory
        UNION ALL SELECT * REPLACE (qty + qtypurchaserem AS qty) FROM dws_inventory""",
    "sales_coverage": f"""SELECT {D30} AS start_date, {D1} AS end_date, CAST(30 AS BIGINT) AS days_expected,
        count(DISTINCT date_id) AS day_cnt, 30 - count(DISTINCT date_id) AS days_missing,
        count(DISTINCT date_id) < 30 AS needs_backfill FROM dws_sales WHERE date_id BETWEEN {D30} AND {D1}""",
    "sales_missing_dates": f"""SELECT {key("d")} AS date_id, d AS date_value FROM (SELECT CAST(unnest(generate_series(
        DATE '1995-01-01', {AS_OF}, INTERVAL 1 DAY)) AS DATE) AS d)
        WHERE {key("d")} NOT IN (SELECT date_id FROM dws_sales)""",
    "backfill_sales": f"SELECT {FACT_DOUBLES} FROM dws_sales",
    "inventory_health": f"SELECT {MART_DOUBLES.replace('* REPLACE (', '* REPLACE (CAST(price_list AS DOUBLE) AS price_list, ')} FROM health",
    "stock_totals": "SELECT * FROM stock_side",
    "sales_totals": f"SELECT {MART_DOUBLES} FROM sales_side",
    "sales_totals_moved": f"SELECT {MART_DOUBLES} FROM sales_side",
    "sales_changed_days": f"""SELECT CAST(billdate AS INTEGER) AS date_id,
        count(*) FILTER (WHERE NOT (qty = 37 AND product_id % 7 = 2)) AS lines_before, count(*) AS lines_now
        FROM (SELECT id AS receipt, billdate, store_id FROM src_retail
              WHERE isactive = 'Y' AND status = 2 AND billdate BETWEEN 19950101 AND {AS_OF_KEY})
        JOIN (SELECT retail_id AS receipt, product_id, qty FROM src_item
              WHERE sku_id IS NOT NULL AND product_id IN (SELECT id FROM src_product WHERE m_dim4_id IN {MAIN})) USING (receipt)
        WHERE store_id IN (SELECT id FROM src_store WHERE {SALES_SCOPE})
        GROUP BY 1 HAVING count(*) FILTER (WHERE qty = 37 AND product_id % 7 = 2) > 0""",
    "turnover": f"""SELECT *, {rnd("sales_qty_30d", "30", 2)} AS daily_avg_sales,
        {rnd("sales_qty_7d", "7", 2)} AS daily_avg_sales_7d,
        {rnd("30 * sales_qty_7d", "7 * sales_qty_30d", 2)} AS sales_velocity,
        coalesce({rnd("30 * total_qty", "sales_qty_30d", 1)}, 9999) AS turnover_days FROM sku_measures""",
    "inventory_status": f"""SELECT *, {status_case("total_qty", "sales_qty_30d", STATUS)} AS inventory_status,
        CAST({status_case("total_qty", "sales_qty_30d", PRIORITY)} AS INTEGER) AS status_priority FROM sku_measures""",
    "suggest_qty": f"""SELECT *, {suggest("total_qty", "sales_qty_30d", "return_qty_30d", "purchase_rem_qty")} AS suggest_qty
        FROM sku_measures""",
    "sabc_grade": f"SELECT {MART_DOUBLES.replace('* REPLACE (', '* REPLACE (CAST(price_list AS DOUBLE) AS price_list, ')} FROM graded",
    "sales_trend": f"""SELECT *, {rnd("30 * sales_qty_7d", "7 * sales_qty_30d", 2)} AS sales_velocity,
        {trend("sales_qty_30d", "sales_qty_7d")} AS sales_trend FROM (
        SELECT p.category_id, {big("sum(sales_qty)")} AS sales_qty_30d,
               {big(f"coalesce(sum(sales_qty) FILTER (WHERE date_id >= {D7}), 0)")} AS sales_qty_7d
        FROM dws_sales_recent s JOIN dim_product p ON s.product_id = p.product_id GROUP BY p.category_id)""",
    "status_summary": f"""SELECT inventory_status, count(*) AS sku_count, {big("sum(total_qty)")} AS total_qty
        FROM health GROUP BY inventory_status""",
    "grade_summary": f"""SELECT sku_grade, count(*) AS sku_count, {big("sum(sales_qty_30d)")} AS sales_qty
        FROM graded GROUP BY sku_grade""",
    "replenish_summary": f"""SELECT count(*) FILTER (WHERE purchase_rem_qty > 0) AS sku_with_rem,
        {big("sum(purchase_rem_qty)")} AS total_rem_qty,
        {big("coalesce(sum(suggest_qty) FILTER (WHERE suggest_qty > 0), 0)")} AS total_positive_suggest,
        {big("coalesce(sum(suggest_qty) FILTER (WHERE suggest_qty < 0), 0)")} AS total_negative_suggest,
        {big("sum(suggest_qty)")} AS total_suggest_qty, count(*) FILTER (WHERE suggest_qty < 0) AS sku_with_negative
        FROM health""",
    "export_health": """SELECT snapshot_date, product_id, product_code, product_name, category_id, category_name, total_qty,
        warehouse_qty, cloud_qty, purchase_rem_qty, sales_qty_30d, sales_qty_7d, return_qty_30d, daily_avg_sales,
        daily_avg_sales_7d, sales_velocity, turnover_days, inventory_status, sku_grade, suggest_qty FROM graded""",
    "replenish_product": f"""SELECT product_code, product_name, {dbl("stock")} AS stock_qty,
        {rnd("sold", "30", 4)} AS daily_avg_sales, {rnd("30 * stock", "sold", 1)} AS turnover_days,
        {dbl("returned")} AS return_qty_30d, {dbl("rem")} AS purchase_rem_qty,
        {big("greatest(0, 3 * sold - stock - returned - rem)")} AS suggest_qty
        FROM (SELECT id AS product_id, name AS product_code, value AS product_name FROM src_product WHERE isactive = 'Y')
        JOIN (SELECT product_id, coalesce(sum(qty) FILTER (WHERE total > 0), 0) AS sold,
                     coalesce(sum(abs(qty)) FILTER (WHERE total < 0), 0) AS returned
              FROM src_item JOIN (SELECT id AS retail_id, tot_amt_actual AS total FROM src_retail
                   WHERE isactive = 'Y' AND status = 2 AND billdate BETWEEN {D30} AND {AS_OF_KEY}
                   AND store_id IN (SELECT id FROM src_store WHERE {SALES_SCOPE})) USING (retail_id)
              GROUP BY product_id) USING (product_id)
        JOIN (SELECT id AS product_id, coalesce((SELECT sum(qty) FROM src_storage t WHERE t.product_id = u.id
                     AND t.isactive = 'Y' AND t.store_id IN (SELECT id FROM src_store WHERE {STOCK_SCOPE})), 0) AS stock,
                     coalesce((SELECT sum(qtypurchaserem) FROM src_report t WHERE t.product_id = u.id AND t.isactive = 'Y'
                     AND t.store_id IN (SELECT id FROM src_store WHERE code = '001')), 0) AS rem
              FROM src_product u) USING (product_id)
        WHERE sold > 0 ORDER BY suggest_qty DESC, product_code LIMIT 20""",
    "daily_report": f"""SELECT d.day AS report_date, d.channel_id, d.channel_name, {dbl("d.sales_amount")} AS sales_amount,
        d.sales_qty, {dbl("d.return_amount")} AS return_amount, d.return_qty,
        {dbl("CAST(d.sales_amount - d.return_amount AS DECIMAL(18,2))")} AS net_amount, d.sales_qty - d.return_qty AS net_qty,
        d.order_count, {rnd(cents("d.sales_amount"), "100 * d.order_count", 2)} AS avg_price,
        {pct(cents("d.return_amount"), cents("d.sales_amount"))} AS return_rate,
        {pct(cents("d.sales_amount"), cents("d.listed"))} AS discount_rate,
        {dbl("y.sales_amount")} AS sales_amount_yoy,
        {pct(cents("d.sales_amount - y.sales_amount"), cents("y.sales_amount"))} AS yoy_growth,
        {dbl("m.sales_amount")} AS sales_amount_mom,
        {pct(cents("d.sales_amount - m.sales_amount"), cents("m.sales_amount"))} AS mom_growth
        FROM per_day d
        LEFT JOIN per_day y ON y.day = CAST(d.day - INTERVAL 1 YEAR AS DATE) AND y.channel_id IS NOT DISTINCT FROM d.channel_id
        LEFT JOIN per_day m ON m.day = CAST(d.day - INTERVAL 1 DAY AS DATE) AND m.channel_id IS NOT DISTINCT FROM d.channel_id""",
    "sales_summary": f"""SELECT report_date, granularity, channel_id, channel_name, category_id, category_name,
        {dbl("CAST(sum(sales_amount) AS DECIMAL(18,2))")} AS sales_amount, {big("sum(sales_qty)")} AS sales_qty,
        {dbl("CAST(sum(return_amount) AS DECIMAL(18,2))")} AS return_amount, {big("sum(return_qty)")} AS return_qty,
        {dbl("CAST(sum(sales_amount) - sum(return_amount) AS DECIMAL(18,2))")} AS net_amount,
        {big("coalesce(any_value(order_count), 0)")} AS order_count, count(*) FILTER (WHERE sales_qty > 0) AS sku_count,
        {rnd(cents("sum(sales_amount)"), "100 * coalesce(any_value(order_count), 0)", 2)} AS avg_price
        FROM (SELECT report_date, granularity, channel_id, channel_name, category_id, category_name, m_productalias_id,
              {", ".join(f"sum({m}) AS {m}" for m in MEASURES)}
              FROM ({period_rows("day", "day")} UNION ALL {period_rows("week", "date_trunc('week', day)")}
                    UNION ALL {period_rows("month", "date_trunc('month', day)")})
              GROUP BY ALL) f
        LEFT JOIN (SELECT granularity AS g, report_date AS d, channel_id AS ch, category_id AS ca, order_count FROM (
              {period_orders("day", "day")} UNION ALL {period_orders("week", "date_trunc('week', day)")}
              UNION ALL {period_orders("month", "date_trunc('month', day)")})) o
             ON g = f.granularity AND d = f.report_date AND ch IS NOT DISTINCT FROM f.channel_id AND ca IS NOT DISTINCT FROM f.category_id
        GROUP BY report_date, granularity, channel_id, channel_name, category_id, category_name""",
    "dq_dim_product": """SELECT *, CASE WHEN null_code > 0 OR null_name > 0 OR null_category > 0 THEN 'WARNING' ELSE 'PASS' END
        AS status FROM (SELECT count(*) AS total, count(*) FILTER (WHERE is_main_product = 'Y') AS main_products,
        count(*) FILTER (WHERE is_active = 'Y') AS active_products,
        count(*) FILTER (WHERE product_code IS NULL) AS null_code,
        count(*) FILTER (WHERE product_name IS NULL) AS null_name,
        count(*) FILTER (WHERE category_id IS NULL) AS null_category FROM dim_product)""",
    "dq_dim_store": """SELECT store_type, count(*) AS cnt, (SELECT count(*) FROM dim_store) AS total_stores,
        (SELECT count(*) FROM dim_store WHERE is_cloud_store = 'Y') AS cloud_stores,
        (SELECT count(*) FROM dim_store WHERE store_code = '001') AS main_warehouses,
        CASE WHEN (SELECT count(*) FROM dim_store WHERE store_code = '001') = 0 THEN 'FAIL' ELSE 'PASS' END AS status
        FROM dim_store GROUP BY store_type""",
    "dq_inventory": f"""SELECT *, CAST({EXPECTED} AS BIGINT) AS expected, main_products - {EXPECTED} AS difference,
        {pct(f"abs(main_products - {EXPECTED})", str(EXPECTED))} AS difference_pct,
        CASE WHEN abs(main_products - {EXPECTED}) <= 5 THEN 'PASS' ELSE 'WARNING' END AS status
        FROM (SELECT (SELECT count(*) FROM dws_inventory WHERE date_id = {AS_OF_KEY}) AS rows_today,
        (SELECT count(DISTINCT i.product_id) FROM dws_inventory i JOIN dim_product p ON i.product_id = p.product_id
         JOIN dim_store s ON i.store_id = s.store_id WHERE i.date_id = {AS_OF_KEY} AND {W_STOCK_SCOPE}
         AND p.is_main_product = 'Y') AS main_products)""",
    "dq_sales": f"""SELECT *, CASE WHEN negative_rows > 0 THEN 'WARNING' ELSE 'PASS' END AS status FROM (
        SELECT count(*) AS rows_30d,
        {dbl(f"CAST(sum(sales_amount) FILTER (WHERE {W_SALES_SCOPE}) AS DECIMAL(18,2))")} AS sales_amount,
        {dbl(f"CAST(sum(return_amount) FILTER (WHERE {W_SALES_SCOPE}) AS DECIMAL(18,2))")} AS return_amount,
        count(*) FILTER (WHERE sales_qty < 0 OR sales_amount < 0) AS negative_rows
        FROM dws_sales_recent s WHERE date_id >= {D30})""",
    "dq_health": f"""SELECT *, CASE WHEN section = 'rows' AND abs(value - {EXPECTED}) > 5 THEN 'WARNING' ELSE 'PASS' END AS status
        FROM (SELECT 'rows' AS section, 'total' AS item, count(*) AS value FROM graded
        UNION ALL SELECT 'status', inventory_status, count(*) FROM graded GROUP BY inventory_status
        UNION ALL SELECT 'grade', sku_grade, count(*) FROM graded GROUP BY sku_grade
        UNION ALL SELECT 'replenish', 'restock', {big("coalesce(sum(suggest_qty) FILTER (WHERE suggest_qty > 0), 0)")} FROM graded
        UNION ALL SELECT 'replenish', 'surplus', {big("coalesce(sum(suggest_qty) FILTER (WHERE suggest_qty < 0), 0)")} FROM graded
        UNION ALL SELECT 'replenish', 'surplus_sku', count(*) FILTER (WHERE suggest_qty < 0) FROM graded)""",
    "health_coverage": f"""SELECT *, (SELECT count(*) FROM dim_product WHERE is_main_product = 'Y') AS main_products,
        total - {EXPECTED} AS difference, with_stock_or_sales - {EXPECTED} AS difference_filtered
        FROM (SELECT count(*) AS total, count(*) FILTER (WHERE total_qty > 0 OR sales_amt_30d > 0) AS with_stock_or_sales,
        count(*) FILTER (WHERE total_qty = 0 AND sales_amt_30d = 0) AS zero_both,
        count(*) FILTER (WHERE inventory_status = '停售') AS stopped FROM health)""",
    "inventory_coverage": f"""SELECT *, (SELECT count(*) FROM dim_product WHERE is_main_product = 'Y') AS main_products,
        abs(products_with_stock - {EXPECTED}) AS difference,
        {pct(f"abs(products_with_stock - {EXPECTED})", str(EXPECTED), 1)} AS difference_pct
        FROM (SELECT count(DISTINCT i.product_id) AS products_with_stock, count(*) AS stock_rows
        FROM dws_inventory i JOIN dim_product p ON i.product_id = p.product_id JOIN dim_store s ON i.store_id = s.store_id
        WHERE i.date_id = {AS_OF_KEY} AND {W_STOCK_SCOPE} AND p.is_main_product = 'Y')""",
    "table_counts": " UNION ALL ".join(
        f"SELECT '{label}' AS table_name, count(*) AS row_count FROM {cte}"
        for label, cte in (
            ("dim_product", "dim_product"), ("dim_sku", "dim_sku"), ("dim_store", "dim_store"),
            ("dws_sales_daily", "dws_sales"), ("dws_inventory_daily", "dws_inventory"), ("ads_inventory_health", "health"),
        )
    ),
    "dq_rules": " UNION ALL ".join(
        f"SELECT 'completeness' AS rule, '{label}.{k}' AS subject, count(*) AS checked, count(*) - count({k}) AS violations,"
        f" {pct(f'count({k})', 'count(*)')} AS pct, CASE WHEN count({k}) < count(*) THEN 'FAIL' ELSE 'PASS' END AS status FROM {cte}"
        for label, k, cte in (
            ("dim_product", "product_id", "dim_product"), ("dim_sku", "sku_id", "dim_sku"),
            ("dim_store", "store_id", "dim_store"), ("dws_sales_daily", "m_productalias_id", "dws_sales_recent"),
        )
    )
    + f""" UNION ALL SELECT 'consistency', 'sales amount: header vs lines', n, CAST(1000 * abs(h - l) >= abs(h) AS BIGINT),
        {pct(cents("abs(h - l)"), cents("abs(h)"))}, CASE WHEN 1000 * abs(h - l) >= abs(h) THEN 'WARNING' ELSE 'PASS' END
        FROM (SELECT count(*) AS n, sum(tot_amt_actual) AS h, sum(coalesce(x, 0)) AS l FROM src_retail LEFT JOIN
        (SELECT retail_id, sum(tot_amt_actual) AS x FROM src_item GROUP BY retail_id) ON retail_id = id WHERE isactive = 'Y')
        UNION ALL SELECT 'document_consistency', 'sales amount: header vs lines', n, bad, {pct("(n - bad)", "n")},
        CASE WHEN bad > 0 THEN 'WARNING' ELSE 'PASS' END FROM (
        SELECT count(*) AS n, count(*) FILTER (WHERE h <> l AND 1000 * abs(h - l) >= abs(h)) AS bad
        FROM (SELECT tot_amt_actual AS h, coalesce(x, 0) AS l FROM src_retail LEFT JOIN
        (SELECT retail_id, sum(tot_amt_actual) AS x FROM src_item GROUP BY retail_id) ON retail_id = id WHERE isactive = 'Y'))
        UNION ALL SELECT 'timeliness', 'dws_sales_daily.date_id', count(*), CAST(coalesce(max(date_id), 0) < {D1} AS BIGINT),
        NULL, CASE WHEN coalesce(max(date_id), 0) < {D1} THEN 'WARNING' ELSE 'PASS' END FROM dws_sales_recent
        UNION ALL SELECT 'accuracy', 'ads_inventory_health.turnover_days', count(*),
        count(*) FILTER (WHERE turnover_days < 0 OR turnover_days > 1000),
        {pct("count(*) FILTER (WHERE turnover_days < 0 OR turnover_days > 1000)", "count(*)")},
        CASE WHEN count(*) FILTER (WHERE turnover_days < 0 OR turnover_days > 1000) > 0 THEN 'WARNING' ELSE 'PASS' END
        FROM health""",
    "run_checks": f"""SELECT 'dim_product' AS check_name, count(*) AS measured, CASE WHEN count(product_code) < count(*)
        OR count(product_name) < count(*) OR count(category_id) < count(*) THEN 'WARNING' ELSE 'PASS' END AS status
        FROM dim_product
        UNION ALL SELECT 'dim_store', count(*), CASE WHEN count(*) FILTER (WHERE store_code = '001') = 0 THEN 'FAIL'
        ELSE 'PASS' END FROM dim_store
        UNION ALL SELECT 'dws_inventory_daily', count(DISTINCT i.product_id),
        CASE WHEN abs(count(DISTINCT i.product_id) - {EXPECTED}) <= 5 THEN 'PASS' ELSE 'WARNING' END
        FROM dws_inventory i JOIN dim_product p ON i.product_id = p.product_id JOIN dim_store s ON i.store_id = s.store_id
        WHERE {W_STOCK_SCOPE} AND p.is_main_product = 'Y'
        UNION ALL SELECT 'dws_sales_daily', count(*), CASE WHEN count(*) FILTER (WHERE sales_qty < 0 OR sales_amount < 0) > 0
        THEN 'WARNING' ELSE 'PASS' END FROM dws_sales_recent
        UNION ALL SELECT 'ads_inventory_health', count(*), CASE WHEN abs({DIFF}) <= 5 THEN 'PASS' ELSE 'WARNING' END FROM health""",
    "purchase_profile": profile("M_PURCHASE", "src_purchase") + " UNION ALL " + profile("M_PURCHASEITEM", "src_purchase_item"),
    "purchase_sample": """SELECT * REPLACE (CAST(tot_amt_actual AS DOUBLE) AS tot_amt_actual,
        CAST(tot_amtin_actual AS DOUBLE) AS tot_amtin_actual) FROM src_purchase WHERE isactive = 'Y'
        ORDER BY creationdate DESC NULLS LAST, id LIMIT 10""",
    "purchase_in_status": share("src_purchase WHERE isactive = 'Y'", "in_status", "in_status, count(*) AS cnt"),
    "purchase_datein_fill": fill("src_purchase", "datein"),
    "purchase_qtyin_stats": f"""SELECT count(*) AS total_rows, count(*) FILTER (WHERE tot_qtyin > 0) AS with_qty,
        count(*) FILTER (WHERE tot_qtyin = 0) AS zero_qty, count(*) FILTER (WHERE tot_qtyin IS NULL) AS null_qty,
        {big("sum(tot_qtyin)")} AS total_qty, {rnd("sum(tot_qtyin)", "count(tot_qtyin)", 2)} AS avg_qty
        FROM src_purchase WHERE isactive = 'Y'""",
    "purchase_amtin_stats": f"""SELECT count(*) AS total_rows, count(*) FILTER (WHERE tot_amtin_actual > 0) AS with_amount,
        count(*) FILTER (WHERE tot_amtin_actual = 0) AS zero_amount,
        {dbl("CAST(sum(tot_amtin_actual) AS DECIMAL(18,2))")} AS total_amount,
        {rnd(cents("sum(tot_amtin_actual)"), "100 * count(tot_amtin_actual)", 2)} AS avg_amount
        FROM src_purchase WHERE isactive = 'Y'""",
    "purchase_receiver_fill": """SELECT count(*) AS total_rows, count(inerid) AS with_receiver, count(intime) AS with_time,
        count(*) FILTER (WHERE inerid IS NOT NULL AND intime IS NOT NULL) AS with_both
        FROM src_purchase WHERE isactive = 'Y'""",
    "purchase_receipt_compare": """SELECT count(*) AS total_rows, count(*) FILTER (WHERE tot_qty > 0) AS with_ordered,
        count(*) FILTER (WHERE tot_qtyin > 0) AS with_received,
        count(*) FILTER (WHERE tot_qty = tot_qtyin) AS full_receipts,
        count(*) FILTER (WHERE tot_qtyin < tot_qty AND tot_qtyin > 0) AS partial_receipts,
        count(*) FILTER (WHERE tot_qtyin > tot_qty) AS over_receipts,
        count(*) FILTER (WHERE tot_qtyin = 0 OR tot_qtyin IS NULL) AS no_receipts
        FROM src_purchase WHERE isactive = 'Y' AND tot_qty > 0""",
    "purchase_completion": f"""SELECT *, {pct("received_qty", "ordered_qty")} AS completion_pct FROM (
        {share("src_purchase WHERE isactive = 'Y'", "1", f"{H_CLASS} AS receipt_class, count(*) AS cnt, {big('sum(tot_qty)')} AS ordered_qty, {big('sum(tot_qtyin)')} AS received_qty")})""",
    "purchase_monthly": f"""SELECT {month("datein")} AS month, count(*) AS receipts, {big("sum(tot_qty)")} AS ordered_qty,
        {big("sum(tot_qtyin)")} AS received_qty, {dbl("CAST(sum(tot_amt_actual) AS DECIMAL(18,2))")} AS ordered_amount,
        {dbl("CAST(sum(tot_amtin_actual) AS DECIMAL(18,2))")} AS received_amount
        FROM src_purchase WHERE isactive = 'Y' AND datein IS NOT NULL AND datein > 0 GROUP BY 1 ORDER BY 1 DESC""",
    "purchase_by_supplier": top_receivers("supplier_id"),
    "purchase_by_store": top_receivers("store_id"),
    "purchase_item_stats": f"""SELECT count(*) AS total_rows, count(*) FILTER (WHERE qtyin > 0) AS with_qty,
        count(*) FILTER (WHERE qtyin = 0) AS zero_qty, count(*) FILTER (WHERE qtyin IS NULL) AS null_qty,
        {big("sum(qty)")} AS ordered_qty, {big("sum(qtyin)")} AS received_qty, {pct("sum(qtyin)", "sum(qty)")} AS completion_pct,
        {rnd("sum(qty)", "count(qty)", 2)} AS avg_ordered, {rnd("sum(qtyin)", "count(qtyin)", 2)} AS avg_received
        FROM src_purchase_item WHERE isactive = 'Y'""",
    "purchase_item_completion": share(
        "src_purchase_item WHERE isactive = 'Y'", "1",
        f"{I_CLASS} AS receipt_class, count(*) AS cnt, {big('sum(qty)')} AS ordered_qty, {big('sum(qtyin)')} AS received_qty",
    ),
    "purchase_consistency": consistency("qtyin"),
    "purchase_scorecard": card(
        "src_purchase",
        [
            ("receipt_date", "count(datein)", "count(*)",
             "CASE WHEN RATE >= 95 THEN 'PASS' WHEN RATE >= 80 THEN 'WARNING' ELSE 'FAIL' END"),
            ("receipt_status", "count(*) FILTER (WHERE in_status = 2)", "count(*)", "'PASS'"),
            ("receipt_quantity", "count(*) FILTER (WHERE tot_qtyin > 0)", "count(*)", "'PASS'"),
            ("dimensions", P_DIMS, "4", f"CASE WHEN {P_DIMS} >= 3 THEN 'PASS' ELSE 'WARNING' END"),
            ("measures", P_MEAS, "2", f"CASE WHEN {P_MEAS} >= 2 THEN 'PASS' ELSE 'WARNING' END"),
            ("full_receipts", "count(*) FILTER (WHERE tot_qty > 0 AND tot_qty = tot_qtyin)",
             "count(*) FILTER (WHERE tot_qty > 0)", "CASE WHEN RATE >= 80 THEN 'PASS' ELSE 'WARNING' END"),
        ],
    ),
    "transfer_profile": profile("M_TRANSFER", "src_transfer") + " UNION ALL " + profile("M_TRANSFERITEM", "src_transfer_item"),
    "transfer_sample": """SELECT id, docno, billdate, transfertype, orig_id, dest_id, tot_qty, tot_qtyout, tot_qtyin, status,
        confirm_status, out_status, in_status, dateout, datein, isactive, creationdate FROM src_transfer
        WHERE isactive = 'Y' ORDER BY creationdate DESC NULLS LAST, id LIMIT 10""",
    "transfer_by_type": "SELECT *, CASE transfertype WHEN 'ORD' THEN '订单调拨' WHEN 'NOR' THEN '正常调拨' WHEN 'ADD' THEN '补货调拨'"
    " WHEN 'DIF' THEN '差异调拨' WHEN 'OUT' THEN '代销出库' WHEN 'IN' THEN '代销退货' WHEN 'EOR' THEN '云仓调拨' ELSE '其他' END AS label FROM ("
    + share(
        "src_transfer WHERE isactive = 'Y'", "transfertype",
        f"transfertype, count(*) AS cnt, {big('sum(tot_qty)')} AS total_qty, {big('sum(tot_qtyout)')} AS total_out,"
        f" {big('sum(tot_qtyin)')} AS total_in",
    )
    + ")",
    "transfer_status": state("status", "WHEN 1 THEN '未提交' WHEN 2 THEN '已提交' WHEN 3 THEN '待批'"),
    "transfer_confirm": state("confirm_status", "WHEN 1 THEN '未确认' WHEN 2 THEN '已确认'"),
    "transfer_out": state("out_status", "WHEN 1 THEN '未出库' WHEN 2 THEN '已出库'"),
    "transfer_in": state("in_status", "WHEN 1 THEN '未入库' WHEN 2 THEN '已入库'"),
    "transfer_top_origin": top_end("orig_id", "tot_qtyout"),
    "transfer_top_dest": top_end("dest_id", "tot_qtyin"),
    "transfer_flow": flows(f"{flow_class('orig_code')} AS origin_class, {flow_class('dest_code')} AS dest_class"),
    "transfer_date_fill": fill("src_transfer", "billdate", "dateout", "datein"),
    "transfer_qty_compare": f"""SELECT count(*) AS total_rows, {big("sum(tot_qty)")} AS total_qty,
        {big("sum(tot_qtyout)")} AS total_out, {big("sum(tot_qtyin)")} AS total_in,
        count(*) FILTER (WHERE tot_qty = tot_qtyout AND tot_qtyout = tot_qtyin) AS all_equal,
        count(*) FILTER (WHERE tot_qty > 0 AND tot_qtyout = 0) AS not_sent,
        count(*) FILTER (WHERE tot_qtyout > 0 AND tot_qtyin = 0) AS sent_not_received,
        count(*) FILTER (WHERE tot_qtyin > 0 AND tot_qtyin < tot_qtyout) AS partly_received,
        count(*) FILTER (WHERE tot_qtyin <> tot_qtyout AND tot_qtyin > 0 AND tot_qtyout > 0) AS sent_received_differ
        FROM src_transfer WHERE isactive = 'Y'""",
    "transfer_consistency": consistency("qty"),
    "transfer_monthly": f"""SELECT {month("billdate")} AS month, {T_SUMS} FROM src_transfer
        WHERE isactive = 'Y' AND billdate IS NOT NULL AND billdate > 0 GROUP BY 1 ORDER BY 1 DESC LIMIT 12""",
    "transfer_cloud": f"SELECT {T_SUMS} FROM src_transfer WHERE isactive = 'Y' AND transfertype = 'EOR'",
    "transfer_cloud_direction": flows(
        f"CASE WHEN orig_cloud = 'Y' AND dest_cloud = 'Y' THEN '{L.CLOUD_TO_CLOUD}' WHEN orig_cloud = 'Y' THEN '{L.CLOUD_TO_OTHER}'"
        f" WHEN dest_cloud = 'Y' THEN '{L.OTHER_TO_CLOUD}' ELSE '{L.OTHER_TO_OTHER}' END AS direction"
    ),
    "transfer_scorecard": card(
        "src_transfer",
        [
            ("origin", "count(orig_id)", "count(*)", X_BOTH),
            ("destination", "count(dest_id)", "count(*)", X_BOTH),
            ("bill_date", "count(billdate)", "count(*)", "'PASS'"),
            ("sent", "count(*) FILTER (WHERE out_status = 2)", "count(*)", "'PASS'"),
            ("received", "count(*) FILTER (WHERE in_status = 2)", "count(*)", "'PASS'"),
            ("planned_qty", "sum(tot_qty)", "NULL", "'PASS'"),
            ("sent_qty", "sum(tot_qtyout)", "NULL", "'PASS'"),
            ("received_qty", "sum(tot_qtyin)", "NULL", "'PASS'"),
            ("transfer_types", "count(DISTINCT transfertype)", "NULL", "'PASS'"),
        ],
    ),
    "transfer_completed": f"""SELECT id, docno, billdate, transfertype, orig_id, orig_code, orig_name, dest_id, dest_code, dest_name,
        tot_qty, tot_qtyout, tot_qtyin FROM {ENDS} WHERE out_status = 2 AND in_status = 2""",
    "stock_overview": f"""SELECT count(*) AS total_rows, count(DISTINCT product_id) AS products, count(DISTINCT store_id) AS stores,
        count(*) FILTER (WHERE isactive = 'Y') AS active_rows, {big("sum(qty)")} AS total_qty,
        {big("sum(qtypurchaserem)")} AS total_on_order FROM src_report""",
    "onorder_fill": f"""SELECT count(*) AS total_rows, count(qtypurchaserem) AS filled,
        count(*) FILTER (WHERE qtypurchaserem > 0) AS positive,
        count(*) FILTER (WHERE qtypurchaserem = 0 OR qtypurchaserem IS NULL) AS none,
        count(*) FILTER (WHERE qtypurchaserem < 0) AS negative,
        {pct("count(qtypurchaserem)", "count(*)")} AS fill_rate FROM src_report WHERE isactive = 'Y'""",
    "onorder_distribution": f"""SELECT min(qtypurchaserem) AS min_qty, max(qtypurchaserem) AS max_qty,
        {rnd("sum(qtypurchaserem)", "count(*)", 2)} AS avg_qty, {dbl("median(qtypurchaserem)")} AS median_qty,
        {big("sum(qtypurchaserem)")} AS total_qty FROM src_report WHERE isactive = 'Y' AND qtypurchaserem > 0""",
    "onorder_median_sketch": """SELECT CAST(store_id AS BIGINT) AS store_id, count(*) AS n, TRUE AS "within" FROM src_report
        WHERE isactive = 'Y' AND qtypurchaserem > 0 GROUP BY GROUPING SETS ((store_id), ()) HAVING count(*) > 0""",
    "onorder_segments": f"SELECT *, {SEGMENT_NAMES}[segment_no + 1] AS segment FROM ("
    + share(
        "src_report WHERE isactive = 'Y'", "ALL",
        f"CAST({SEGMENT_NO} AS INTEGER) AS segment_no, count(*) AS cnt, {big('sum(qtypurchaserem)')} AS on_order_qty",
    )
    + ")",
    "onorder_by_store": f"""SELECT code AS store_code, name AS store_name, {R_TYPE} AS store_type, sku_count, stock_qty,
        on_order_qty, sku_with_on_order
        FROM (SELECT store_id, count(product_id) AS sku_count, {big("sum(qty)")} AS stock_qty,
              {big("sum(qtypurchaserem)")} AS on_order_qty, count(*) FILTER (WHERE qtypurchaserem > 0) AS sku_with_on_order
              FROM src_report WHERE isactive = 'Y' GROUP BY store_id)
        LEFT JOIN (SELECT id AS store_id, code, name FROM src_store) USING (store_id)
        ORDER BY on_order_qty DESC NULLS LAST, code LIMIT 15""",
    "onorder_top_products": f"""SELECT product_code, product_name, qtypurchaserem AS on_order_qty, qty AS stock_qty, store_code,
        store_name FROM {TOP_ROWS.format(n=20)} {NAMES}""",
    "stock_source_compare": " UNION ALL ".join(
        f"SELECT '{label}' AS table_name, count(*) AS total_rows, count(DISTINCT product_id) AS products,"
        f" count(DISTINCT store_id) AS stores, CAST(sum(qty) AS DOUBLE) AS total_qty FROM {cte} WHERE isactive = 'Y'"
        for label, cte in (("FA_STORAGE", "src_storage"), ("RP_SIMPLESTORAGE", "src_report"))
    ),
    "stock_grain_match": """SELECT n_left + n_right - n_both AS total_pairs, n_both AS in_both, n_left - n_both AS left_only,
        n_right - n_both AS right_only FROM (SELECT (SELECT count(DISTINCT (product_id, store_id)) FROM src_storage
        WHERE isactive = 'Y') AS n_left, (SELECT count(DISTINCT (product_id, store_id)) FROM src_report
        WHERE isactive = 'Y') AS n_right, (SELECT count(*) FROM (SELECT product_id, store_id FROM src_storage
        WHERE isactive = 'Y' INTERSECT SELECT product_id, store_id FROM src_report WHERE isactive = 'Y')) AS n_both)""",
    "onorder_sample": f"""SELECT product_id, product_code, product_name, store_id, store_code, qty AS stock_qty,
        qtypurchaserem AS on_order_qty, isactive FROM {TOP_ROWS.format(n=10)} {NAMES}""",
    "warehouse_onorder": f"""SELECT product_id, product_code, product_name, stock_qty, on_order_qty
        FROM (SELECT product_id, {big("sum(qty)")} AS stock_qty, {big("sum(qtypurchaserem)")} AS on_order_qty FROM src_report
              WHERE isactive = 'Y' AND store_id IN (SELECT id FROM src_store WHERE code = '001') GROUP BY product_id)
        LEFT JOIN (SELECT id AS product_id, name AS product_code, value AS product_name FROM src_product) USING (product_id)
        WHERE on_order_qty > 0""",
    "stock_with_onorder": """SELECT product_id, product_code, store_id, '001' AS store_code, qty AS stock_qty,
        coalesce(rem, 0) AS on_order_qty, qty + coalesce(rem, 0) AS available_qty
        FROM (SELECT product_id, store_id, qty FROM src_storage WHERE isactive = 'Y'
              AND store_id IN (SELECT id FROM src_store WHERE code = '001'))
        LEFT JOIN (SELECT id AS product_id, name AS product_code FROM src_product) USING (product_id)
        LEFT JOIN (SELECT product_id, store_id, qtypurchaserem AS rem FROM src_report WHERE isactive = 'Y')
             USING (product_id, store_id)""",
    "onorder_scalar_subquery": f"""SELECT product_id, {big("sum(qtypurchaserem)")} AS on_order_qty FROM src_report
        WHERE isactive = 'Y' AND store_id = (SELECT id FROM src_store WHERE code = '001') GROUP BY product_id""",
    "stock_scorecard": card(
        "src_report",
        [
            ("column_present", "1", "1", "'PASS'"),
            ("active_rows", "count(*)", "NULL", "'PASS'"),
            ("rows_with_on_order", "count(*) FILTER (WHERE qtypurchaserem > 0)", "count(*)", "'PASS'"),
            ("on_order_total", "sum(qtypurchaserem)", "NULL", "'PASS'"),
        ],
    ).replace("FROM src_report WHERE isactive = 'Y' UNION ALL", "FROM (SELECT 1) UNION ALL", 1),
    "source_candidates": """SELECT 'RP_SIMPLESTORAGE' AS table_name, count(*) AS total_rows, true AS has_column,
        count(qtypurchaserem) AS filled, count(*) FILTER (WHERE qtypurchaserem > 0) AS positive,
        CAST(sum(qtypurchaserem) AS DOUBLE) AS total_qty FROM src_report
        UNION ALL SELECT 'FA_STORAGE', count(*), true, count(qtypurchaserem), count(*) FILTER (WHERE qtypurchaserem > 0),
        CAST(sum(qtypurchaserem) AS DOUBLE) FROM src_storage
        UNION ALL SELECT 'M_PURCHASE', count(*), false, NULL, NULL, NULL FROM src_purchase""",
}

CTES["per_day"] = """
    SELECT CAST(strptime(CAST(date_id AS VARCHAR), '%Y%m%d') AS DATE) AS day, c.channel_id, c.channel_name,
           CAST(sum(sales_amount) AS DECIMAL(18,2)) AS sales_amount, CAST(sum(sales_amount_list) AS DECIMAL(18,2)) AS listed,
           CAST(sum(sales_qty) AS BIGINT) AS sales_qty, CAST(sum(return_amount) AS DECIMAL(18,2)) AS return_amount,
           CAST(sum(return_qty) AS BIGINT) AS return_qty, coalesce(any_value(orders), 0) AS order_count
    FROM dws_sales f LEFT JOIN dim_channel c ON f.store_code = c.store_code
    LEFT JOIN (SELECT o.date_id AS order_day, h.channel_id AS order_channel, count(DISTINCT receipt) AS orders
               FROM order_lines o LEFT JOIN dim_channel h ON o.store_code = h.store_code GROUP BY 1, 2)
         ON order_day = date_id AND order_channel IS NOT DISTINCT FROM c.channel_id
    GROUP BY 1, c.channel_id, c.channel_name"""
CTES["order_lines"] = f"""
    SELECT DISTINCT billdate AS date_id, coalesce(code, '') AS store_code, product_id, receipt
    FROM (SELECT id AS receipt, billdate, store_id FROM src_retail
          WHERE isactive = 'Y' AND status = 2 AND tot_amt_actual > 0 AND billdate BETWEEN 19950101 AND {AS_OF_KEY})
    JOIN (SELECT retail_id AS receipt, product_id FROM src_item
          WHERE sku_id IS NOT NULL AND product_id IN (SELECT id FROM src_product WHERE m_dim4_id IN {MAIN})) USING (receipt)
    JOIN (SELECT id AS store_id, code FROM src_store WHERE {SALES_SCOPE}) USING (store_id)"""

# The stored forms give the rows of the jobs that they store.
ORACLES |= {
    "stored_overwrite": ORACLES["dim_store"],
    "stored_replace_days": ORACLES["replace_date_range"],
    "stored_snapshot": ORACLES["replace_snapshot"],
    "stored_csv": ORACLES["dim_sku"],
    "stored_migration": f"""SELECT * REPLACE (CASE WHEN date_id >= {LO} THEN return_qty END AS return_qty,
        CASE WHEN date_id >= {LO} THEN return_amount END AS return_amount) FROM ({ORACLES["sales_daily"]})""",
    "stored_backfill": f"SELECT {FACT_DOUBLES} FROM dws_sales_range",
    "stored_run_all": ORACLES["sabc_grade"],
    "bucketed_sales": ORACLES["sales_daily"],
}


def oracle_sql() -> dict[str, str]:
    return {name: with_ctes(body) for name, body in ORACLES.items()}

"""Inter-store transfer reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline import rules as L
from shelfline.functions import count_when, money
from shelfline.operators.profile import (
    active, distribution, fill_rates, header_item_consistency, latest_rows, monthly, rate, scorecard, table_profile,
    with_share,
)
from shelfline.rules import RetailRules

SAMPLE_COLUMNS = (
    "id", "docno", "billdate", "transfertype", "orig_id", "dest_id", "tot_qty", "tot_qtyout", "tot_qtyin", "status",
    "confirm_status", "out_status", "in_status", "dateout", "datein", "isactive", "creationdate",
)
CLOUD_TYPE = "EOR"


def transfer_profile(transfer: DataFrame, transfer_item: DataFrame) -> DataFrame:
    return table_profile({"M_TRANSFER": transfer, "M_TRANSFERITEM": transfer_item})


def transfer_sample(transfer: DataFrame, limit: int = 10) -> DataFrame:
    return latest_rows(transfer, SAMPLE_COLUMNS, limit)


def transfer_by_type(transfer: DataFrame) -> DataFrame:
    sums = {"total_qty": "tot_qty", "total_out": "tot_qtyout", "total_in": "tot_qtyin"}
    return distribution(active(transfer), "transfertype", L.TRANSFER_TYPES, L.OTHER, sums).orderBy(
        F.col("cnt").desc(), F.col("transfertype").asc_nulls_last()
    )


def _state(transfer: DataFrame, column: str, labels: dict) -> DataFrame:
    return distribution(active(transfer), column, labels, L.OTHER).orderBy(F.col(column).asc_nulls_last())


def transfer_status(transfer: DataFrame) -> DataFrame:
    return _state(transfer, "status", L.SUBMIT_STATES)


def transfer_confirm(transfer: DataFrame) -> DataFrame:
    return _state(transfer, "confirm_status", L.CONFIRM_STATES)


def transfer_out(transfer: DataFrame) -> DataFrame:
    return _state(transfer, "out_status", L.OUTBOUND_STATES)


def transfer_in(transfer: DataFrame) -> DataFrame:
    return _state(transfer, "in_status", L.INBOUND_STATES)


def _top_end(transfer: DataFrame, store: DataFrame, end: str, moved: str, limit: int) -> DataFrame:
    """Top stores at one end. Documents are totalled per store id before names are joined, so a hot store costs nothing;
    the second aggregation merges ids that share code and name, and the unknown ones."""
    per_store = (
        active(transfer)
        .groupBy(F.col(end).alias("store_id"))
        .agg(F.count("id").alias("documents"), F.sum("tot_qty").alias("total_qty"), F.sum(moved).alias("moved_qty"))
    )
    names = store.select(
        F.col("id").alias("store_id"), F.col("code").alias("store_code"), F.col("name").alias("store_name")
    )
    return (
        per_store.join(names, "store_id", "left")
        .groupBy("store_code", "store_name")
        .agg(
            F.sum("documents").alias("documents"),
            F.sum("total_qty").alias("total_qty"),
            F.sum("moved_qty").alias("moved_qty"),
        )
        .orderBy(F.col("documents").desc(), F.col("store_code").asc_nulls_last())
        .limit(limit)
    )


def transfer_top_origin(transfer: DataFrame, store: DataFrame, limit: int = 10) -> DataFrame:
    return _top_end(transfer, store, "orig_id", "tot_qtyout", limit)


def transfer_top_dest(transfer: DataFrame, store: DataFrame, limit: int = 10) -> DataFrame:
    return _top_end(transfer, store, "dest_id", "tot_qtyin", limit)


def _with_both_ends(transfer: DataFrame, store: DataFrame, columns: list[str]) -> DataFrame:
    out = transfer
    for end in ("orig", "dest"):
        names = store.select(F.col("id").alias(f"{end}_id"), *[F.col(c).alias(f"{end}_{c}") for c in columns])
        out = out.join(names, f"{end}_id", "left")
    return out


def _flows(transfer: DataFrame, store: DataFrame, attribute: str, keys: dict[str, Column]) -> DataFrame:
    """Documents and quantity per class of origin and destination, totalled per pair of store ids before the joins."""
    pairs = (
        active(transfer)
        .groupBy("orig_id", "dest_id")
        .agg(F.count("id").alias("documents"), F.sum("tot_qty").alias("total_qty"))
    )
    grouped = (
        _with_both_ends(pairs, store, [attribute])
        .groupBy(*[column.alias(name) for name, column in keys.items()])
        .agg(F.sum("documents").alias("documents"), F.sum("total_qty").alias("total_qty"))
    )
    return with_share(grouped, "documents").orderBy(F.col("documents").desc(), *keys)


def store_class(code: Column, rules: RetailRules = RetailRules()) -> Column:
    return (
        F.when(code == rules.main_warehouse, L.FLOW_MAIN)
        .when(code.startswith(rules.ecommerce_prefix), L.FLOW_ECOMMERCE)
        .when(code.startswith(rules.shop_prefix), L.FLOW_SHOP)
        .otherwise(L.OTHER)
    )


def transfer_flow(transfer: DataFrame, store: DataFrame, rules: RetailRules = RetailRules()) -> DataFrame:
    return _flows(
        transfer, store, "code",
        {"origin_class": store_class(F.col("orig_code"), rules), "dest_class": store_class(F.col("dest_code"), rules)},
    )


def transfer_cloud_direction(transfer: DataFrame, store: DataFrame) -> DataFrame:
    from_cloud, to_cloud = F.col("orig_is_cloud") == "Y", F.col("dest_is_cloud") == "Y"
    direction = (
        F.when(from_cloud & to_cloud, L.CLOUD_TO_CLOUD)
        .when(from_cloud, L.CLOUD_TO_OTHER)
        .when(to_cloud, L.OTHER_TO_CLOUD)
        .otherwise(L.OTHER_TO_OTHER)
    )
    return _flows(transfer, store, "is_cloud", {"direction": direction})


def transfer_date_fill(transfer: DataFrame) -> DataFrame:
    return fill_rates(active(transfer), ["billdate", "dateout", "datein"])


def transfer_qty_compare(transfer: DataFrame) -> DataFrame:
    planned, out, received = F.col("tot_qty"), F.col("tot_qtyout"), F.col("tot_qtyin")
    return active(transfer).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.sum(planned).alias("total_qty"),
        F.sum(out).alias("total_out"),
        F.sum(received).alias("total_in"),
        count_when((planned == out) & (out == received)).alias("all_equal"),
        count_when((planned > 0) & (out == 0)).alias("not_sent"),
        count_when((out > 0) & (received == 0)).alias("sent_not_received"),
        count_when((received > 0) & (received < out)).alias("partly_received"),
        count_when((received != out) & (received > 0) & (out > 0)).alias("sent_received_differ"),
    )


def transfer_consistency(transfer: DataFrame, transfer_item: DataFrame) -> DataFrame:
    return header_item_consistency(transfer, transfer_item, "tot_qty", "transfer_id", "qty")


def _totals() -> dict[str, Column]:
    return {
        "documents": F.count(F.lit(1)),
        "total_qty": F.sum("tot_qty"),
        "total_out": F.sum("tot_qtyout"),
        "total_in": F.sum("tot_qtyin"),
        "total_amount": F.sum("tot_amtqty_list"),
    }


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("total_amount", F.round("total_amount", 2).cast("decimal(20,2)"))


def transfer_monthly(transfer: DataFrame, months: int = 12) -> DataFrame:
    return _rounded(monthly(active(transfer), "billdate", _totals(), months))


def transfer_cloud(transfer: DataFrame) -> DataFrame:
    cloud = active(transfer).filter(F.col("transfertype") == CLOUD_TYPE)
    return _rounded(cloud.agg(*[total.alias(name) for name, total in _totals().items()]))


def transfer_scorecard(transfer: DataFrame) -> DataFrame:
    """Is the transfer table fit to be a fact? One scan."""
    one = active(transfer).agg(
        F.count(F.lit(1)).alias("n"),
        F.count("orig_id").alias("n_orig"),
        F.count("dest_id").alias("n_dest"),
        F.count("billdate").alias("n_billdate"),
        count_when(F.col("out_status") == 2).alias("n_out"),
        count_when(F.col("in_status") == 2).alias("n_in"),
        F.sum("tot_qty").alias("q_planned"),
        F.sum("tot_qtyout").alias("q_out"),
        F.sum("tot_qtyin").alias("q_in"),
        F.count_distinct("transfertype").alias("n_types"),
    )
    c = F.col
    ends = (rate(c("n_orig"), c("n")) >= 95) & (rate(c("n_dest"), c("n")) >= 95)
    both = F.when(ends, "PASS").otherwise("WARNING")
    passed = F.lit("PASS")
    return scorecard(
        one,
        [
            ("origin", c("n_orig"), c("n"), both),
            ("destination", c("n_dest"), c("n"), both),
            ("bill_date", c("n_billdate"), c("n"), passed),
            ("sent", c("n_out"), c("n"), passed),
            ("received", c("n_in"), c("n"), passed),
            ("planned_qty", c("q_planned"), None, passed),
            ("sent_qty", c("q_out"), None, passed),
            ("received_qty", c("q_in"), None, passed),
            ("transfer_types", c("n_types"), None, passed),
        ],
    )


def transfer_completed(transfer: DataFrame, store: DataFrame) -> DataFrame:
    """Completed transfers (sent and received) with the names of both ends."""
    done = active(transfer).filter((F.col("out_status") == 2) & (F.col("in_status") == 2))
    return _with_both_ends(done, store, ["code", "name"]).select(
        "id", "docno", "billdate", "transfertype", "orig_id", "orig_code", "orig_name", "dest_id", "dest_code",
        "dest_name", "tot_qty", "tot_qtyout", "tot_qtyin",
    )

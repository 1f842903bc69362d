from __future__ import annotations

import os
from datetime import date
from decimal import Decimal

import pytest
from conftest import values
from pyspark.sql import functions as F

from shelfline_checks.adapter import AS_OF, Sources
from shelfline_checks.queries import Warehouse
from shelfline.operators.reports import daily_report, sales_summary
from shelfline.plans.conf import recommended_conf
from shelfline.operators.facts import day_prints, sales_daily
from shelfline.plans import warehouse
from shelfline.plans.refresh import changed_days, day_runs
from shelfline.plans.warehouse import backfill, build_all, reload_changed, run_all, run_reports
from shelfline.schema import align_schema, table_schema
from shelfline.sources import readers, sinks

DAYS = "date_id int, v int"
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def table(tmp_path):
    return str(tmp_path / "facts")


def test_replace_days(spark, frame, table):
    assert sinks.replace_days(frame([(d, 1) for d in (20260101, 20260102, 20260103, 20260104)], DAYS), table, 20260101, 20260104) == 4
    new = frame([(20260102, 2), (20260102, 3), (20260104, 9)], DAYS)
    expected = {(20260101, 1), (20260102, 2), (20260102, 3), (20260104, 1)}
    for _ in range(2):  # running it again changes nothing
        assert sinks.replace_days(new, table, 20260102, 20260103) == 2
        got = spark.read.parquet(table)
        assert values(got, "date_id", "v") == expected and got.count() == 4
    assert not os.path.exists(f"{table}/date_id=20260103")


def test_replace_days_with_nothing_new(spark, frame, table):
    sinks.replace_days(frame([(20260101, 1), (20260102, 1)], DAYS), table, 20260101, 20260102)
    nothing = frame([], DAYS)
    assert sinks.replace_days(nothing, table, 20260101, 20260102) == 0
    assert spark.read.parquet(table).count() == 2
    sinks.replace_days(nothing, table, 20260102, 20260102, on_empty="clear")
    assert values(spark.read.parquet(table), "date_id") == {(20260101,)}
    with pytest.raises(ValueError):
        sinks.replace_days(nothing, table, 1, 2, on_empty="other")


def test_replace_snapshot_by_date(spark, frame, table):
    ddl = "snapshot_date date, v int"
    sinks.replace_snapshot(frame([(date(2026, 1, 1), 1)], ddl), table, date(2026, 1, 1), "snapshot_date")
    sinks.replace_snapshot(frame([(date(2026, 1, 2), 2)], ddl), table, date(2026, 1, 2), "snapshot_date")
    sinks.replace_snapshot(frame([(date(2026, 1, 2), 5)], ddl), table, date(2026, 1, 2), "snapshot_date")
    assert values(spark.read.parquet(table), "snapshot_date", "v") == {(date(2026, 1, 1), 1), (date(2026, 1, 2), 5)}


def test_overwrite_changes_the_schema(spark, frame, table):
    sinks.overwrite_table(frame([(1, 1)], DAYS), table)
    sinks.overwrite_table(frame([("x",)], "name string"), table)
    assert spark.read.parquet(table).columns == ["name"]


def test_overwrite_may_keep_on_empty(spark, frame, table):
    assert sinks.overwrite_table(frame([(1, 1)], DAYS), table)
    assert not sinks.overwrite_table(frame([], DAYS), table, "keep") and spark.read.parquet(table).count() == 1
    assert sinks.overwrite_table(frame([], DAYS), table) and spark.read.parquet(table).count() == 0
    with pytest.raises(ValueError):
        sinks.overwrite_table(frame([], DAYS), table, "other")


def test_results_have_the_table_columns(spark):
    w = Warehouse(spark, FOLDER)
    results = {
        "dws_sales_daily": w.sales(), "dws_inventory_daily": w.inventory(), "ads_inventory_health": w.graded(),
        "dim_channel": w.dim_channel(), "dim_product_attr": w.dim_product_attr(), "dim_sku": w.dim_sku(),
        "ads_daily_report": daily_report(w.sales(), w.dim_channel(), w.orders()),
        "ads_sales_summary": sales_summary(w.sales(), w.dim_product(), w.dim_channel(), w.orders()),
    }
    for name, df in results.items():
        schema = table_schema(name)
        assert set(df.columns) == set(schema.fieldNames()), name
        assert align_schema(df, schema).columns == schema.fieldNames(), name


def test_stamps_only_in_sinks(frame):
    out = sinks.stamp(frame([(1, 1)], DAYS), "ads_inventory_health")
    assert out.columns == ["date_id", "v", "etl_time", "created_at"]
    assert sinks.stamp(out, "dim_product").columns == out.columns


def test_bucketed_tables_join_without_an_exchange(spark, frame, tmp_path):
    """Headers and lines in equal buckets: no exchange below the join, in this session or one that has to declare them again."""
    sources = Sources(spark, FOLDER)
    want = sales_daily(sources.retail(), sources.retail_item(), sources.store(), sources.product(), 19950101, 20010801)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        places = [(f"b_{n}", str(tmp_path / n), [k], 6) for n, k in (("header", "id"), ("line", "retail_id"))]
        for df, place in zip((sources.retail(), sources.retail_item()), places, strict=True):
            sinks.write_bucketed(df, *place)
            sinks.write_bucketed(df, *place)  # replaces, does not add
        for declared in (True, False):
            if not declared:
                for table, *_ in places:
                    spark.sql(f"DROP TABLE {table}")
            header, line = (readers.read_bucketed(spark, *place) for place in places)
            got = sales_daily(header, line, sources.store(), sources.product(), 19950101, 20010801)
            assert values(got) == values(want) and got.count() == want.count()
            joined = line.join(header.withColumnRenamed("id", "retail_id"), "retail_id")
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange" not in plan
            # Lines stay where they are. Headers move, as without broadcasts their store filter has dealt them out by store.
            moved = [df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(retail_id#") for df in (got, want)]
            assert moved[0] < moved[1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_export_csv(spark, frame, tmp_path):
    path = str(tmp_path / "out")
    df = frame([(1, "滞销"), (2, "a,b")], "id int, label string")
    sinks.export_csv(df, path, files=1)
    (part,) = [n for n in os.listdir(path) if n.endswith(".csv")]
    with open(os.path.join(path, part), "rb") as f:
        assert f.read().startswith(b"\xef\xbb\xbfid,label\n")
    assert spark.read.option("header", True).csv(path).count() == 2
    sinks.export_csv(df, path, bom=False)
    assert spark.read.option("header", True).csv(path).columns == ["id", "label"]


def test_jdbc_options():
    plain = readers.jdbc_options("jdbc:x", "(select 1) t", user="u", password="p")
    assert plain["dbtable"] == "(select 1) t" and "partitionColumn" not in plain and plain["user"] == "u"
    split = readers.jdbc_options("jdbc:x", "m_retail", partition_column="billdate", lower=20260101, upper=20260131, partitions=8)
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == (
        "billdate", "20260101", "20260131", "8",
    )
    with pytest.raises(ValueError):
        readers.jdbc_options("jdbc:x", "m_retail", partition_column="billdate")


def test_erp_names_and_empty_strings(frame):
    raw = frame([(1, "", 7), (2, "Y", None)], "ID bigint, IS_ALLO2OSTORAGE string, C_AREA_ID bigint")
    out = readers.from_erp(raw, "C_STORE")
    assert out.columns == ["id", "is_cloud", "area_id"] and values(out) == {(1, None, 7), (2, "Y", None)}


def test_read_parquet(spark, frame, tmp_path):
    frame([(1, 1)], DAYS).write.parquet(str(tmp_path / "a"))
    assert readers.read_parquet(spark, str(tmp_path), ["a"])["a"].count() == 1


def test_recommended_conf_scales_with_the_shuffle():
    assert recommended_conf(0, 64)["spark.sql.shuffle.partitions"] == "64"
    assert recommended_conf(100 * 10**12, 4000)["spark.sql.shuffle.partitions"] == "745059"


def test_run_all_equals_build_all(spark, tmp_path):
    t = Sources(spark, FOLDER).all_sources()
    lazy = build_all(t, AS_OF)
    stored = run_all(spark, t, str(tmp_path), AS_OF)
    assert set(lazy) == set(stored)
    for name, df in lazy.items():
        got = stored[name].select(*df.columns)
        assert values(got) == values(df), name
        assert got.count() == df.count(), name
    first = {n: values(df.drop("etl_time", "created_at", "updated_at")) for n, df in stored.items()}
    again = run_all(spark, t, str(tmp_path), AS_OF)  # a second run of the day replaces, it does not add
    assert {n: values(df.drop("etl_time", "created_at", "updated_at")) for n, df in again.items()} == first
    assert "etl_time" in again["ads_inventory_health"].columns
    earlier = run_all(spark, t, str(tmp_path), date(2001, 7, 31))
    assert values(earlier["ads_inventory_health"], "snapshot_date") == {(AS_OF,), (date(2001, 7, 31),)}


def test_refresh_takes_the_window_from_the_sources_once(spark, tmp_path, monkeypatch):
    """Sales and prints read the stored lines of the window; repeated, absent and unknown keys count as in the whole tables."""
    t = Sources(spark, FOLDER).all_sources()
    again = F.col("id") % 5 == 0
    odd = t["item"].limit(50).withColumn("retail_id", F.when(F.col("product_id") % 2 == 0, -1).cast("bigint"))
    t["retail"] = t["retail"].unionByName(t["retail"].filter(again))
    t["item"] = t["item"].unionByName(t["item"].filter(F.col("retail_id") % 3 == 0)).unionByName(odd)
    read = []
    for job in ("sales_daily", "day_prints"):
        real = getattr(warehouse, job)
        monkeypatch.setattr(
            warehouse, job, lambda retail, item, *rest, real=real: read.append(item.inputFiles()) or real(retail, item, *rest)
        )
    stored = run_all(spark, t, str(tmp_path), AS_OF)
    assert len(read) == 2 and all(files and all("/_window_item/" in f for f in files) for files in read)
    assert not [p.name for p in tmp_path.iterdir() if p.name.startswith("_")]
    want = sales_daily(t["retail"], t["item"], t["store"], t["product"], 20010702, AS_OF)
    got = stored["dws_sales_daily"].select(*want.columns)
    assert values(got) == values(want) and got.count() == want.count() > 0
    prints = spark.read.parquet(str(tmp_path / "dws_sales_prints"))
    now = day_prints(t["retail"], t["item"], t["store"], t["product"], 20010702, AS_OF)
    assert values(prints, *now.columns) == values(now)


def test_late_rows_are_loaded_by_range(spark, tmp_path):
    t = Sources(spark, FOLDER).all_sources()
    late = F.col("billdate").between(20010701, 20010703) & (F.col("id") % 2 == 0)
    root = str(tmp_path)
    run_all(spark, t | {"retail": t["retail"].filter(~late)}, root, AS_OF)
    before = values(spark.read.parquet(f"{root}/dws_sales_daily").select("date_id", "store_id", "m_productalias_id", "sales_qty", "return_qty"))
    assert backfill(t, root, 20010701, 20010703) >= 0
    after = values(spark.read.parquet(f"{root}/dws_sales_daily").select("date_id", "store_id", "m_productalias_id", "sales_qty", "return_qty"))
    want = sales_daily(t["retail"], t["item"], t["store"], t["product"], 20010702, AS_OF)
    inside = {r for r in after if r[0] >= 20010702}
    assert inside == values(want.select("date_id", "store_id", "m_productalias_id", "sales_qty", "return_qty"))
    assert {r for r in before if r[0] > 20010703} == {r for r in after if r[0] > 20010703}


def test_one_changed_line_reloads_its_day_only(spark, tmp_path):
    t = Sources(spark, FOLDER).all_sources()
    root, lo, hi = str(tmp_path), 20010702, 20010801
    first = reload_changed(spark, t, root, lo, hi)
    facts = values(spark.read.parquet(f"{root}/dws_sales_daily").select("date_id", "m_productalias_id", "sales_amount"))
    assert set(first) == {r[0] for r in facts} and reload_changed(spark, t, root, lo, hi) == []
    headers = t["retail"].filter(F.col("billdate").between(lo, hi) & (F.col("status") == 2) & (F.col("isactive") == "Y"))
    known = sales_daily(headers, t["item"], t["store"], t["product"], lo, hi).filter("sales_amount > 0").select("date_id", "m_productalias_id").first()
    retail_id = headers.filter((F.col("billdate") == known.date_id) & (F.col("tot_amt_actual") > 0)).select("id")
    line = (F.col("sku_id") == known.m_productalias_id) & F.col("retail_id").isin([r[0] for r in retail_id.collect()])
    dearer = t["item"].withColumn("tot_amt_actual", F.when(line, F.col("tot_amt_actual") + 1).otherwise(F.col("tot_amt_actual")).cast("decimal(14,2)"))
    changed = t | {"item": dearer}
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "dws_sales_daily").rglob("*.parquet")}
    assert reload_changed(spark, changed, root, lo, hi) == [known.date_id]
    after = {f: f.stat().st_mtime_ns for f in (tmp_path / "dws_sales_daily").rglob("*.parquet")}
    assert {f.parent.name for f in set(before.items()) ^ set(after.items()) for f in [f[0]]} == {f"date_id={known.date_id}"}
    want = sales_daily(t["retail"], dearer, t["store"], t["product"], lo, hi)
    got = spark.read.parquet(f"{root}/dws_sales_daily").select(*want.columns)
    assert values(got) == values(want) and reload_changed(spark, changed, root, lo, hi) == []


def test_changed_days(frame):
    ddl = "date_id int, source_lines bigint, print decimal(38,0)"
    seven, eight = Decimal(7), Decimal(8)
    old = frame([(1, 3, seven), (2, 3, seven), (3, 3, seven), (4, 1, None)], ddl)
    new = frame([(1, 3, seven), (2, 3, eight), (4, 1, None), (5, 2, eight)], ddl)
    assert values(changed_days(old, new)) == {(2, 3, 3), (3, 3, 0), (5, 0, 2)}
    assert values(changed_days(old.limit(0), new.limit(0))) == set()
    assert day_runs([20260301, 20260228, 20260305, 20260227]) == [(20260227, 20260301), (20260305, 20260305)] and day_runs([]) == []


def test_build_all_starts_no_job(spark):
    t = Sources(spark, FOLDER).all_sources()
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    build_all(t, AS_OF)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before


def test_old_tables_gain_columns(spark, tmp_path):
    t = Sources(spark, FOLDER).all_sources()
    root = str(tmp_path)
    run_all(spark, t, root, date(2001, 7, 31))
    old = spark.read.parquet(f"{root}/ads_inventory_health")
    kept = old.drop("sales_trend")
    spark.createDataFrame(kept.collect(), kept.schema).write.mode("overwrite").partitionBy("snapshot_date").parquet(f"{root}/ads_inventory_health")
    now = run_all(spark, t, root, AS_OF)["ads_inventory_health"]
    assert values(now.filter("sales_trend IS NULL"), "snapshot_date") == {(date(2001, 7, 31),)}
    assert now.filter("sales_trend IS NOT NULL").count() > 0
    t["channel_map"] = Sources(spark, FOLDER).channel_map()
    reports = run_reports(spark, t, root, 20010702, AS_OF)
    assert set(reports) == {"dim_date", "dim_category", "dim_channel", "ads_daily_report", "ads_sales_summary"}
    assert reports["dim_date"].count() == 31


def test_health_reads_pruned_days(spark, tmp_path):
    """The stored facts are read by day partition."""
    path = str(tmp_path / "dws")
    spark.range(10).select((F.col("id") + 20260101).cast("int").alias("date_id"), F.col("id")).write.partitionBy("date_id").parquet(path)
    df = spark.read.parquet(path).filter(F.col("date_id").between(20260103, 20260104))
    assert len(df.inputFiles()) >= 2 and "PartitionFilters: [isnotnull(date_id" in df._jdf.queryExecution().toString()

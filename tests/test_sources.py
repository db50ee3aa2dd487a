import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from rootlens.sources import csv_tables, flat_file, sinks, versions


def write(base, name, content):
    path = f"{base}/{name}"
    with open(path, "wb") as out:
        out.write(content if isinstance(content, bytes) else content.encode())
    return path


def test_typed_load(spark, rows, base):
    text = (
        "﻿id,WRONG,x,t1,t2,t3,t4,t5\n"
        f'{"k" * 60},c1,"  ",2024-01-02 03:04:05,,1/3/2024,2024/01/04 05:06:07,\n'
        'o2,"a ""b"", c",NA,2024-01-02,,,,\n'
    )
    path = write(base, "orders.csv", text)
    found = rows(csv_tables.read_csv_table(spark, path, csv_tables.RAW_TABLES["orders"]), "order_id")
    assert found[0]["order_id"] == "k" * 50 and found[0]["order_status"] is None
    assert found[0]["order_purchase_timestamp"] == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert found[0]["order_delivered_carrier_date"] == dt.datetime(2024, 1, 3)
    assert found[0]["order_approved_at"] is None
    assert (found[1]["customer_id"], found[1]["order_status"]) == ('a "b", c', "NA")


@pytest.mark.parametrize("line", ["o1,1,p,s,soon,1.00,2.00", "o1,one,p,s,,1.00,2.00"])
def test_unreadable_values_fail_the_load(spark, base, line):
    path = write(base, "items.csv", f"a,b,c,d,e,f,g\n{line}\n")
    with pytest.raises(Exception, match="not a timestamp|CAST_INVALID_INPUT"):
        csv_tables.read_csv_table(spark, path, csv_tables.RAW_TABLES["order_items"]).collect()


def test_catalogue_load_is_a_full_refresh_and_verifies(spark, rows, base):
    tables = {"sellers": csv_tables.RAW_TABLES["sellers"]}
    path = write(base, "sellers.csv", "a,b,c,d\ns1,1,x,SP\ns2,2,y,RJ\n")
    for _ in range(2):
        loaded = csv_tables.load_catalogue(spark, {"sellers": path}, f"{base}/raw", tables)
    assert loaded["sellers"].count() == 2
    expected = spark.createDataFrame([("sellers", 3), ("ghost", 1)], "table string, loaded bigint")
    checks = {r["table"]: r["matches"] for r in rows(csv_tables.verify_loads(loaded, expected))}
    assert checks == {"sellers": False, "ghost": False}
    good = spark.createDataFrame([("sellers", 2)], "table string, loaded bigint")
    assert rows(csv_tables.verify_loads(loaded, good))[0]["matches"]


def test_flat_file_keeps_na_and_reads_utf8(spark, rows, base):
    path = write(base, "u.csv", "region,n,city\nNA,1,Köln\n,2,N/A\n")
    found = rows(flat_file.read_flat_file(spark, path), "n")
    assert [(r["region"], r["city"]) for r in found] == [("NA", "Köln"), (None, "N/A")]


@pytest.mark.parametrize("line", ["a,1,EXTRA", "b"])
def test_lines_with_the_wrong_number_of_fields_stop_the_load(spark, base, line):
    path = write(base, "m.csv", f"k,n\nx,1\n{line}\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        flat_file.read_flat_file(spark, path).select("k").collect()
    columns = [("k", "varchar(5)"), ("n", "varchar(5)")]
    with pytest.raises(Exception, match="(?i)malformed"):
        csv_tables.read_csv_table(spark, path, columns).select("k").collect()


@pytest.mark.parametrize("encoding", ["utf-8", "cp1252"])
def test_line_breaks_inside_quotes(spark, rows, base, encoding):
    path = write(base, "q.csv", 'a,b,c\n1,"line one\nliné two",5\n'.encode(encoding))
    assert rows(flat_file.read_flat_file(spark, path)) == [{"a": 1, "b": "line one\nliné two", "c": 5}]


def test_flat_file_falls_back_to_cp1252(spark, rows, base):
    path = write(base, "w.csv", "naïve – name,n\n€5 “café”,1\n".encode("cp1252"))
    assert not flat_file.is_utf8(spark, path)
    found = rows(flat_file.read_flat_file(spark, path))[0]
    assert found == {"naïve – name": "€5 “café”", "n": 1}


def test_tables_views_and_listing(spark, rows, base):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, part string")
    again = sinks.replace_table(df, base, "t", partition_by="part")
    assert rows(sinks.replace_table(again.filter("n = 1"), base, "u")) == [{"n": 1, "part": "a"}]
    sinks.register_views({"v_test": df})
    assert spark.table("v_test").count() == 2
    spark.sql(f"CREATE DATABASE list_test LOCATION '{base}/db'")
    for name in ("zeta", "alpha"):
        sinks.save_as_table(df, f"list_test.{name}")
        sinks.save_as_table(df, f"list_test.{name}")
    assert [r["table_name"] for r in rows(csv_tables.list_tables(spark, "list_test"))] == ["alpha", "zeta"]
    spark.sql("DROP DATABASE list_test CASCADE")


def test_alert_and_metric_sinks(spark, rows, base):
    alerts = spark.createDataFrame([("s", "sent"), ("t", "dry_run")], "subject string, alert_status string")
    for run_id in ("first", "first", "second"):
        sinks.append_alerts(alerts, base, run_id)
    assert [r["run_id"] for r in rows(spark.read.parquet(f"{base}/alerts"), "run_id")] == ["first", "second"]
    report = spark.createDataFrame(
        [("m", "completed", 3, "sent"), ("f", "failed", None, "skipped")],
        "metric string, status string, anomaly_count bigint, alert_status string",
    )
    for _ in range(2):
        sinks.append_run_metrics(report, base, "first")
    found = spark.read.parquet(f"{base}/run_metrics")
    values = {(r["metric"], r["metric_name"]): r["value"] for r in rows(found)}
    assert [values["m", k] for k in ("PipelineExecutionSuccess", "AnomaliesDetected", "AlertsSent")] == [1, 3, 1]
    assert [values["f", k] for k in ("PipelineExecutionSuccess", "AnomaliesDetected", "AlertsSent")] == [0, 0, 0]
    assert "run_ts" in found.columns and found.count() == 6


def failing(df):
    """Fails while it is written."""
    return df.withColumn("n", F.when(F.col("n") < 0, 0).otherwise(F.raise_error(F.lit("broken"))))


def test_a_failed_write_leaves_the_old_table(spark, rows, base):
    df = spark.createDataFrame([(1,), (2,)], "n int")
    sinks.replace_table(df, base, "t")
    with pytest.raises(Exception, match="broken"):
        sinks.replace_table(failing(df), base, "t")
    assert rows(sinks.read_table(spark, base, "t"), "n") == [{"n": 1}, {"n": 2}]
    assert len(os.listdir(f"{base}/t")) == len([v for v in os.listdir(f"{base}/t") if v.startswith((".", "_"))]) + 1
    with pytest.raises(FileNotFoundError):
        sinks.read_table(spark, base, "none")


def test_no_table_changes_unless_all_were_written(spark, rows, base):
    one, two = (spark.createDataFrame([(i,)], "n int") for i in (1, 2))
    sinks.replace_tables({"a": one, "b": one}, base)
    with pytest.raises(Exception, match="broken"):
        sinks.replace_tables({"a": two, "b": failing(two)}, base)
    assert [rows(sinks.read_table(spark, base, t)) for t in "ab"] == [[{"n": 1}]] * 2
    sinks.replace_tables({"a": two, "b": two}, base)
    assert [rows(sinks.read_table(spark, base, t)) for t in "ab"] == [[{"n": 2}]] * 2


def test_readers_of_the_version_before_go_on(spark, rows, base):
    frames = [sinks.replace_table(spark.createDataFrame([(i,)], "n int"), base, "t") for i in range(4)]
    assert rows(frames[2]) == [{"n": 2}] and rows(frames[3]) == [{"n": 3}]
    assert len(versions.versions_of(spark, f"{base}/t")) == 2
    assert len([v for v in os.listdir(f"{base}/t") if v.startswith("v-")]) == 2


def test_a_catalogue_table_survives_a_failed_save_and_takes_new_columns(spark, rows, base):
    spark.sql(f"CREATE DATABASE save_test LOCATION '{base}/db'")
    df = spark.createDataFrame([(1,)], "n int")
    sinks.save_as_table(df, "save_test.t")
    with pytest.raises(Exception, match="broken"):
        sinks.save_as_table(failing(df), "save_test.t")
    assert rows(spark.table("save_test.t")) == [{"n": 1}]
    sinks.save_as_table(spark.createDataFrame([(2,)], "n int"), "save_test.t")
    assert rows(spark.table("save_test.t")) == [{"n": 2}]
    sinks.save_as_table(spark.createDataFrame([(3, "x")], "n int, v string"), "save_test.t")
    assert rows(spark.table("save_test.t")) == [{"n": 3, "v": "x"}]
    spark.sql("DROP DATABASE save_test CASCADE")


@pytest.mark.parametrize("text, width, kept", [("abc", 2, "ab"), ("aé", 2, "a"), ("aé", 3, "aé"), ("日本語", 7, "日本"), ("😀x", 3, ""), ("😀x", 4, "😀"), ("é", 1, ""), (None, 3, None)])
def test_widths_count_bytes(spark, text, width, kept):
    df = spark.createDataFrame([(text,)], "v string").select(csv_tables.cut_bytes(F.col("v"), width).alias("v"))
    assert df.first()["v"] == kept

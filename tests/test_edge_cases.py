"""Cases in which rows could be lost, doubled or misread without any error."""

import os
import time
import zipfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.functions.ordering import hwm_filter
from millrace.operators.dedup import latest_per_key
from millrace.operators.joins import asof_join
from millrace.operators.tables import bucket_count, merge_buckets, rebucket, write_buckets, write_csv
from millrace.plans import load, reports
from millrace.plans.state import LoadState
from millrace.sources import files, jdbc, landing, synth, workbook
from millrace.streaming import ingest


def test_a_late_file_with_an_old_date_is_loaded(spark, tmp_path):
    (tmp_path / "in").mkdir()
    raw = str(tmp_path / "raw")

    def go():
        ingest.auto_ingest(spark, str(tmp_path / "in"), "*.csv", lambda s, p: landing.patients_from_csv(s, p, F.lit("2024-01-01").cast("timestamp_ntz")),
                           raw, str(tmp_path / "ck")).awaitTermination()
        return {r["patient_id"] for r in spark.read.parquet(raw).collect()}

    (tmp_path / "in" / "a.csv").write_text("patient_id\nP1\n")
    assert go() == {"P1"}
    late = tmp_path / "in" / "b.csv"
    late.write_text("patient_id\nP2\n")
    os.utime(late, (time.time() - 400 * 86400,) * 2)
    assert go() == {"P1", "P2"}


@pytest.mark.parametrize("many", [False, True])
def test_empty_versions_are_never_valid(spark, many):
    facts = spark.createDataFrame([(1, "k", 10), (2, "k", 20), (3, "k", 5)], "id int, k string, t int")
    versions = [("k", 0, 10, 1), ("k", 10, 10, 2), ("k", 10, None, 3), ("k", 10, 10, 4)]
    for rows in (versions, versions[::-1]):
        dim = spark.createDataFrame(rows, "k string, valid_from int, valid_to int, sk int")
        got = {r["id"]: r["sk"] for r in asof_join(facts, dim, "k", "t", payload=["sk"], many_versions=many).collect()}
        assert got == {1: 3, 2: 3, 3: 1}


def test_marks_beyond_doubles_keep_their_digits(spark):
    rows = ["9007199254740991", "9007199254740993", "9007199254740992", "10.0", "1e30", "2e30", "-1e30", "x", None]
    df = spark.createDataFrame([(v,) for v in rows], "m string")
    assert {r["m"] for r in hwm_filter(df, "m", "9007199254740992", True).collect()} == {"9007199254740993", "1e30", "2e30", "x"}
    assert {r["m"] for r in hwm_filter(df, "m", "1e30", True).collect()} == {"2e30", "x"}
    assert hwm_filter(df, "m", "10", True).filter("m = '10.0'").isEmpty()


def test_rows_without_a_key_stay(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), ("a", 1), ("a", 2)], "k string, t int")
    assert sorted(map(tuple, latest_per_key(df, ["k"], "t", null_is_key=False).collect()), key=repr) == [("a", 2), (None, 1), (None, 1)]


def test_roll_ups_add_up_to_the_fact(spark):
    fact = spark.createDataFrame(
        [(1, 1, "paid", 20240101, 1, "a", 5, "1.00", "1.00"), (None, 9, None, 19000101, None, "b", 6, "2.00", "0.00")],
        "provider_sk int, facility_sk int, claim_status string, date_key int, payer_sk int, encounter_class string, duration_minutes int, total_charge string, paid_amount string",
    ).withColumns({c: F.col(c).cast("decimal(12,2)") for c in ("total_charge", "paid_amount")})
    one = spark.createDataFrame([(1,)], "x int").select(
        F.lit(1).alias("provider_sk"), F.lit("P").alias("provider_name"), F.lit(1).alias("facility_sk"), F.lit(1).alias("location_sk"), F.lit("R").alias("region"),
        F.lit(20240101).alias("date_key"), F.lit(2024).alias("year"), F.lit(1).alias("month"), F.lit("January").alias("month_name"), F.lit(1).alias("payer_sk"), F.lit("Y").alias("payer_name"))
    found = [
        reports.provider_rollup(fact, one.select("provider_sk", "provider_name")), reports.monthly_trend(fact, one),
        reports.region_class_rollup(fact, one, one.select("location_sk", "region")), reports.payer_rollup(fact, one.select("payer_sk", "payer_name")),
    ]
    for rollup in found:
        assert rollup.agg(F.sum("encounters")).first()[0] == 2 and rollup.count() == 2


def test_the_bucket_number_stays_with_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    write_buckets(spark.range(200), path, ["id"], 64)
    assert bucket_count(spark, path) == 64
    with pytest.raises(ValueError):
        merge_buckets(spark, path, spark.range(50), ["id"], 16, lambda held, delta: held.union(delta).distinct(), "b1")
    rebucket(spark, path, ["id"], 16)
    merge_buckets(spark, path, spark.range(50), ["id"], 16, lambda held, delta: held.union(delta).distinct(), "b1")
    table = spark.read.parquet(path)
    assert table.count() == 200 and table.select("id").distinct().count() == 200


def test_long_ids_are_not_cut(spark):
    wide = spark.range(2).select((F.col("id") + 1234567890123).alias("id"))
    assert {r["patient_id"] for r in synth.synth_patients(wide).collect()} == {"PAT-1234567890123", "PAT-1234567890124"}


def test_csv_round_trip(spark, tmp_path):
    rows = [("1", 'say "hi", x'), ("2", "a,b\\"), ("3", "two\nlines"), ("4", '"'), ("5", "\\\"x")]
    path = str(tmp_path / "out")
    write_csv(spark.createDataFrame(rows, "id string, note string").coalesce(1), path)
    names = [str(p) for p in (tmp_path / "out").glob("*.csv")]
    by_name = files.read_csv_by_name(spark, names, ["note", "id"], multi_line=True).select("id", "note")
    assert sorted(map(tuple, by_name.collect())) == rows
    assert sorted(map(tuple, files.read_csv_incremental(spark, path, "id", "1", multi_line=True).collect())) == rows[1:]


def test_text_ranges_hold_under_a_collation_that_ignores_case(spark):
    values = ["apple", "Banana", "cherry", "Zoo", "zebra", "", None]
    spark.createDataFrame([(v,) for v in values], "k string").selectExpr("k COLLATE UTF8_LCASE AS k").createOrReplaceTempView("blind")
    parts = jdbc.text_ranges("k", ["Banana", "Zoo", "apple"])
    hits = [r[0] for p in parts for r in spark.sql(f"SELECT k FROM blind WHERE {p}").collect()]
    assert sorted(hits, key=repr) == sorted(values, key=repr)


def test_connection_settings(tmp_path, monkeypatch):
    monkeypatch.setenv("DB_SECRET", "s3")
    o = jdbc.jdbc_options("postgres", {"dbname": "d", "host": "h", "user": "u", "password_env": "DB_SECRET"})
    assert o["url"] == "jdbc:postgresql://h:5432/d" and o["password"] == "s3"
    with pytest.raises(ValueError):
        jdbc.jdbc_options("postgres", {"dbname": "d", "password_env": "NOT_THERE_AT_ALL"})
    assert jdbc.jdbc_url("postgres", {"dsn": "postgresql://h/d"}) == "jdbc:postgresql://h/d"
    assert jdbc.jdbc_url("sqlserver", {"conn_str": "h:1433;databaseName=d"}) == "jdbc:sqlserver://h:1433;databaseName=d"
    with pytest.raises(FileNotFoundError):
        jdbc.jdbc_options("sqlite", {"path": str(tmp_path / "none.db")})
    assert jdbc.oracle_since("T", "TS", datetime(2024, 1, 2, 3, 4, 5)) == (
        "(SELECT * FROM T WHERE TS > TO_TIMESTAMP('2024-01-02 03:04:05', 'YYYY-MM-DD HH24:MI:SS')) pending")


def test_a_failing_table_leaves_the_others_logged(spark, tmp_path):
    (tmp_path / "in.csv").write_text("id,v\n1,a\n2,b\n")
    source = {"type": "csv", "path": str(tmp_path / "in.csv")}
    tables = [load.TableLoad("a", "id"), load.TableLoad("zz", "missing")]
    with pytest.raises(ValueError):
        load.load_all(spark, source, tables, LoadState(spark, str(tmp_path / "s")), str(tmp_path / "land"), str(tmp_path / "log"))
    assert [(r["target"], r["rows_written"]) for r in spark.read.parquet(str(tmp_path / "log")).collect()] == [("a", 2)]


def test_workbook_dates_and_booleans(tmp_path):
    main = workbook._MAIN[1:-1]
    plain = tmp_path / "p.xlsx"
    plain.write_bytes(workbook.workbook_bytes(["d", "b", "n"], [], "s"))
    made = tmp_path / "m.xlsx"
    cells = '<row><c s="1"><v>45292.5</v></c><c t="b"><v>1</v></c><c s="2"><v>45292</v></c><c s="3"><v>45292</v></c></row>'
    styles = (f'<styleSheet xmlns="{main}"><numFmts><numFmt numFmtId="170" formatCode="yyyy\\-mm\\-dd"/><numFmt numFmtId="171" formatCode="0.0&quot; days&quot;"/></numFmts>'
              '<cellXfs><xf numFmtId="0"/><xf numFmtId="22"/><xf numFmtId="171"/><xf numFmtId="170"/></cellXfs></styleSheet>')
    with zipfile.ZipFile(plain) as old, zipfile.ZipFile(made, "w") as new:
        for name in old.namelist():
            data = old.read(name)
            new.writestr(name, data.replace(b"</sheetData>", cells.encode() + b"</sheetData>") if "sheet1" in name else data)
        new.writestr("xl/styles.xml", styles)
    rows = list(workbook.sheet_rows(made.read_bytes(), "s"))
    assert rows[1] == ["2024-01-01 12:00:00", "True", "45292", "2024-01-01 00:00:00"]


def test_a_step_leaves_no_scratch_behind(spark):
    from millrace.session import in_parallel, materialize, scratch_path, scratch_scope

    outside = materialize(spark.range(3), "kept")
    with scratch_scope(spark):
        inner = in_parallel(spark, lambda: materialize(spark.range(2), "gone"), lambda: scratch_path(spark, "gone"))
        assert inner[0].count() == 2
        left = inner[0].inputFiles()[0].replace("file://", "")
        assert os.path.exists(left) and "/step-" in inner[1]
    assert not os.path.exists(left) and outside.count() == 3 and "/step-" not in scratch_path(spark, "x")

import json
import random

import pytest
from pyspark.sql import types as T

from millrace.operators import tables
from millrace.plans import load
from millrace.sources import files, jdbc, landing, registry, workbook

CONTRACT = [(11, "plum", 105), (12, "fig", 117), (15, "date", 130), (19, "lime", 142)]


def test_unknown_type_and_bad_names(spark):
    with pytest.raises(ValueError):
        registry.read_source(spark, {"type": "carrier_pigeon"}, "t", "id")
    with pytest.raises(ValueError):
        registry.read_source(spark, {"type": "csv", "root": "/tmp"}, "patients; DROP TABLE x", "id")


def test_parquet_unsorted(spark, tmp_path, rows):
    spark.createDataFrame(CONTRACT[::-1], "id bigint, name string, ts bigint").write.parquet(str(tmp_path / "t.parquet"))
    src = {"type": "parquet", "root": str(tmp_path)}
    assert rows(registry.read_source(spark, src, "t", "ts")) == CONTRACT
    late = registry.read_source(spark, src, "t", "ts", 117)
    assert rows(late, "id") == [(15,), (19,)] and registry.pending_count(registry.read_source(spark, src, "t", "ts"), "ts", 117) == 2
    with pytest.raises(ValueError):
        registry.read_source(spark, src, "t", "nope", 20)


def test_csv_count_equals_fetch(spark, tmp_path):
    (tmp_path / "t.csv").write_text("patient_id,name\n" + "".join(f"PAT-{i:03d},n{i}\n" for i in range(1, 8)))
    src = {"type": "csv", "root": str(tmp_path)}
    assert registry.read_source(spark, src, "t", "patient_id").count() == 7
    assert registry.read_source(spark, src, "t", "patient_id", "PAT-005").count() == 2
    with pytest.raises(ValueError):
        registry.read_source(spark, src, "t", "nope", "x")
    (tmp_path / "e.csv").write_text("")
    assert registry.read_source(spark, src, "e", "patient_id", "x").count() == 0


def test_csv_by_name(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text('id,Name,city\n1,"Smith, ""J""",NULL\n2,,Rome\n3\n4,x,y,surplus\n')
    (tmp_path / "b.csv").write_text('CITY,ID,other\n"",5,q\nParis,6,q\n')
    (tmp_path / "c.csv").write_text("")
    (tmp_path / "d.csv").write_text("\ufeffID,Name\n7,Z\n", encoding="utf-8")
    got = files.read_csv_by_name(spark, files.list_files(spark, str(tmp_path), r".*[.]csv"), ["id", "name", "city"])
    assert rows(got, "id", "name", "city") == [
        ("1", 'Smith, "J"', None), ("2", None, "Rome"), ("3", None, None), ("4", "x", "y"), ("5", None, None), ("6", None, "Paris"), ("7", "Z", None)
    ]
    assert {r[0].rsplit("/", 1)[1] for r in got.select("_source_file").collect()} == {"a.csv", "b.csv", "d.csv"}


def test_csv_with_one_header(spark, tmp_path):
    for n in "ab":
        (tmp_path / f"{n}.csv").write_text(f"ID,x\n{n},1\n")
    got = files.read_csv_by_name(spark, files.list_files(spark, str(tmp_path)), ["id"], one_header=True)
    assert sorted(r["id"] for r in got.collect()) == ["a", "b"]


def test_files_chosen_by_pattern(spark, tmp_path):
    for n in ("x_patients_1.csv", "patients.csv", "patients.txt", "other.csv"):
        (tmp_path / n).write_text("a\n1\n")
    found = files.list_files(spark, str(tmp_path), r".*patients.*[.]csv")
    assert [f.rsplit("/", 1)[1] for f in found] == ["patients.csv", "x_patients_1.csv"]


def test_error_policies_for_csv(spark, tmp_path, rows):
    (tmp_path / "p.csv").write_text("id,born\n1,2001-02-03\n2,soon\n3,\n")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("born", T.DateType())])
    df = files.read_csv_by_name(spark, [str(tmp_path / "p.csv")], ["id", "born"]).drop("_source_file")
    assert rows(files.typed(df, schema, "continue"), "id") == [(1,), (3,)]
    bad = files.typed(df, schema, "return_errors").collect()
    assert [(r["id"], r["born"], r["_errors"]) for r in bad] == [("2", "soon", ["born"])]
    with pytest.raises(Exception):  # noqa: B017 - Spark reports it in more than one class
        files.typed(df, schema, "abort").collect()
    with pytest.raises(ValueError):
        files.typed(df, schema, "shrug")


def test_error_policies_for_ndjson(spark, tmp_path):
    (tmp_path / "e.json").write_text('{"a": 1}\n\n   \n{"a": \n{"a": null}\n[1]\n')
    path = str(tmp_path / "e.json")
    assert files.read_ndjson_variant(spark, path).count() == 3
    assert [r["value"] for r in files.read_ndjson_variant(spark, path, "return_errors").collect()] == ['{"a": ']
    with pytest.raises(Exception):  # noqa: B017 - Spark reports it in more than one class
        files.read_ndjson_variant(spark, path, "abort").collect()


def test_a_line_is_parsed_once(spark, tmp_path):
    (tmp_path / "e.json").write_text('{"a": 1}\n')
    plan = files.read_ndjson_variant(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson") == plan.count("Generate")


def test_row_numbers_over_many_blocks(spark, tmp_path):
    """Files split into many blocks: numbers must still be those of the lines."""
    rnd = random.Random(1)
    want = {}
    for name in ("a.json", "b.json", "c.json"):
        lines = [json.dumps({"k": f"{name}-{i}", "pad": "x" * rnd.randrange(200)}) for i in range(rnd.randrange(300, 900))]
        lines.insert(5, "")
        (tmp_path / name).write_text("\n".join(lines) + "\n")
        want.update({json.loads(line)["k"]: i for i, line in enumerate(lines, 1) if line})
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        df = files.read_ndjson_variant(spark, str(tmp_path), lineage=True)
        got = {r[0]: r[1] for r in df.selectExpr("v:k::string", "_file_row").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == want


def test_bulk_load_truncates_or_appends(spark, tmp_path):
    (tmp_path / "patients.csv").write_text("patient_id,birth_date,ssn\nP1,2001-02-03,NULL\nP2,bad,1\n")
    df = landing.patients_from_csv(spark, [str(tmp_path / "patients.csv")])
    raw = str(tmp_path / "raw")
    assert [landing.load_files(df, raw, t) for t in (False, False, True)] == [1, 1, 1]
    assert spark.read.parquet(raw).count() == 1
    assert landing.load_files(df.limit(0), raw) == 0


def test_overwrite_a_table_from_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).write.parquet(path)
    tables.overwrite(spark.read.parquet(path).filter("id < 3"), path)
    assert spark.read.parquet(path).count() == 3


def test_upper_and_exports(spark, tmp_path):
    df = tables.upper_columns(spark.createDataFrame(CONTRACT, "id bigint, name string, ts bigint"))
    assert df.columns == ["ID", "NAME", "TS"]
    tables.write_csv(df, str(tmp_path / "c"))
    tables.write_ndjson(df, str(tmp_path / "j"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == spark.read.json(str(tmp_path / "j")).count() == 4


# --- paged source over files ---------------------------------------------------------------------


def page_folder(tmp_path, data, size):
    base = tmp_path / "items"
    (base / "meta").mkdir(parents=True)
    (base / "meta" / "part").write_text(f"{size} {len(data)}")
    for k in range(0, len(data), size):
        (base / f"page={k // size}").mkdir()
        (base / f"page={k // size}" / "part").write_text(json.dumps(data[k : k + size]))
    return str(tmp_path)


@pytest.fixture
def shipped(spark):
    from millrace.session import ship_package

    ship_package(spark, "millrace", "testbed")


@pytest.mark.parametrize("page,tasks", [(2, 64), (3, 2), (100, 1)])
def test_paged_source(spark, tmp_path, shipped, page, tasks, rows):
    data = [{"id": i, "name": n, "ts": t} for i, n, t in CONTRACT]
    src = {"type": "rest", "base_url": page_folder(tmp_path, data, 3), "page_size": page, "tasks": tasks, "records_key": "data",
           "transport": "testbed.paging:send", "schema": "id bigint, name string, ts bigint", "key": ["id"]}
    assert rows(registry.read_source(spark, src, "items", "ts"), "id") == [(11,), (12,), (15,), (19,)]


def test_paged_source_without_total_and_params():
    from millrace.sources.paged_api import PagedReader

    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("gone", T.StringType())])
    reader = PagedReader(schema, {"base_url": "http://x/", "table": "t", "hwm": "ts", "since": "20", "page_size": "2"})
    asked = []

    def get(limit, offset):
        asked.append((limit, offset))
        return [{"id": i} for i in range(5)][offset : offset + limit], None

    reader._get = get
    parts = reader.partitions()
    assert len(parts) == 1 and parts[0].stop is None
    assert list(reader.read(parts[0])) == [(i, None) for i in range(5)]
    assert asked[1:] == [(2, 0), (2, 2), (2, 4)]
    assert reader.url == "http://x/t" and reader.filter == {"ts_gt": "20"}


def test_paged_partitions_cover_everything():
    from millrace.sources.paged_api import PagedReader

    schema = T.StructType([T.StructField("id", T.LongType())])
    for total in (0, 1, 9, 10, 11, 101):
        reader = PagedReader(schema, {"base_url": "http://x", "table": "t", "hwm": "id", "page_size": "3", "tasks": "4"})
        reader._get = lambda limit, offset, total=total: ([{"id": i} for i in range(offset, min(total, offset + limit))], total)
        got = [r[0] for p in reader.partitions() for r in reader.read(p)]
        assert got == list(range(total))


# --- workbooks -----------------------------------------------------------------------------------


def test_workbook(spark, tmp_path, shipped, rows):
    (tmp_path / "a.xlsx").write_bytes(workbook.workbook_bytes(["id", "name", "ts"], CONTRACT[:2], "items"))
    (tmp_path / "b.xlsx").write_bytes(workbook.workbook_bytes(["ts", "id"], [(130, 15), (142, 19)], "items"))
    src = {"type": "excel", "path": str(tmp_path), "columns": ["id", "name", "ts"]}
    assert rows(registry.read_source(spark, src, "items", "ts")) == [("11", "plum", "105"), ("12", "fig", "117"), ("15", None, "130"), ("19", None, "142")]
    assert rows(registry.read_source(spark, src, "items", "ts", "117"), "id") == [("15",), ("19",)]
    with pytest.raises(ValueError):
        registry.read_source(spark, src, "items", "nope", "20")


def test_workbook_sheet_falls_back_and_empty(spark, tmp_path, shipped):
    (tmp_path / "a.xlsx").write_bytes(workbook.workbook_bytes(["id"], [(1,), (None,)], "other"))
    assert [r["id"] for r in workbook.read_workbook(spark, str(tmp_path), "items").collect()] == ["1", None]
    with pytest.raises(FileNotFoundError):
        workbook.read_workbook(spark, str(tmp_path / ""), "items", glob="*.none")


# --- relational ----------------------------------------------------------------------------------


def test_urls_and_options():
    assert jdbc.jdbc_url("postgres", {"host": "h", "database": "d"}) == "jdbc:postgresql://h:5432/d"
    assert jdbc.jdbc_url("sqlserver", {"host": "h", "port": 1, "database": "d"}) == "jdbc:sqlserver://h:1;databaseName=d"
    assert jdbc.jdbc_url("oracle", {"database": "d"}) == "jdbc:oracle:thin:@//localhost:1521/d"
    assert jdbc.jdbc_url("sqlite", {"path": "/x.db"}) == "jdbc:sqlite:/x.db"
    o = jdbc.jdbc_options("mysql", {"database": "d", "user": "u", "password": "p", "fetchsize": 7})
    assert o["fetchsize"] == "7" and o["useCursorFetch"] == "true" and o["user"] == "u"
    for kind in ("postgres", "sqlite"):
        with pytest.raises(ValueError):
            jdbc.jdbc_url(kind, {})
    with pytest.raises(ValueError):
        jdbc.jdbc_url("paper", {"database": "d"})


def test_text_ranges_cover_every_value_once(spark):
    values = ["", "a", "b'", "c", "m", "zz", None]
    spark.createDataFrame([(v,) for v in values], "k string").createOrReplaceTempView("keys_of_text")
    parts = jdbc.text_ranges("k", ["c", "b'", "m"])
    hits = []
    for p in parts:
        # the predicates use standard SQL quoting, Spark's own uses a backslash
        quoted = p.replace("'b'''", '"b\'"')
        hits += [r[0] for r in spark.sql(f"SELECT k FROM keys_of_text WHERE {quoted}").collect()]
    assert sorted(hits, key=repr) == sorted(values, key=repr) and len(parts) == 4
    assert jdbc.text_ranges("k", []) == ["1 = 1"]
    with pytest.raises(ValueError):
        jdbc.text_ranges("k; drop", ["a"])


def test_config_rules():
    good = {"source": {"type": "csv"}, "landing": "x", "state": "y", "tables": [{"name": "t", "hwm_column": "id"}]}
    load.validate(good)
    for bad in ({**good, "tables": []}, {**good, "control": {"source_group": "g"}}, {**good, "tables": [{"name": "t"}]},
                {**good, "source": {"type": "x"}}, {k: v for k, v in good.items() if k != "state"},
                {**good, "tables": None, "control": {"path": "p"}}):
        with pytest.raises(ValueError):
            load.validate(bad)


def test_numbering_lines_writes_no_text(spark, tmp_path):
    """Only counts per block are kept, and changed files are noticed."""
    for i in range(3):
        (tmp_path / f"f{i}.json").write_text("".join(f"line {j} of file {i} {'x' * 60}\n" for j in range(400 * (i + 1))))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        numbered = files.with_file_row(files.read_lines(spark, str(tmp_path), "*.json"))
        got = numbered.selectExpr("cast(split(value, ' ')[1] as int) + 1 = _file_row as ok", "_source_file").groupBy("ok").count().collect()
        assert [(r["ok"], r["count"]) for r in got] == [(True, 2400)]
        plan = numbered._jdf.queryExecution().executedPlan().toString()
        scans = [p for p in plan.split("FileScan ")[1:]]
        assert len([p for p in scans if p.startswith("text")]) == 1 and not any("value" in p.split("ReadSchema")[-1] for p in scans if p.startswith("parquet"))
        spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
        with pytest.raises(Exception, match="splits changed"):
            numbered.selectExpr("sum(_file_row)").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_headers_are_read_in_tasks(spark, tmp_path, monkeypatch):
    """Names with blanks and umlauts, compressed and empty files; the driver opens none of them."""
    import gzip

    (tmp_path / "a b.csv").write_text("id,v\n1,x\n" + "2,y\n" * 30_000)
    (tmp_path / "ü%20.csv").write_text("﻿id,v\n3,z\n", encoding="utf-8")
    (tmp_path / "c.csv").write_text("v,id\nq,4\n")
    (tmp_path / "e.csv").write_text("")
    with gzip.open(tmp_path / "g.csv.gz", "wt") as f:
        f.write("v,id\nr,5\n")
    paths = [str(tmp_path / n) for n in ("a b.csv", "ü%20.csv", "c.csv", "e.csv", "g.csv.gz")]
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    got = {h: sorted(p) for h, p in files.headers(spark, paths).items()}
    assert got == {"id,v": sorted(paths[:2]), "v,id": sorted([paths[2], paths[4]])} and spark.conf.get("spark.sql.files.openCostInBytes") == before
    df = files.read_csv_by_name(spark, paths, ["id", "v"])
    assert df.count() == 30_004 and {r["id"]: r["v"] for r in df.collect()} == {"1": "x", "2": "y", "3": "z", "4": "q", "5": "r"}
    assert files.read_csv_by_name(spark, [], ["id"]).count() == 0 and files.read_csv_by_name(spark, paths[3:4], ["id"]).count() == 0

import json
from datetime import date, datetime
from decimal import Decimal

import pytest

from millrace.operators import aggregates
from millrace.plans import load
from millrace.plans.state import LoadState, decode_hwm, encode_hwm


def csv(path, n, start=1):
    path.write_text("patient_id,ssn\n" + "".join(f"PAT-{i:06d},123-45-{1000 + i}\n" for i in range(start, n + 1)))


@pytest.fixture
def job(spark, tmp_path):
    source = {"type": "csv", "path": str(tmp_path / "patients.csv")}
    table = load.TableLoad("patients", "patient_id", "patients_csv", mask={"ssn": "ssn"})
    state = LoadState(spark, str(tmp_path / "state"))

    def run(n=None, **kwargs):
        if n is not None:
            csv(tmp_path / "patients.csv", n)
        return load.load_table(spark, source, table, state, str(tmp_path / "raw"), **kwargs)

    run.state, run.raw, run.source, run.table = state, str(tmp_path / "raw" / "patients_csv"), source, table
    return run


def test_load_masks_and_checkpoints(spark, job):
    r = job(5, count_first=True)
    assert (r.rows_read, r.rows_written, r.total, r.new_hwm) == (5, 5, 5, "PAT-000005")
    assert {x["ssn"][:7] for x in spark.read.parquet(job.raw).collect()} == {"XXX-XX-"}
    rec = job.state.record("csv", "patients")
    assert (rec["rows"], rec["status"], rec["hwm"]) == (5, "complete", "PAT-000005")


def test_dry_run_changes_nothing(spark, job):
    r = job(3, dry_run=True)
    assert (r.rows_read, r.rows_written, r.sample["ssn"][:7]) == (3, 0, "XXX-XX-")
    assert job.state.record("csv", "patients") == {}


def test_resume_loads_only_new_rows(spark, job):
    job(3)
    assert job(5).rows_written == 2
    r = job(5)
    assert (r.rows_written, r.batches, r.new_hwm) == (0, 0, "PAT-000005")
    assert spark.read.parquet(job.raw).count() == 5
    assert job.state.record("csv", "patients")["rows"] == 5


def test_restart_reloads_without_truncating(spark, job):
    job(3)
    job.state.reset("csv", "patients")
    assert job.state.get("csv", "patients") is None
    assert job(3).rows_written == 3
    assert job(3, restart=True).rows_written == 3
    assert spark.read.parquet(job.raw).count() == 9


def test_a_load_that_dies_before_its_checkpoint_is_replaced(spark, job, monkeypatch):
    job(3)
    with monkeypatch.context() as m:
        m.setattr(LoadState, "advance", lambda *a: (_ for _ in ()).throw(RuntimeError("driver died")))
        with pytest.raises(RuntimeError):
            job(5)
    assert job.state.record("csv", "patients")["status"] == "in_progress"
    job(6)
    assert sorted(r[0] for r in spark.read.parquet(job.raw).select("patient_id").collect()) == [f"PAT-{i:06d}" for i in range(1, 7)]


def test_a_lost_checkpoint_appends(spark, job, tmp_path):
    job(3)
    load.load_table(spark, job.source, job.table, LoadState(spark, str(tmp_path / "other")), str(tmp_path / "raw"))
    assert spark.read.parquet(job.raw).count() == 6


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize("type_", ["timestamp", "timestamp_ntz", "date", "decimal(10,2)", "double"])
def test_marks_of_every_type_resume(spark, tmp_path, zone, type_):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        values = ["2024-01-01 23:30:00.000001", "2024-07-01 01:30:00"] if type_[0] in "t" else ["2024-01-01", "2024-07-01"] if type_ == "date" else ["1.25", "10.5"]
        df = spark.createDataFrame([(v,) for v in values], "v string").selectExpr(f"cast(v as {type_}) as v")
        df.limit(1).write.parquet(str(tmp_path / "t.parquet"))
        state, src, t = LoadState(spark, str(tmp_path / "s")), {"type": "parquet", "root": str(tmp_path)}, load.TableLoad("t", "v")
        assert load.load_table(spark, src, t, state, str(tmp_path / "raw")).rows_written == 1
        df.write.mode("overwrite").parquet(str(tmp_path / "t.parquet"))
        assert [load.load_table(spark, src, t, state, str(tmp_path / "raw")).rows_written for _ in range(2)] == [1, 0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_hostile_name_and_unknown_policy_stop_first(spark, job):
    csv_before = job.state.record("csv", "patients")
    for t in (load.TableLoad("patients; DROP TABLE x", "id"), load.TableLoad("p", "id", "a b"), load.TableLoad("p", "id --"),
              load.TableLoad("patients", "patient_id", mask={"ssn": "nope"})):
        with pytest.raises(ValueError):
            load.load_table(spark, job.source, t, job.state, job.raw)
    assert job.state.record("csv", "patients") == csv_before


def test_marks_keep_their_type(spark, tmp_path):
    state = LoadState(spark, str(tmp_path / "s"))
    for i, v in enumerate([100, 1.5, "x", True, date(2024, 1, 2), datetime(2024, 1, 2, 3, 4, 5, 6), Decimal("1.50"), None]):
        state.advance("src", f"t{i}", v, 1)
        got = state.get("src", f"t{i}")
        assert got == v and type(got) is type(v)
        assert decode_hwm(*encode_hwm(v)) == v


def test_sources_do_not_share_a_mark(spark, tmp_path):
    state = LoadState(spark, str(tmp_path / "s"))
    state.advance("a", "t", 1, 1)
    assert state.get("b", "t") is None
    state.advance("b", "t", 5, 2)
    state.advance("a", "t", 2, 3)
    got = {(r["source"], r["hwm"], r["rows"]) for r in state.status().collect()}
    assert got == {("a", "2", 4), ("b", "5", 2)}


def test_legacy_and_corrupt_state(spark, tmp_path):
    (tmp_path / "old.json").write_text('{"patients": "PAT-000007", "visits": {"hwm": 12, "rows": 3, "status": "complete"}}')
    state = LoadState(spark, str(tmp_path / "s"))
    assert state.import_legacy("csv", str(tmp_path / "old.json")) == 2
    assert state.get("csv", "patients") == "PAT-000007" and state.get("csv", "visits") == 12
    (tmp_path / "s" / "csv@patients.json").write_text("{not json")
    # a checksum written beside the file would be checked first
    (tmp_path / "s" / ".csv@patients.json.crc").unlink(missing_ok=True)
    with pytest.raises(RuntimeError):
        state.get("csv", "patients")
    (tmp_path / "s" / "csv@patients.json").write_text('"PAT-000009"')
    assert state.get("csv", "patients") == "PAT-000009"


def test_work_list(spark):
    rows = [("g", "b", "B", "id", None, None, True), ("g", "a", "A", "id", 10, '{"ssn": "ssn"}', True), ("g", "c", "C", "id", 1, None, False),
            ("h", "d", "D", "id", 1, None, True)]
    control = spark.createDataFrame(rows, "source_group string, source_table string, target_table string, hwm_column string, batch_size bigint, mask string, enabled boolean")
    got = load.table_loads(load.work_list(control, "g"))
    assert [(t.name, t.batch_size, t.mask) for t in got] == [("a", 10, {"ssn": "ssn"}), ("b", 5000, {})]
    assert [t.name for t in load.table_loads(load.work_list(control, "g", only=["b"]))] == ["b"]


def test_configured_job_with_log(spark, tmp_path):
    for name, n in (("a", 3), ("b", 4)):
        spark.range(n).write.parquet(str(tmp_path / f"{name}.parquet"))
    cfg = {"source": {"type": "parquet", "root": str(tmp_path)}, "landing": str(tmp_path / "raw"), "state": str(tmp_path / "state"),
           "log": str(tmp_path / "log"), "masking": {"salt": "s"},
           "tables": [{"name": "a", "hwm_column": "id"}, {"name": "b", "hwm_column": "id", "target": "bb", "mask": '{"id": "hash"}'}]}
    results = load.run(spark, cfg, run_id="r1")
    assert [(r.target, r.rows_written, r.new_hwm) for r in results] == [("a", 3, 2), ("bb", 4, 3)]
    log = spark.read.parquet(str(tmp_path / "log"))
    assert tuple(aggregates.run_totals(log, "r1").first()) == ("r1", 2, 7, 7)
    assert {len(r["id"]) for r in spark.read.parquet(str(tmp_path / "raw" / "bb")).collect()} == {64}
    with pytest.raises(ValueError):
        load.run(spark, cfg, only=["zzz"])


def test_a_failing_log_does_not_fail_the_load(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "a.parquet"))
    (tmp_path / "log").write_text("a file, not a folder")
    got = load.load_all(spark, {"type": "parquet", "root": str(tmp_path)}, [load.TableLoad("a", "id")],
                        LoadState(spark, str(tmp_path / "s")), str(tmp_path / "raw"), log=str(tmp_path / "log"))
    assert got[0].rows_written == 3
    assert json.loads((tmp_path / "s" / "parquet@a.json").read_text())["status"] == "complete"

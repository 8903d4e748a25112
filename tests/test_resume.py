"""Loads that go on where they stopped, logs of several writers, tables that are never gone."""

import threading

import pytest
from pyspark.sql import functions as F

from millrace.operators import tables
from millrace.operators.positions import hwm_cuts
from millrace.plans import load
from millrace.plans.state import LoadState
from millrace.session import in_parallel


class Dies(LoadState):
    """Fails after so many checkpoints: what was written behind the last one has none."""

    left = 0

    def advance(self, *args):
        if not self.left:
            raise RuntimeError("driver died")
        self.left -= 1
        super().advance(*args)


def job(spark, tmp_path, rows, schema, hwm, **kwargs):
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "t.parquet"))
    source, raw = {"type": "parquet", "root": str(tmp_path)}, str(tmp_path / "raw")
    return source, load.TableLoad("t", hwm, **kwargs), Dies(spark, str(tmp_path / "state")), raw


def test_a_killed_load_goes_on_behind_its_last_checkpoint(spark, tmp_path):
    rows = [(i, f"row {i}") for i in range(1000)] + [(None, "no mark")]
    source, table, state, raw = job(spark, tmp_path, rows, "id long, note string", "id", batch_size=50, commit_batches=4)
    state.left = 3
    with pytest.raises(RuntimeError):
        load.load_table(spark, source, table, state, raw)
    record = state.record("parquet", "t")
    # three commits of four batches stand, the fourth is landed without a checkpoint
    assert (record["rows"], record["hwm"], record["load_no"], record["status"]) == (601, 599, 3, "in_progress")
    assert spark.read.parquet(f"{raw}/t").count() == 801
    state.left = 99
    again = load.load_table(spark, source, table, state, raw)
    assert (again.rows_read, again.batches, again.commits, again.new_hwm) == (400, 8, 2, 999)
    landed = spark.read.parquet(f"{raw}/t")
    assert landed.count() == 1001 and landed.select("id").distinct().count() == 1001
    assert state.record("parquet", "t")["status"] == "complete"
    nothing = load.load_table(spark, source, table, state, raw)
    assert (nothing.rows_read, nothing.batches, nothing.commits) == (0, 0, 0)


def test_each_step_reads_its_own_range(spark, tmp_path, monkeypatch):
    """The bounds of a step reach the Parquet scan."""
    source, table, state, raw = job(spark, tmp_path, [(i,) for i in range(400)], "id long", "id", batch_size=50, commit_batches=2)
    state.left, plans, land = 99, [], load._land
    monkeypatch.setattr(load, "_land", lambda part, *a: plans.append(part._jdf.queryExecution().executedPlan().toString()) or land(part, *a))
    assert load.load_table(spark, source, table, state, raw).commits == 4
    assert "LessThanOrEqual(id,99)" in plans[0] and "GreaterThan(id,99)" in plans[1] and "LessThanOrEqual(id,199)" in plans[1]
    assert "GreaterThan(id,299)" in plans[3] and "LessThanOrEqual" not in plans[3]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "decimal(12,2)", "double", "string"])
def test_steps_of_every_mark_type(spark, tmp_path, kind):
    """Ties are never parted, and every row lands once."""
    day = "date_add(date'2024-01-01', cast(id div 3 as int))"
    value = {"date": day, "double": "(id div 3) / 7", "decimal(12,2)": "(id div 3) / 8", "string": "lpad(cast(id div 3 as string), 5, '0')"}.get(kind, f"timestamp({day}) + make_interval(0,0,0,0,0,0,id div 3 / 1000)")
    spark.range(300).selectExpr("id", f"cast({value} as {kind}) as v").write.parquet(str(tmp_path / "t.parquet"))
    state = Dies(spark, str(tmp_path / "state"))
    source, table = {"type": "parquet", "root": str(tmp_path)}, load.TableLoad("t", "v", batch_size=20, commit_batches=3)
    state.left = 2
    with pytest.raises(RuntimeError):
        load.load_table(spark, source, table, state, str(tmp_path / "raw"))
    state.left = 99
    load.load_table(spark, source, table, state, str(tmp_path / "raw"))
    landed = spark.read.parquet(str(tmp_path / "raw/t"))
    assert sorted(r["id"] for r in landed.collect()) == list(range(300))
    assert landed.groupBy("v").agg(F.count_distinct("_load").alias("n")).agg(F.max("n")).first()[0] == 1


def test_text_marks_are_cut_by_number(spark, tmp_path):
    (tmp_path / "t.csv").write_text("k,v\n" + "".join(f"{i},x\n" for i in [*range(1, 101), "10.0", "abc"]))
    source = {"type": "csv", "path": str(tmp_path / "t.csv")}
    state, table = LoadState(spark, str(tmp_path / "s")), load.TableLoad("t", "k", batch_size=10, commit_batches=2)
    done = load.load_table(spark, source, table, state, str(tmp_path / "raw"))
    assert (done.rows_read, done.new_hwm) == (102, "abc") and done.commits >= 5
    per = spark.read.parquet(str(tmp_path / "raw/t")).filter("k in ('10', '10.0')").select("_load").distinct()
    assert per.count() == 1


def test_number_of_commits_is_bounded(spark):
    rows = spark.range(5000)
    cuts = hwm_cuts(rows, "id", 10, 1, 16).orderBy("group").collect()
    assert len(cuts) <= 17 and sum(r["rows"] for r in cuts) == 5000 and sum(r["batches"] for r in cuts) == 500
    # one mark with most rows stays whole
    tied = rows.select(F.when(F.col("id") < 4000, 7).otherwise(F.col("id")).alias("id"))
    assert max(r["rows"] for r in hwm_cuts(tied, "id", 10, 5, 64).collect()) >= 4000


def test_many_writers_log_at_once(spark, tmp_path):
    for turn in range(20):
        path = str(tmp_path / f"log{turn}")
        jobs = [lambda n=n, p=path: load._log(spark, p, f"r-{n}", ("r", "s", f"t{n}", n, n)) for n in range(8)]
        in_parallel(spark, *jobs)
        log = spark.read.parquet(path)
        assert sorted(r["target"] for r in log.collect()) == [f"t{n}" for n in range(8)] and log.select("log_id").distinct().count() == 8
    # an entry logged again replaces itself
    load._log(spark, path, "r-3", ("r", "s", "t3", 33, 33))
    assert spark.read.parquet(path).agg(F.sum("rows_read")).first()[0] == sum(range(8)) - 3 + 33


def test_an_unwritable_log_says_so(spark, tmp_path):
    (tmp_path / "log").write_text("a file")
    row = spark.createDataFrame([("r",)], "run_id string")
    assert tables.log_transfer(spark, str(tmp_path / "log"), row, "e") is False
    assert tables.log_transfer(spark, str(tmp_path / "fine"), row, "e") is True


def test_a_table_is_read_while_it_is_replaced(spark, tmp_path):
    path, stop, seen, failed = str(tmp_path / "t"), threading.Event(), set(), []
    tables.replace_snapshot(spark.range(100).withColumn("v", F.lit(0)), path)

    def read():
        while not stop.is_set():
            try:
                rows = tables.read_snapshot(spark, path).agg(F.count(F.lit(1)), F.min("v"), F.max("v")).first()
                seen.add(tuple(rows))
            except Exception as exc:  # noqa: BLE001
                failed.append(exc)

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for v in range(1, 8):
            tables.replace_snapshot(spark.range(100).withColumn("v", F.lit(v)), path, keep=4)
    finally:
        stop.set()
        reader.join()
    assert not failed and seen and all(n == 100 and low == high for n, low, high in seen)


def test_a_replacement_that_dies_leaves_the_old_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    old = tables.replace_snapshot(spark.range(5), path)
    with monkeypatch.context() as m:
        m.setattr(tables, "replace_text", lambda *a: (_ for _ in ()).throw(RuntimeError("driver died")))
        with pytest.raises(RuntimeError):
            tables.replace_snapshot(spark.range(9), path)
    with pytest.raises(Exception):
        tables.replace_snapshot(spark.range(3).select(F.raise_error(F.lit("no")).alias("id")), path)
    assert tables.read_snapshot(spark, path).count() == 5
    # built from itself; a frame of the content before still reads
    new = tables.replace_snapshot(tables.read_snapshot(spark, path).filter("id < 2"), path)
    assert new.count() == 2 and old.count() == 5 and tables.read_snapshot(spark, path).count() == 2
    for _ in range(3):
        tables.replace_snapshot(spark.range(1), path)
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("_v-")]) == 2
    with pytest.raises(FileNotFoundError):
        tables.read_snapshot(spark, str(tmp_path / "none"))


def test_a_plain_overwrite_that_was_cut_off_is_undone(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.overwrite(spark.range(4), path)
    # as a crash between the two renames leaves it
    (tmp_path / "t").rename(tmp_path / "t__before")
    tables._recover(spark, path)
    assert spark.read.parquet(path).count() == 4
    tables.overwrite(spark.read.parquet(path).filter("id > 0"), path)
    assert spark.read.parquet(path).count() == 3 and not (tmp_path / "t__before").exists()

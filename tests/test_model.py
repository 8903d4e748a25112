import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.functions import dates
from millrace.functions.variant import vget
from millrace.operators import merge, scd2, tables
from millrace.operators.dedup import latest_per_key
from millrace.operators.joins import asof_join, restrict, with_exists_flag
from millrace.plans import marts, staging


def ts(text):
    return F.lit(text).cast("timestamp_ntz")


def test_minute_boundaries(spark):
    cases = [("2024-01-01 00:00:59", "2024-01-01 00:01:00", 1), ("2024-01-01 00:00:00", "2024-01-01 00:00:59", 0),
             ("2024-01-01 23:59:30", "2024-01-02 00:00:10", 1), ("2024-01-02 00:00:00", "2024-01-01 23:59:59", -1),
             ("2024-03-31 01:30:00", "2024-03-31 03:30:00", 120)]
    df = spark.createDataFrame(cases, "a string, b string, want int")
    got = df.select(dates.minutes_between(F.col("a").cast("timestamp_ntz"), F.col("b").cast("timestamp_ntz")), "want").collect()
    assert all(g == w for g, w in got)


def test_calendar(spark):
    d = marts.build_dim_date(spark)
    assert d.count() == 1461
    r = d.filter("date_key = 20240107").first()
    assert (r["year"], r["month"], r["day"], r["month_name"], r["day_of_week"]) == (2024, 1, 7, "Jan", 0)


DOCS = [
    '{"encounter_id": "E1", "patient_id": "P1", "start": "2024-01-01T10:00:30", "stop": "2024-01-01T10:02:10", "provider": {"name": "Dr. A"}, "observations": [{"code": "x", "value": 1.5}], "conditions": []}',
    '{"encounter_id": "E2", "billing": {"total_charge": 10.005, "paid_amount": 3, "payer": "P"}, "observations": null}',
    '{"encounter_id": "E3", "observations": [], "conditions": [{"code": "c"}, {"code": "d"}]}',
    '{"encounter_id": "E4", "observations": {"not": "an array"}}',
]


def raw(spark, docs, load="2024-01-01"):
    df = spark.createDataFrame([(d, i) for i, d in enumerate(docs)], "t string, _file_row bigint")
    return df.select(F.parse_json("t").alias("v"), F.lit("f").alias("_source_file"), "_file_row", ts(load).alias("_load_ts"))


def test_documents_with_missing_parts(spark):
    got = {r["encounter_id"]: r for r in staging.encounters_flat(raw(spark, DOCS)).collect()}
    assert (got["E1"]["duration_minutes"], got["E1"]["observation_count"], got["E1"]["condition_count"], got["E1"]["total_charge"]) == (2, 1, 0, None)
    assert (str(got["E2"]["total_charge"]), got["E2"]["observation_count"], got["E2"]["started_at"]) == ("10.01", None, None)
    assert (got["E3"]["observation_count"], got["E3"]["condition_count"]) == (0, 2)
    assert got["E4"]["observation_count"] is None
    assert staging.observations_flat(raw(spark, DOCS)).count() == 1
    assert staging.conditions_flat(raw(spark, DOCS)).count() == 2
    assert len(staging.stg_encounters(raw(spark, DOCS)).columns) == 13


def test_bad_value_raises_unless_lenient(spark):
    df = raw(spark, ['{"start": "soon"}'])
    with pytest.raises(Exception):  # noqa: B017
        df.select(vget("v", "start", "timestamp_ntz")).collect()
    assert df.select(vget("v", "start", "timestamp_ntz", strict=False)).first()[0] is None


def test_repeated_encounter_keeps_the_latest(spark):
    both = raw(spark, DOCS).unionByName(raw(spark, ['{"encounter_id": "E1", "patient_id": "P9", "observations": [{"code": "y"}, {"code": "z"}]}'], "2024-02-01"))
    assert staging.stage_encounters(both).filter("encounter_id = 'E1'").first()["patient_id"] == "P9"
    assert {r["obs_code"] for r in staging.stage_observations(both).collect()} == {"y", "z"}
    assert staging.encounters_flat(both).count() == 5


def test_latest_row_null_time_last_and_hot_key(spark):
    n = 3000
    rnd = random.Random(2)
    rows = [("hot" if i % 3 else f"k{i % 50}", rnd.choice([None, *range(20)]), i) for i in range(n)]
    df = spark.createDataFrame(rows, "k string, t bigint, i bigint")
    got = {r["k"]: (r["t"], r["i"]) for r in latest_per_key(df, ["k"], "t", ["i"]).collect()}
    want = {}
    for k, t, i in rows:
        rank = (t is not None, t or 0, i)
        if k not in want or rank > want[k][0]:
            want[k] = (rank, (t, i))
    assert got == {k: v for k, (_, v) in want.items()}


def test_latest_row_is_cut_down_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = latest_per_key(df, ["k"], "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_new_rows_match_null_keys(spark, rows):
    t = spark.createDataFrame([("a", None), ("b", "x")], "c string, s string")
    s = spark.createDataFrame([("a", None), ("b", None), ("b", "x"), (None, None)], "c string, s string")
    assert rows(merge.new_rows(t, s, ["c", "s"])) == [("b", None), (None, None)]
    again = merge.insert_if_absent(t, s, ["c", "s"])
    assert rows(merge.insert_if_absent(again, s, ["c", "s"])) == rows(again)


def test_new_rows_never_shuffle_a_big_target_for_a_small_delta(spark, tmp_path):
    spark.range(200000).write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    plan = merge.new_rows(target, spark.createDataFrame([(5,), (-1,)], "id bigint"), ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan


def test_upsert(spark, rows):
    t = spark.createDataFrame([("a", 1, "t"), ("b", 2, "t")], "k string, v int, at string")
    s = spark.createDataFrame([("b", 20, "s"), ("c", 30, "s"), (None, 1, "s")], "k string, v int, at string")
    once = merge.upsert(t, s, ["k"], ["v"])
    assert rows(once) == [("a", 1, "t"), ("b", 20, "t"), ("c", 30, "s"), (None, 1, "s")]
    assert rows(merge.upsert(once, s, ["k"], ["v"])) == rows(once)
    held = merge.upsert(t, s, ["k"], ["v"], accept=lambda a, b: F.col(b + "v") < F.col(a + "v"))
    assert rows(held)[1] == ("b", 2, "t")


def test_update_from_and_exists(spark, rows):
    t = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    s = spark.createDataFrame([("a", 5), ("b", None), ("b2", 1)], "k string, v int")
    out = merge.update_from(t, s, "k", lambda a, b: F.col(a + "v") != F.col(b + "v"), {"v": F.lit(0)})
    assert rows(out) == [("a", 0), ("b", 2), (None, 3)]
    assert rows(with_exists_flag(t, s.unionByName(s), "k"), "k", "known") == [("a", True), ("b", True), (None, False)]
    assert restrict(t, s.unionByName(s), ["k"]).count() == 2


PERSON = "patient_id string, first_name string, last_name string, birth_date date, gender string, city string, state string"


def person(spark, rows_):
    return spark.createDataFrame([(p, "f", "l", b, "F", c, "NY") for p, b, c in rows_], PERSON)


@pytest.mark.parametrize("null_safe", [False, True])
def test_history(spark, null_safe):
    d1 = datetime(2000, 1, 1).date()
    dim = marts.empty_dim_patient(spark)

    def apply(dim, snap, now):
        return scd2.scd2_apply(dim, snap, "patient_id", marts.TRACKED, ts(now), "patient_sk", null_safe=null_safe)

    dim = apply(dim, person(spark, [("P1", None, "Rome"), ("P2", None, None)]), "2024-01-01")
    snap = person(spark, [("P1", d1, "Oslo"), ("P2", None, "Bern"), ("P3", None, "Kyiv")])
    dim = apply(dim, snap, "2024-02-01")
    again = apply(dim, snap, "2024-03-01")
    key = lambda d: sorted(map(tuple, d.collect()), key=repr)
    assert key(again) == key(dim)
    got = {(r["patient_id"], r["city"]): (str(r["valid_from"])[:10], str(r["valid_to"])[:10], r["is_current"]) for r in dim.collect()}
    want = {("P1", "Rome"): ("1900-01-01", "2024-02-01", False), ("P1", "Oslo"): ("2024-02-01", "None", True), ("P3", "Kyiv"): ("1900-01-01", "None", True)}
    if null_safe:
        want |= {("P2", None): ("1900-01-01", "2024-02-01", False), ("P2", "Bern"): ("2024-02-01", "None", True)}
    else:
        want |= {("P2", None): ("1900-01-01", "None", True)}
    assert got == want
    assert dim.select("patient_sk").distinct().count() == dim.count()


def test_birth_date_change_from_null_counts_in_both(spark):
    dim = scd2.scd2_apply(marts.empty_dim_patient(spark), person(spark, [("P1", None, "Rome")]), "patient_id", marts.TRACKED, ts("2024-01-01"), "patient_sk")
    dim = scd2.scd2_apply(dim, person(spark, [("P1", datetime(2000, 1, 1).date(), "Rome")]), "patient_id", marts.TRACKED, ts("2024-02-01"), "patient_sk")
    assert dim.count() == 2


@pytest.mark.parametrize("many", [False, True, None])
@pytest.mark.parametrize("partitions", ["1", "5"])
def test_asof_against_brute_force(spark, many, partitions):
    """One key holds most facts and most versions; NULL keys, NULL times, gaps between versions."""
    rnd = random.Random(9)
    base = datetime(2024, 1, 1)
    at = lambda m: datetime.fromtimestamp(base.timestamp() + m * 60)
    dims = []
    for k, n in (("hot", 60), ("a", 3), ("b", 1), (None, 1)):
        cuts = sorted(rnd.sample(range(10000), n + 1))
        for i in range(n):
            end = cuts[i + 1] - rnd.choice([0, 0, 5])
            dims.append((k, at(cuts[i]), None if i == n - 1 and k != "a" else at(max(end, cuts[i])), len(dims)))
    facts = [(i, rnd.choice(["hot", "hot", "hot", "a", "b", "c", None]), rnd.choice([None] + [at(rnd.randrange(11000))] * 9)) for i in range(800)]
    facts += [(1000 + i, d[0], d[1]) for i, d in enumerate(dims)]
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        f = spark.createDataFrame(facts, "id bigint, k string, t timestamp_ntz")
        d = spark.createDataFrame(dims, "k string, valid_from timestamp_ntz, valid_to timestamp_ntz, sk bigint")
        got = {r["id"]: r["sk"] for r in asof_join(f, d, "k", "t", payload=["sk"], many_versions=many, version_limit=10).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    want = {}
    for i, k, t in facts:
        hits = [s for dk, a, b, s in dims if dk is not None and dk == k and t is not None and a <= t and (b is None or t < b)]
        assert len(hits) <= 1
        want[i] = hits[0] if hits else None
    assert got == want


def test_moved_patient_keeps_old_encounters(spark):
    dim = scd2.scd2_apply(marts.empty_dim_patient(spark), person(spark, [("P1", None, "Rome")]), "patient_id", marts.TRACKED, ts("2024-01-01"), "patient_sk")
    dim = scd2.scd2_apply(dim, person(spark, [("P1", None, "Oslo")]), "patient_id", marts.TRACKED, ts("2024-02-01"), "patient_sk")
    assert [(r["city"], r["is_current"]) for r in dim.orderBy("valid_from").collect()] == [("Rome", False), ("Oslo", True)]
    enc = spark.createDataFrame([("E1", "P1", datetime(2024, 1, 15)), ("E2", "P1", datetime(2024, 2, 15))], "encounter_id string, patient_id string, started_at timestamp_ntz")
    got = asof_join(enc, dim, "patient_id", "started_at", payload=["city"])
    assert {r["encounter_id"]: r["city"] for r in got.collect()} == {"E1": "Rome", "E2": "Oslo"}


def test_dimensions_twice_give_the_same(spark, rows):
    enc = staging.stage_encounters(raw(spark, [
        json_doc("E1", "F1", "Clinic", "Rome", "NY"), json_doc("E2", "F1", "Clinic B", "Rome", "NY"), json_doc("E3", "F2", "X", "Oslo", "ZZ"),
        '{"encounter_id": "E4"}',
    ]))
    loc = marts.build_dim_location(enc)
    assert rows(loc, "city", "state", "region") == [("Oslo", "ZZ", "Other"), ("Rome", "NY", "Northeast"), (None, None, "Other")]
    assert marts.build_dim_location(enc, loc).count() == 0
    fac = marts.build_dim_facility(enc, loc)
    assert rows(fac, "facility_id", "facility_name") == [("F1", "Clinic"), ("F2", "X")]
    assert marts.build_dim_facility(enc, loc, fac).count() == 0
    assert rows(marts.facility_conflicts(enc)) == [("F1", 2)]
    prov = marts.build_dim_provider(enc)
    assert prov.count() == 2 and marts.build_dim_provider(enc, prov).count() == 0
    pay = marts.build_dim_payer(enc)
    assert rows(pay, "payer_name") == [("Payer",)]
    more = marts.build_dim_payer(spark.createDataFrame([("Payer",), ("Other",)], "payer string"), pay)
    assert rows(more, "payer_sk", "payer_name") == [(2, "Other")]


def json_doc(e, f, name, city, state):
    return ('{"encounter_id": "%s", "start": "2024-01-05T00:00:00", "provider": {"name": "Dr", "facility_id": "%s", "facility_name": "%s", '
            '"city": "%s", "state": "%s"}, "billing": {"payer": "Payer"}}' % (e, f, name, city, state))


def test_history_is_not_read(spark, tmp_path):
    """A snapshot touches current rows only, a cut-off one leaves the table as it was."""
    kept = scd2.History(spark, str(tmp_path / "h"), marts.DIM_PATIENT, "patient_id", marts.TRACKED, "patient_sk")
    kept.apply(person(spark, [("P1", None, "Rome"), ("P2", None, "Bern")]), ts("2024-01-01"))
    kept.apply(person(spark, [("P1", None, "Oslo"), ("P3", None, "Kyiv")]), ts("2024-02-01"))
    steps = scd2.scd2_steps(kept.current(), person(spark, [("P1", None, "Lima")]), "patient_id", marts.TRACKED, ts("2024-03-01"))
    plan = steps._jdf.queryExecution().executedPlan().toString()
    assert "/closed" not in plan and plan.count("Join FullOuter") + plan.count("FullOuter") >= 1 and plan.count("Scan parquet") == 1
    # unreadable history does not matter to a snapshot
    (tmp_path / "h" / "closed").rename(tmp_path / "h" / "away")
    kept.apply(person(spark, [("P1", None, "Lima")]), ts("2024-03-01"))
    for part in (tmp_path / "h" / "away").iterdir():
        if part.name.startswith("_content="):
            part.rename(tmp_path / "h" / "closed" / part.name)
    got = sorted((r["patient_id"], r["city"], r["is_current"], r["patient_sk"]) for r in kept.table().collect())
    assert got == [("P1", "Lima", True, 5), ("P1", "Oslo", False, 3), ("P1", "Rome", False, 1), ("P2", "Bern", True, 2), ("P3", "Kyiv", True, 4)]


def test_a_snapshot_that_dies_closes_nothing(spark, tmp_path, monkeypatch):
    kept = scd2.History(spark, str(tmp_path / "h"), marts.DIM_PATIENT, "patient_id", marts.TRACKED, "patient_sk")
    kept.apply(person(spark, [("P1", None, "Rome")]), ts("2024-01-01"))
    for broken in ("replace_snapshot", "replace_text"):
        with monkeypatch.context() as m:
            m.setattr(scd2 if broken == "replace_snapshot" else tables, broken, lambda *a, **k: (_ for _ in ()).throw(RuntimeError("driver died")))
            with pytest.raises(RuntimeError):
                kept.apply(person(spark, [("P1", None, "Oslo")]), ts("2024-02-01"))
        assert [(r["city"], r["is_current"]) for r in kept.table().collect()] == [("Rome", True)]
    again = kept.apply(person(spark, [("P1", None, "Oslo")]), ts("2024-02-02")).collect()
    assert sorted((r["city"], r["is_current"], str(r["valid_to"] or "")) for r in again) == [("Oslo", True, ""), ("Rome", False, "2024-02-02 00:00:00")]
    # nothing new: nothing closes
    assert kept.apply(person(spark, [("P1", None, "Oslo")]), ts("2024-03-01")).count() == 2


def test_documents_are_ranked_once(spark, rows):
    """Both tables from one narrow ranking equal those that rank whole documents."""
    draw = random.Random(5)

    def documents(n, unique):
        out = []
        for i in range(n):
            e = draw.choice([f"E{draw.randrange(40)}", f"E{draw.randrange(40)}", None])
            text = '{"patient_id": "P%d", "start": "2024-01-0%dT00:00:00", "observations": [%s]%s}' % (
                i, 1 + i % 9, ", ".join('{"code": "c%d", "value": %d}' % (i, k) for k in range(draw.randrange(3))), '' if e is None else ', "encounter_id": "%s"' % e)
            load = draw.choice([None, "2024-02-01", "2024-02-02"])
            out.append((text, draw.choice(["a", "b", None]), i if unique else draw.randrange(4), load))
        return spark.createDataFrame(out, "t string, _source_file string, _file_row long, load string").select(
            F.parse_json("t").alias("v"), "_source_file", "_file_row", F.col("load").cast("timestamp_ntz").alias("_load_ts"))

    raw = documents(300, True)
    enc, obs = staging.stage_documents(raw)
    assert rows(enc) == rows(staging.stage_encounters(raw)) and rows(obs) == rows(staging.stage_observations(raw))
    for frame in (enc, obs):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and "SortMergeJoin" not in plan
    # repeated places, and none at all
    for other in (documents(300, False).cache(), raw.drop("_file_row"), raw.limit(0)):
        enc, obs = staging.stage_documents(other)
        assert enc.count() == staging.stage_encounters(other).count() and obs.columns == staging.stage_observations(other).columns


@pytest.mark.parametrize("batch", [1, 3])
def test_asof_over_small_batches(spark, rows, batch):
    """Versions are carried from batch to batch and from range to range, for hot, missing and NULL keys alike."""
    draw = random.Random(batch)
    versions = []
    for key in ("a", "b", "hot"):
        cuts = sorted(draw.sample(range(1000), 40 if key == "hot" else 3))
        versions += [(key, lo, hi, f"{key}{lo}") for lo, hi in zip(cuts, [*cuts[1:-1], None, None]) if hi is not None or lo == cuts[-2]]
    dim = spark.createDataFrame(versions, "k string, valid_from int, valid_to int, sk string")
    facts = spark.createDataFrame([(i, draw.choice(["a", "hot", "hot", "none", None]), draw.choice([None, *range(0, 1001, 7)])) for i in range(400)], "id int, k string, t int")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = [rows(asof_join(facts, dim, "k", "t", payload=["sk"], many_versions=many)) for many in (True, False)]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got[0] == got[1] and len(got[0]) == 400 and sum(r[3] is not None for r in got[0]) > 150

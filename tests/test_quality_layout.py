import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import layout, quality, tables
from millrace.sources import synth


def test_checks_and_gate(spark, rows):
    fact = spark.createDataFrame([(1, 10.0, 5.0), (9, 1.0, 2.0), (None, None, None)], "fk bigint, charge double, paid double")
    dim = spark.createDataFrame([(1,), (2,)], "sk bigint")
    report = quality.dq_gate([
        quality.row_checks(fact, {"set": quality.is_missing("fk"), "paid": F.col("paid") > F.col("charge")}),
        quality.check_fk("fk", fact, "fk", dim, "sk"),
        quality.check_fk("fk strict", fact, "fk", dim, "sk", null_ok=False),
        quality.check_unique("unique", fact.unionByName(fact), ["fk"]),
        quality.check_unique("unique but null", fact.unionByName(fact), ["fk"], skip_null=True),
        quality.check_unique("fine", dim, ["sk"]),
    ])
    got = {r["check"]: (r["violations"], r["status"]) for r in report.collect()}
    assert got == {"set": (1, "FAIL"), "paid": (1, "FAIL"), "fk": (1, "FAIL"), "fk strict": (2, "FAIL"), "unique": (3, "FAIL"),
                   "unique but null": (2, "FAIL"), "fine": (0, "PASS")}
    with pytest.raises(quality.QualityError):
        quality.enforce(report)
    quality.enforce(report.filter("check = 'fine'"))


def test_patterns_ignore_null(spark):
    df = spark.createDataFrame([("XXX-XX-1234",), (None,), ("1",), ("",)], "s string")
    got = quality.row_checks(df, {"p": quality.not_like("s", "XXX-XX-%"), "a": quality.not_in("s", ["1", ""])})
    assert {r["check"]: r["violations"] for r in got.collect()} == {"p": 2, "a": 1}


def test_depth_against_brute_force(spark):
    rnd = random.Random(4)
    spans = []
    for i in range(200):
        a = rnd.randrange(100)
        spans.append((f"f{i}", a, a + rnd.choice([0, 0, 1, 30])))
    ranges = spark.createDataFrame(spans, "file string, low bigint, high bigint")
    got = layout.clustering_depth(ranges).first()
    want = sum(sum(a <= y and x <= b for _, x, y in spans) for _, a, b in spans) / len(spans)
    assert got["n_files"] == 200 and abs(got["avg_depth"] - want) < 1e-9


def test_sorted_layout_is_pruned_even_with_a_hot_key(spark, tmp_path):
    df = spark.range(20000).select(F.when(F.col("id") % 3 == 0, 50).otherwise(F.pmod(F.xxhash64("id"), F.lit(100))).alias("k"), "id")
    report = {r["layout"]: r for r in layout.layout_report(df, "k", 16, 10, 12, str(tmp_path / "l")).collect()}
    assert report["random"]["scanned"] == report["random"]["total"] == 16 and report["random"]["avg_depth"] == 16.0
    assert report["sorted"]["scanned"] <= 2 and report["sorted"]["avg_depth"] < 4
    assert spark.read.parquet(str(tmp_path / "l" / "sorted")).exceptAll(df.select("k", "id")).count() == 0
    sizes = layout.file_ranges(spark, str(tmp_path / "l" / "sorted"), "k").agg(F.max("n_rows"), F.sum("n_rows")).first()
    assert sizes[1] == 20000 and sizes[0] < 20000 / 3


def test_files_scanned(spark, tmp_path):
    tables.write_sorted(spark.range(1000), ["id"], 10, str(tmp_path / "t"))
    got = layout.files_scanned(layout.file_ranges(spark, str(tmp_path / "t"), "id"), 5000, 6000).first()
    assert (got["scanned"], got["total"]) == (0, 10)


@pytest.mark.parametrize("partitions", [1, 7])
def test_generator(spark, partitions, rows):
    people = synth.ids(spark, 20).repartition(partitions)
    patients, visits = synth.synth_patients(people, 7), synth.synth_encounters(people, 7)
    assert rows(patients) == rows(synth.synth_patients(synth.ids(spark, 20), 7)) != rows(synth.synth_patients(people, 8))
    ids = [r[0] for r in patients.select("patient_id").collect()]
    assert len(set(ids)) == 20
    found = visits.collect()
    assert {v["patient_id"] for v in found} == set(ids) and len({v["encounter_id"] for v in found}) == len(found)
    per = {}
    for v in found:
        per[v["patient_id"]] = per.get(v["patient_id"], 0) + 1
        codes = [o["code"] for o in v["observations"]]
        assert 1 <= len(codes) <= 6 and len(set(codes)) == len(codes) and len(v["conditions"]) <= 1
        catalogue = {c: (lo, hi) for c, _, _, lo, hi in synth.OBSERVATIONS}
        assert all(catalogue[o["code"]][0] <= o["value"] <= catalogue[o["code"]][1] for o in v["observations"])
        b = v["billing"]
        assert (b["paid_amount"] == 0) == (b["claim_status"] == "denied") and b["paid_amount"] <= b["total_charge"]
        assert v["start"] < v["stop"]
    assert all(1 <= n <= 6 for n in per.values())

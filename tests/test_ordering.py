import random
from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from millrace.functions.ordering import hwm_filter, hwm_gt, hwm_key
from millrace.operators.positions import assign_ids, hwm_chunks, running_total, with_rank


def test_digit_boundary(spark, rows):
    df = spark.createDataFrame([(str(i),) for i in range(7, 13)], "id string")
    assert rows(hwm_filter(df, "id", "9", text_order=True)) == [("10",), ("11",), ("12",)]


def test_numbers_before_text_and_odd_numbers_are_text(spark):
    marks = ["b", "10", "9", "10d", "-1", "1e1", "0x10", " 8 ", "a", "1_0", "NaN"]
    df = spark.createDataFrame([(m,) for m in marks], "m string")
    got = [r[0] for r in df.orderBy(hwm_key("m"), "m").collect()]
    assert got[:5] == ["-1", " 8 ", "9", "10", "1e1"] and got[5:] == ["0x10", "10d", "1_0", "NaN", "a", "b"]


def test_equal_numbers_are_not_after_each_other(spark):
    df = spark.createDataFrame([("10.0",), ("10",), (None,), ("11",)], "m string")
    assert [r[0] for r in df.filter(hwm_gt("m", "10")).collect()] == ["11"]


@pytest.mark.parametrize("type_,values,since,want", [
    ("bigint", [1, 2, 3, None], 2, 1),
    ("timestamp_ntz", [datetime(2024, 1, 1), datetime(2024, 1, 2, 0, 0, 0, 5)], datetime(2024, 1, 2), 1),
    ("date", [date(2024, 1, 1), date(2024, 1, 2)], date(2024, 1, 1), 1),
    ("string", ["a", "b"], None, 2),
])
def test_typed_marks(spark, type_, values, since, want):
    df = spark.createDataFrame([(v,) for v in values], f"m {type_}")
    assert hwm_filter(df, "m", since).count() == want


def test_missing_mark_column(spark):
    with pytest.raises(ValueError):
        hwm_filter(spark.range(1), "nope", 1)


def test_typed_filter_reaches_parquet(spark, tmp_path):
    spark.range(100).write.parquet(str(tmp_path / "t"))
    plan = hwm_filter(spark.read.parquet(str(tmp_path / "t")), "id", 50)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(id,50)" in plan


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_running_total_and_ranks(spark, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        values = random.Random(3).sample(range(10000), 500)
        df = spark.createDataFrame([(v, v % 7) for v in values], "k bigint, w bigint")
        got = {r["k"]: (r["t"], r["n"]) for r in running_total(df, ["k"], {"t": F.col("w"), "n": F.lit(1)}).collect()}
        total = 0
        for n, v in enumerate(sorted(values), 1):
            total += v % 7
            assert got[v] == (total, n)
        assert [r["id"] for r in assign_ids(df, ["k"], "id", 11).orderBy("k").collect()] == list(range(11, 511))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_rank_of_nothing(spark):
    assert with_rank(spark.range(0), ["id"]).count() == 0


def test_chunks_with_one_mark_holding_most_rows(spark):
    rnd = random.Random(5)
    marks = [7] * 400 + [rnd.randrange(100) for _ in range(600)]
    df = spark.createDataFrame(list(enumerate(marks)), "id bigint, m bigint")
    got = hwm_chunks(df, "m", 50).collect()
    ordered = sorted(marks)
    first = {}
    for i, m in enumerate(ordered):
        first.setdefault(m, i // 50)
    assert len(got) == 1000 and all(r["chunk_id"] == first[r["m"]] for r in got)
    last = {}
    for m in ordered:
        last[first[m]] = m
    assert all(r["chunk_hwm"] == last[r["chunk_id"]] for r in got)


def test_batches_of_two(spark):
    df = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (3, "c", 30), (4, "d", 40)], "id bigint, name string, ts bigint")
    sizes = Counter(r["chunk_id"] for r in hwm_chunks(df, "ts", 2).collect())
    assert sorted(sizes.values()) == [2, 2]

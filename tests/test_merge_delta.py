"""A delta applied to a table: which rows come, and how often the view is read."""

from millrace.operators import merge


def test_apply_delta_reads_its_view_once(spark, rows, tmp_path):
    schema = "k string, n int"
    for name, held in (("view", [("a", 1), ("b", 2), ("c", 3), ("d", 4), (None, 5)]), ("target", [("a", 10), ("a", 11), (None, 12)])):
        spark.createDataFrame(held, schema).write.parquet(f"{tmp_path}/{name}")
    view, target = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("view", "target"))
    delta = spark.createDataFrame([("a", 0), ("b", 0), ("b", 1), ("d", 0), ("e", 0), (None, 0)], "k string, other int")
    out = merge.apply_delta(view, delta, target, ["k"])
    # twice before: once for its keys, once for its rows
    assert out._jdf.queryExecution().sparkPlan().toString().count(f"{tmp_path}/view") == 1
    # keys of the target stay as they are, a key of the delta comes once, one without a key never
    assert rows(out) == sorted([("a", 10), ("a", 11), (None, 12), ("b", 2), ("d", 4)], key=repr)
    assert rows(merge.apply_delta(view, delta, target, ["k"], ["n"])) == sorted([("a", 1), ("a", 1), (None, 12), ("b", 2), ("d", 4)], key=repr)

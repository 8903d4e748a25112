import random
from collections import defaultdict

from pyspark.sql import functions as F

from millrace.llm import sharding


def shards(spark, rows, limit, extra=False):
    df = spark.createDataFrame(rows, "id string, n long, x int")
    if extra:
        df = df.withColumn("shard", F.lit("mine")).withColumn("Depth", F.lit(1))
    return sharding.assign(df, "id", F.col("n"), limit)


def check(found, limit):
    total = defaultdict(int)
    for r in found:
        total[r["shard"], r["page"]] += r["row_bytes"]
    for r in found:
        assert r["shard_bytes"] == total[r["shard"], r["page"]]
        assert r["shard_bytes"] <= limit or (r["page"] == -1 and r["row_bytes"] > limit)
    return total


def test_fits_and_is_minimal(spark):
    draw = random.Random(3)
    rows = [(str(i), draw.randrange(1, 100), 0) for i in range(800)] + [("big", 5000, 0)]
    found = shards(spark, rows, 1000).collect()
    assert len(found) == len(rows)
    total = check(found, 1000)
    bits = {s for s, p in total if p == 0}
    for s in bits:
        # the parent held too much, and no shard is a prefix of another
        if s:
            assert sum(v for (o, p), v in total.items() if p == 0 and o.startswith(s[:-1])) > 1000
        assert not any(o != s and o.startswith(s) for o in bits)


def test_one_key_with_most_rows_is_paged(spark):
    rows = [("hot", 60 + i % 7, i) for i in range(300)] + [("hot", 700, 1)] * 3 + [(str(i), 50, 0) for i in range(100)]
    found = shards(spark, rows, 1000).collect()
    assert len(found) == len(rows)
    check(found, 1000)
    assert len({r["page"] for r in found if r["id"] == "hot"}) > 20


def test_nulls_empty_and_clashing_names(spark):
    found = shards(spark, [(None, None, 1), ("", 3, 2), ("a", None, 3)], 10, extra=True)
    assert sorted(found.columns) == sorted(["id", "n", "x", "shard", "depth", "page", "row_bytes", "shard_bytes"])
    assert {(r["x"], r["row_bytes"], r["shard_bytes"], r["shard"]) for r in found.collect()} == {(1, 0, 3, ""), (2, 3, 3, ""), (3, 0, 3, "")}
    assert shards(spark, [], 10).count() == 0


def test_written_shards(spark, tmp_path):
    rows = [(str(i), 10, i) for i in range(100)]
    sharding.write_shards(shards(spark, rows, 200), str(tmp_path / "out"))
    back = spark.read.option("recursiveFileLookup", "false").parquet(str(tmp_path / "out"))
    assert back.count() == 100
    folders = [p for p in (tmp_path / "out").glob("shard=*/page=*")]
    assert folders and all(len(list(f.glob("*.parquet"))) == 1 for f in folders)


def test_rows_over_the_limit_are_shards_of_their_own(spark):
    """Several of one key, equal ones too."""
    found = shards(spark, [("k", 300, 1), ("k", 400, 2), ("k", 400, 2), ("k", 5, 3), ("l", 101, 4)], 100).collect()
    apart = [r for r in found if r["row_bytes"] > 100]
    assert len({(r["shard"], r["page"]) for r in apart}) == 4 and all(r["page"] < 0 and r["shard_bytes"] == r["row_bytes"] for r in apart)
    assert [(r["page"], r["shard_bytes"]) for r in found if r["row_bytes"] == 5] == [(0, 5)]


def test_equal_rows_of_one_key_fill_several_ranges(spark):
    """Copies in every column are told apart by where they were written."""
    df = spark.createDataFrame([("hot", 50, 1)] * 600 + [(str(i), 50, 0) for i in range(100)], "id string, n long, x int")
    assert sharding._tied(df.select(F.struct("*").alias("_row"), F.lit(0).alias("_h"), F.lit(50).alias("_b"))).select("_h", "_tie", "_copy").distinct().count() == 700
    found = sharding.assign(df, "id", F.col("n"), 1000).collect()
    assert len(found) == 700
    check(found, 1000)


def test_shards_read_back(spark, tmp_path):
    """Names with leading zeros and the root's empty name come back, also pages of a hot key and rows over the limit."""
    for limit in (100, 10_000):
        rows = [(str(i), 10, i) for i in range(60)] + [("hot", 30, i) for i in range(40)] + [("big", 5000, 0), (None, None, 1)]
        assigned = shards(spark, rows, limit)
        path = str(tmp_path / f"out{limit}")
        sharding.write_shards(assigned, path)
        back = sharding.read_shards(spark, path, assigned.schema)
        names = ["id", "n", "x", "shard", "depth", "page", "row_bytes", "shard_bytes"]
        assert back.columns == assigned.columns
        # pages depend on which copy comes first; what a shard holds does not
        given, got = ({(tuple(r[c] for c in ("id", "n", "x", "shard"))) for r in f.collect()} for f in (assigned, back))
        assert given == got and back.count() == len(rows)
        check(back.select(*names).collect(), limit)
    nothing = shards(spark, [], 10)
    sharding.write_shards(nothing, str(tmp_path / "none"))
    assert sharding.read_shards(spark, str(tmp_path / "none"), nothing.schema).count() == 0

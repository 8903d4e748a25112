import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import ann, topk


def brute(rows, step, k, keep, change=lambda v: v):
    good = [(i, change(np.array(v, dtype=np.float32).astype(float))) for i, v in rows if i is not None and keep(v)]
    ids, x = [i for i, _ in good], np.array([v for _, v in good])
    out = {}
    for j, i in enumerate(ids):
        if i % step == 0:
            s = x @ x[j]
            order = sorted((a for a in range(len(ids)) if ids[a] != i), key=lambda a: (-s[a], ids[a]))[:k]
            out[i] = [(ids[a], s[a]) for a in order]
    return out


def finite(v):
    return v is not None and len(v) == 8 and all(x is not None and np.isfinite(x) for x in v)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((40, 8)) * 2
    found = [(i, (centres[i % 40] + 0.3 * rng.standard_normal(8)).tolist()) for i in range(1500)]
    found += [(2000 + i, [0.5] * 8) for i in range(700)]  # one vector with many copies
    found += [(3000, None), (3020, []), (3040, [float("nan")] * 8), (3060, [float("inf")] * 8), (3080, [None] * 8), (3100, [0.0] * 8), (3120, [1.0] * 7), (None, [1.0] * 8)]
    return found


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("vid", F.lit(1)).withColumn("score", F.lit("x"))


def answers(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_exact_top_k(table, rows, monkeypatch):
    monkeypatch.setattr(topk.vectors, "BLOCK", 64)
    whole = lambda x: F.floor(F.lit(256) * x).cast("double")
    got = answers(topk.exact_top_k(table, F.col("id") % 50 == 0, 5, component=whole, score=F.col("score").cast("bigint")))
    assert got == brute(rows, 50, 5, finite, lambda v: np.floor(256 * v))


def test_bounds_hold_and_prune(spark, rows):
    from millrace.llm import vectors

    found = vectors.distinct(vectors.usable(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), "vec_id", "embedding"), 5)
    norm = max(np.linalg.norm(r["vec"]) for r in found.collect())
    centres = topk.pivots(vectors.lifted(vectors.sample(found), norm))
    blocks = topk.index(found, centres, norm)
    queries = found.limit(5).select(F.col("vid").alias("qid"), "vec")
    packed = {}
    for b in blocks.collect():
        packed.setdefault(b["unit"], []).append(np.frombuffer(b["vecs"]).reshape(-1, 8))
    packed = {u: np.vstack(parts) for u, parts in packed.items()}
    assert sum(map(len, packed.values())) == found.count()
    asked = {q["qid"]: np.array(q["vec"]) for q in queries.collect()}
    for r in topk.bounds(blocks, queries, centres, norm).collect():
        assert (packed[r["unit"]] @ asked[r["qid"]]).max() <= r["bound"]


def test_recall_of_posting_lists(table, rows):
    want = brute(rows, 20, 10, lambda v: finite(v) and any(v))
    got = answers(ann.nearest(table, F.col("id") % 20 == 0, 10, size=64, beam=16))
    assert set(got) == set(want)
    recall = np.mean([len({a for a, _ in got[q]} & {a for a, _ in want[q]}) / len(want[q]) for q in want])
    assert recall >= 0.9
    exact = {(q, i): s for q, found in want.items() for i, s in found}
    assert all(abs(exact.get((q, i), s) - s) < 1e-9 for q, found in got.items() for i, s in found)


def test_graph_search_finds_the_nearest():
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((300, 6))
    graph = ann.Graph(centres)
    x = rng.standard_normal((100, 6))
    ids, dist = graph.search(x, 24)
    true = ((x[:, None] - centres[None]) ** 2).sum(axis=2)
    assert (ids[:, 0] == true.argmin(axis=1)).mean() > 0.95
    assert all(len(set(r[r >= 0])) == (r >= 0).sum() for r in ids)
    assert (np.diff(dist, axis=1) >= 0).all()


def test_few_rows_and_empty_table(spark):
    schema = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0, 0.0]), (100, [1.0, 0.0]), (3, [0.5, 0.5])], schema)
    want = {0: [(100, 1.0), (3, 0.5)], 100: [(0, 1.0), (3, 0.5)]}
    assert answers(topk.exact_top_k(few, F.col("id") % 50 == 0, 5)) == want
    assert answers(ann.nearest(few, F.col("id") % 20 == 0, 20)) == want
    for rows in ([], [(0, [1.0])], [(0, None)]):
        df = spark.createDataFrame(rows, schema)
        assert topk.exact_top_k(df, F.col("id") % 50 == 0, 5).count() == 0
        assert ann.nearest(df, F.col("id") % 20 == 0, 20).count() == 0


def test_a_lone_group_is_posted_where_it_is_looked_for(spark):
    rng = np.random.default_rng(6)
    crowd = rng.standard_normal((2000, 8)) * 0.1
    lone = 5 + 0.01 * rng.standard_normal((40, 8))
    rows = [(i, v.tolist()) for i, v in enumerate(np.vstack([crowd, lone]))]
    got = answers(ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("id") % 20 == 0, 10, size=16, beam=32))
    want = brute(rows, 20, 10, finite)
    assert all(len(got[q]) == 10 for q in want)
    assert np.mean([len({a for a, _ in got[q]} & {a for a, _ in want[q]}) / 10 for q in want]) >= 0.9


def test_more_lists_than_the_beam(spark):
    rng = np.random.default_rng(8)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((3000, 8 * 4)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = answers(ann.nearest(df, F.col("id") % 20 == 0, 10, size=12, beam=16))
    want = brute(rows, 20, 10, lambda v: True)
    assert np.mean([len({a for a, _ in got[q]} & {a for a, _ in want[q]}) / 10 for q in want]) >= 0.95


def test_lists_are_read_until_they_hold_enough(spark):
    rng = np.random.default_rng(9)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((1200, 4)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = answers(ann.nearest(df, F.col("id") % 20 == 0, 200, size=5, beam=8, ratio=1.0))
    assert len(got) == 60 and all(len(found) == 200 for found in got.values())


def test_a_search_measures_a_bounded_number_of_centroids_at_once(monkeypatch):
    # a centroid in the middle of others that lie far from each other is among the nearest of all
    n = 3000
    around = np.eye(n)[:, :n - 1][:n - 1]
    hub = ann.Graph(np.vstack([around, np.full((1, n - 1), 1.0 / (n - 1))]))
    assert hub.links.shape[1] > n // 2 and hub.at_once() * hub.links.shape[1] <= ann.MEASURED
    assert ann.Graph(np.random.default_rng(1).normal(size=(64, 8))).at_once() == 512
    # and is made from a bounded number of rows of distances
    centres = np.random.default_rng(2).normal(size=(300, 8))
    made, squared = [], ann._squared
    monkeypatch.setattr(ann, "ROWS", 100)
    monkeypatch.setattr(ann, "_squared", lambda a, b: made.append(len(a)) or squared(a, b))
    graph = ann.Graph(centres)
    assert made == [100] * 3 and np.allclose(graph.apart, ((centres[:, None] - centres[None]) ** 2).sum(axis=2))


def test_what_is_read_once_is_not_written(spark, monkeypatch):
    from millrace.llm import vectors

    written = []
    for module in (ann, vectors):
        monkeypatch.setattr(module, "materialize", lambda df, label, *a, f=module.materialize, **b: written.append(label) or f(df, label, *a, **b))
    x = np.random.default_rng(3).normal(size=(200, 4)).tolist()
    df = spark.createDataFrame(list(enumerate(x)), "vec_id long, embedding array<double>")
    assert ann.nearest(df, F.col("id") % 20 == 0, 5, size=20).count() == 50
    assert "top" in written and not {"reached", "lists"} & set(written)

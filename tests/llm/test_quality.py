import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from millrace.llm import quality


def corpus(n=900):
    draw = random.Random(7)
    words = ["the", "stream", "Water", "runs", "over", "stones.", "and", "light", "falls,", "quietly"]
    docs, labels = [], []
    for i in range(n):
        length = draw.randrange(5, 200)
        if i % 3 == 0:
            kind = draw.randrange(3)
            text = [" ".join(["spam"] * length), " ".join(w.upper() + "!!" for w in draw.choices(words, k=length)), " ".join(w + "###" for w in draw.choices(words, k=length))][kind]
        else:
            text = " ".join(draw.choices(words, k=length))
        docs.append((i, text))
        labels.append((i, 0 if i % 3 == 0 else 1))
    return docs, labels


def test_statistics():
    x = quality.statistics(pa.array(["Ab cd cd!\n", "", "é | #x 12"]))
    assert x.shape == (3, quality.STATISTICS)
    assert np.allclose(x[0], [np.log(4), 7 / 3, 1 / 6, 0, 0, 0, 1 / 3, 0, 1 / 3, 0, 1, 0, 0])
    assert x[1].tolist() == [0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 1]
    assert np.allclose(x[2][[3, 4, 5, 11]], [2 / 10, 1 / 4, 1 / 4, 2 / 10])
    assert quality.statistics(pa.array([], pa.string())).shape == (0, quality.STATISTICS)
    # repeated neighbours, not repeats elsewhere
    assert quality.statistics(pa.array(["a a a b a"]))[0, 9] == 2 / 5


def test_isotonic_is_the_least_squares_monotone_fit():
    y = [0.0, 1, 0, 0, 1, 0, 1, 1]
    at, level = quality.isotonic(list(range(8)), [1] * 8, y)
    assert (np.diff(level) >= 0).all()
    fitted = np.interp(range(8), at, level)
    assert np.allclose(fitted, [0, 1 / 3, 1 / 3, 1 / 3, 0.5, 0.5, 1, 1])


def test_held_out_accuracy_and_no_leak(spark):
    docs, labels = corpus()
    d = spark.createDataFrame(docs, "doc_id long, text string")
    # held-out labels are turned around: a fit that read them would show it
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 4 == 2 else q) for i, q in labels]
    lab = spark.createDataFrame([*turned, (None, 1), (5000, None)], "doc_id long, quality int")
    found = d.select("doc_id", quality.text_statistics(F.col("text")).alias("stats"))
    model = quality.fit(found, lab)
    got = {r["doc_id"]: r["s"] for r in found.select("doc_id", quality.scores(model, F.col("stats")).alias("s")).collect()}
    truth = dict(labels)
    held = [i for i in got if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([(got[i] >= 0.7) == truth[i] for i in held]) > 0.95
    assert all(0 <= s <= 1 for s in got.values())
    flags = d.select("doc_id", quality.held_out(F.col("doc_id")).alias("h")).collect()
    assert {r["doc_id"] for r in flags if r["h"]} == set(held)


def test_filter_keeps_columns_and_survives_odd_input(spark):
    docs, labels = corpus(300)
    rows = [*docs, (900, None), (901, ""), (None, "the stream runs over stones.")] + [docs[1]]
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_score", F.lit(1)).withColumn("stats", F.lit("s"))
    kept = quality.keep_good(d, spark.createDataFrame(labels, "doc_id long, quality int"))
    assert kept.columns == d.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(1) == 2 and None in ids
    assert quality.keep_good(d.limit(0), spark.createDataFrame(labels, "doc_id long, quality int")).count() == 0


def test_no_labels_score_a_half(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string").select("doc_id", quality.text_statistics(F.col("text")).alias("stats"))
    model = quality.fit(d, spark.createDataFrame([], "doc_id long, quality int"))
    assert [r["s"] for r in d.select(quality.scores(model, F.col("stats")).alias("s")).collect()] == [0.5]


def test_fit_equals_a_direct_solution(spark):
    """Weights, folds and calibration of the query against one dense solve over all labelled rows."""
    import zlib

    draw = np.random.default_rng(6)
    rows = [(i, [float(v) for v in draw.standard_normal(quality.STATISTICS) + (i % 3 == 0)]) for i in range(600)]
    labels = [(i, int(i % 3 == 0) if i % 7 else None) for i in range(0, 600, 2)]
    found = spark.createDataFrame(rows, "doc_id long, stats array<double>")
    model = quality.fit(found, spark.createDataFrame(labels, "doc_id long, quality int"))
    taught = [(i, q) for i, q in labels if q is not None and zlib.crc32(str(i).encode()) % 4 != 2]
    x, y = np.array([rows[i][1] for i, _ in taught]), np.array([q for _, q in taught], dtype=float)
    assert np.allclose(model.centre, x.mean(axis=0)) and np.allclose(model.scale, x.std(axis=0))
    z = quality.cosines(x, x.mean(axis=0), x.std(axis=0))
    want = np.linalg.solve(z.T @ z + quality.RIDGE * np.eye(z.shape[1]), z.T @ y)
    assert np.allclose(model.weights, want, atol=1e-8)
    # the curve rises, and its pools are the shares of label 1 among out-of-fold scores
    assert (np.diff(model.at) >= 0).all() and (np.diff(model.level) >= 0).all() and 0 <= model.level.min() and model.level.max() <= 1
    got = found.select("doc_id", quality.scores(model, found["stats"]).alias("score")).collect()
    raw = quality.cosines(np.array([r[1] for r in rows]), model.centre, model.scale) @ want
    assert np.allclose([r["score"] for r in sorted(got)], np.clip(np.interp(raw, model.at, model.level), 0, 1), atol=1e-6)


def test_only_summed_equations_reach_the_driver(spark, monkeypatch):
    docs, labels = corpus(300)
    found = spark.createDataFrame(docs, "doc_id long, text string").select("doc_id", quality.text_statistics(F.col("text")).alias("stats"))
    lab = spark.createDataFrame(labels, "doc_id long, quality int")
    sent, collect = [], type(found).collect

    def counted(frame):
        rows = collect(frame)
        sent.append(sum(len(v) for r in rows for v in r if isinstance(v, (bytes, bytearray))))
        return rows

    monkeypatch.setattr(type(found), "collect", counted)
    models = [quality.fit(found, lab) for _ in range(2)]
    size = quality.COSINES + 1
    # the matrices of one part, not of all
    assert max(sent) == quality.FOLDS * size * (size + 1) * 8
    assert all((getattr(models[0], f) == getattr(models[1], f)).all() for f in ("weights", "at", "level"))

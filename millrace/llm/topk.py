"""Exact top-k by inner product over a pivot-distance index.

One more component makes all vectors equally long, so the largest inner product is the nearest
vector. Each vector is keyed by its nearest pivot and the distance to it and stored in that order, in
blocks: an annulus each. For a query at distance d from a pivot, every vector of an annulus [low,
high] around it lies at least max(low - d, d - high) away (triangle inequality), which bounds its
score from above. A query first scans the annuli with the best bounds, then wider and wider sets of
those whose bound still reaches its k-th score, until none is left: the result is exact whatever the
pivots are. Bounds allow for rounding; scores are the plain inner products.

Defined results: vectors that are null, empty, of unusual length or hold null or non-finite numbers
take no part; fewer candidates than k give fewer rows; copies are ranked by id; an empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize, ship_package
from . import vectors

PIVOTS = 16
WIDTHS = (2, 16)


def pivots(sample: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """Rows far from each other: each next one is the farthest from those chosen."""
    if not len(sample):
        return sample
    chosen = [0]
    near = np.linalg.norm(sample - sample[0], axis=1)
    while len(chosen) < n and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, np.linalg.norm(sample - sample[chosen[-1]], axis=1))
    return sample[chosen]


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.linalg.norm(x[:, None, :] - centres[None, :, :], axis=2)


def index(found: DataFrame, centres: np.ndarray, norm: float) -> DataFrame:
    """Blocks by (`pivot`, distance), each with the bounds of its annulus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                d = _distances(vectors.lifted(vectors.matrix(batch.column(1)), norm), centres)
                near = d.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(near.astype(np.int64)), pa.array(d[np.arange(len(d)), near])], ["vid", "vec", "pivot", "distance"]
                )

    keyed = found.select("vid", "vec").mapInArrow(run, "vid long, vec array<double>, pivot long, distance double")
    return vectors.in_units(vectors.pack(materialize(keyed, "keyed"), ["pivot", "distance", "vid"], "distance"), "pivot")


def _to_pivots(queries: DataFrame, centres: np.ndarray) -> DataFrame:
    """(`qid`, `pivot`, `d`, `own`): distance to each pivot and squared length of each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                q = vectors.matrix(batch.column(1))
                d = _distances(np.hstack([q, np.zeros((len(q), 1))]), centres)
                n, m = d.shape
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(batch.column(0).to_numpy(zero_copy_only=False), m)), pa.array(np.tile(np.arange(m), n)), pa.array(d.ravel()),
                    pa.array(np.repeat(np.einsum("ij,ij->i", q, q), m)),
                ], ["qid", "pivot", "d", "own"])

    return queries.select("qid", "vec").mapInArrow(run, "qid long, pivot long, d double, own double")


def bounds(blocks: DataFrame, queries: DataFrame, centres: np.ndarray, norm: float) -> DataFrame:
    """(`qid`, `unit`, `bound`): no vector of the unit scores above `bound` for the query."""
    directory = blocks.groupBy("unit", "pivot").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    both = _to_pivots(queries, centres).join(directory, "pivot")
    apart = F.greatest(F.col("low") - F.col("d"), F.col("d") - F.col("high"), F.lit(0.0))
    whole = F.col("own") + F.lit(norm * norm)
    return both.select("qid", "unit", ((whole - apart * apart) / 2 + whole * 1e-9).alias("bound"))


def exact_top_k(
    rows: DataFrame, asking: Column, k: int, id_col: str = "vec_id", vec_col: str = "embedding", component=None, score: Column | None = None,
) -> DataFrame:
    """The k largest inner products of every row for which `asking` (over `id`) holds, among all other rows:
    `query_id`, `rank`, `vec_id`, `score`."""
    ship_package(rows.sparkSession, "millrace")
    clean = materialize(vectors.usable(rows, id_col, vec_col, component), "usable")
    found = vectors.distinct(clean, k)
    norm = float(found.agg(F.max(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))).first()[0] or 0.0) ** 0.5
    ask = clean.filter(asking)
    queries = materialize(ask.select("vec").distinct().withColumn("_h", F.xxhash64("vec")).join(found.withColumn("_h", F.xxhash64("vec")), ["_h", "vec"]).select(F.col("vid").alias("qid"), "vec"), "queries")
    centres = pivots(vectors.lifted(vectors.sample(found), norm))
    shown = F.col("score") if score is None else score
    if not len(centres):
        empty = found.select(F.col("vid").alias("qid"), "vid", F.lit(0.0).alias("score"))
        return vectors.answer(ask, found, empty, k, shown)

    blocks = index(found, centres, norm)
    left = materialize(bounds(blocks, queries, centres, norm), "bounds")
    top = reached = None
    for width in (*WIDTHS, None):
        if top is not None:
            reached = materialize(vectors.kth(top, k), "reached")
            left = left.join(reached, "qid", "left").filter(F.col("reached").isNull() | (F.col("bound") >= F.col("reached"))).drop("reached")
        if width:
            place = F.row_number().over(W.partitionBy("qid").orderBy(F.desc("bound"), "unit"))
            placed = materialize(left.withColumn("_place", place), "left")
            now, left = placed.filter(F.col("_place") <= width), placed.filter(F.col("_place") > width).drop("_place")
        else:
            now = left = materialize(left, "left")
        if now.isEmpty():
            break
        scanned = vectors.scan(blocks, now.select("unit", "qid"), queries, k + 1, reached)
        top = materialize(vectors.best(scanned if top is None else scanned.unionByName(top), k + 1), "top")
    return vectors.answer(ask, found, top, k, shown)

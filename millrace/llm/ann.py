"""Approximate nearest neighbours over balanced posting lists.

Centroids come from a bounded sample, cut in halves at the median along its main direction until the
lists have their size, so lists are balanced by construction. They are searched by a graph in memory:
each centroid knows its nearest ones, and a beam of the best candidates so far is widened until it
holds no unvisited one. A vector is posted to its nearest centroid and, near a boundary, to further
ones that are almost as near and lie in other directions (relative neighbourhood rule), so a query
that falls on the other side still meets it. A query reads all lists whose centroids are within a
ratio of the distance at which the nearest one's vectors lie, and further ones until they hold k + 1 vectors: its beam widens until
both hold, and beyond `WIDEST` all centroids are measured. Posted vectors lie in blocks of bounded size, so a list may hold
any share of the data. Inner products become distances by one more component (`vectors.lifted`).

Every vector is indexed; the sample only places centroids. Recall against brute force is in the
tests and the README. Defined results: as for `topk`, and zero vectors take no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, ship_package
from . import vectors

LIST = 1024
MOST_LISTS = 4096
COPIES = 4
NEAR = 1.15
RATIO = 1.3
DEGREE = 16
BEAM = 64
WIDEST = 256
STEP = 4
# centroids that a search measures at once, and rows of the centroids' distances that a graph is made of at once
MEASURED, ROWS = 512 * 64, 1024


def centroids(sample: np.ndarray, lists: int) -> tuple[np.ndarray, np.ndarray]:
    """`lists` (a power of two) means of equal shares of the sample, and the mean squared distance of each share to it."""
    groups = [sample]
    while len(groups) < lists and all(len(g) > 1 for g in groups):
        halves = []
        for g in groups:
            middle = g.mean(axis=0)
            # the main direction by a few power steps
            way = g[np.linalg.norm(g - middle, axis=1).argmax()] - middle
            for _ in range(8):
                way = (g - middle).T @ ((g - middle) @ way)
                way = way / max(np.linalg.norm(way), 1e-300)
            order = np.argsort((g - middle) @ way, kind="stable")
            halves += [g[order[:len(g) // 2]], g[order[len(g) // 2:]]]
        groups = halves
    return np.stack([g.mean(axis=0) for g in groups]), np.array([((g - g.mean(axis=0)) ** 2).sum(axis=1).mean() for g in groups])


class Graph:
    """Nearest-neighbour graph over centroids with a beam search for many points at once."""

    def __init__(self, centres: np.ndarray, degree: int = DEGREE):
        self.centres = centres
        n = len(centres)
        degree = min(degree, n)
        self.apart, near = np.empty((n, n)), np.empty((n, degree), dtype=np.int64)
        for at in range(0, n, ROWS):
            self.apart[at:at + ROWS] = _squared(centres[at:at + ROWS], centres)
            near[at:at + ROWS] = np.argsort(self.apart[at:at + ROWS], axis=1, kind="stable")[:, :degree]
        # far links keep the graph in one piece: every node also knows one of a ring through all
        ring = np.random.default_rng(5).permutation(n)
        follow = np.empty(n, dtype=np.int64)
        follow[ring] = np.roll(ring, -1)
        near = np.hstack([near, follow[:, None]])
        # both ways: a lone centroid is among nobody's nearest, but its own nearest lead back to it
        known = [set(row) for row in near.tolist()]
        for a, row in enumerate(near.tolist()):
            for b in row:
                known[b].add(a)
        width = max(map(len, known))
        self.links = np.array([[*sorted(k), *[a] * (width - len(k))] for a, k in enumerate(known)])
        self.entry = np.unique(np.linspace(0, n - 1, min(n, 8)).astype(np.int64))

    def at_once(self) -> int:
        """Rows to search together: a centroid that many others know has that many links, and each step of a row
        measures as many centroids as the longest of them."""
        return max(1, min(512, MEASURED // self.links.shape[1]))

    def search(self, x: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """Up to `beam` nearest centroids per row and their squared distances, nearest first; -1 where fewer were met."""
        rows, n = len(x), len(self.centres)
        beam = min(beam, n)
        far = np.inf
        met = np.zeros((rows, n), dtype=bool)
        met[:, self.entry] = True
        ids = np.full((rows, beam + 1), -1, dtype=np.int64)
        dist = np.full((rows, beam + 1), far)
        done = np.ones((rows, beam + 1), dtype=bool)

        def merge(new: np.ndarray, d: np.ndarray) -> None:
            nonlocal ids, dist, done
            every = np.hstack([ids, new]), np.hstack([dist, d]), np.hstack([done, ~np.isfinite(d)])
            order = np.argsort(every[1], axis=1, kind="stable")[:, :beam]
            ids, dist, done = (np.take_along_axis(e, order, axis=1) for e in every)

        start = np.tile(self.entry, (rows, 1))
        merge(start, self._measure(x, start))
        at = np.arange(rows)
        while True:
            open_ = np.where(done, far, dist)
            pick = open_.argmin(axis=1)
            going = np.isfinite(open_[at, pick])
            if not going.any():
                return ids, dist
            done[at, pick] = True
            new = np.where(going[:, None], self.links[np.maximum(ids[at, pick], 0)], 0)
            seen = np.take_along_axis(met, new, axis=1) | ~going[:, None]
            np.put_along_axis(met, new, np.take_along_axis(met, new, axis=1) | going[:, None], axis=1)
            # a node may stand twice among the links of one
            twice = np.zeros_like(seen)
            for j in range(1, new.shape[1]):
                twice[:, j] = (new[:, :j] == new[:, j:j + 1]).any(axis=1)
            merge(new, np.where(seen | twice, far, self._measure(x, new)))

    def reading(self, x: np.ndarray, homes: np.ndarray, spread: np.ndarray, least: int, ratio: float = RATIO, beam: int = BEAM) -> list[np.ndarray]:
        """Per row all centroids within `ratio` of the distance of the nearest one's vectors, and more until their `homes` add
        up to `least`; nearest first."""
        out: list[np.ndarray] = [np.zeros(0, dtype=np.int64)] * len(x)
        going, n = np.arange(len(x)), len(self.centres)
        while len(going):
            whole = beam >= n or beam > WIDEST
            if whole:
                dist = _squared(x[going], self.centres)
                ids = np.argsort(dist, axis=1, kind="stable")
                dist = np.take_along_axis(dist, ids, axis=1)
            else:
                ids, dist = self.search(x[going], beam)
            held = np.where(ids >= 0, homes[np.maximum(ids, 0)], 0)
            nearer = np.cumsum(held, axis=1) - held
            # a centroid between two groups is near where none of its vectors are: vectors lie at its distance plus its spread
            met = np.where(ids >= 0, dist + spread[np.maximum(ids, 0)], np.inf).min(axis=1, keepdims=True)
            # a query on top of a centroid would read that list alone, however few vectors it holds
            kept = (dist <= np.maximum(met, 0) * ratio * ratio) | (nearer < least) | (np.arange(ids.shape[1]) < STEP)
            ended = np.full(len(going), True) if whole else ~kept[:, -1]
            for i in np.flatnonzero(ended):
                out[going[i]] = ids[i, kept[i] & (ids[i] >= 0)]
            going, beam = going[~ended], beam * 4
        return out

    def _measure(self, x: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        c = self.centres[nodes]
        return np.einsum("ijk,ijk->ij", c, c) - 2 * np.einsum("ik,ijk->ij", x, c) + np.einsum("ik,ik->i", x, x)[:, None]


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(axis=1)[:, None] - 2 * a @ b.T + (b * b).sum(axis=1)[None, :], 0.0)


def postings(graph: Graph, x: np.ndarray, copies: int = COPIES, near: float = NEAR) -> list[np.ndarray]:
    """Lists of each row: the nearest, and others within `near` of its distance that no chosen centroid shields."""
    ids, dist = graph.search(x)
    limit = np.maximum(dist[:, :1], 0) * near * near
    out = []
    for row, d, most in zip(ids, dist, limit[:, 0], strict=True):
        chosen = [row[0]]
        for c, dc in zip(row[1:], d[1:], strict=True):
            if len(chosen) == copies or c < 0 or dc > most:
                break
            if (graph.apart[c, chosen] >= dc).all():
                chosen.append(c)
        out.append(np.array(chosen))
    return out


def _spread(frame: DataFrame, name: str, lists_of, centres: np.ndarray) -> DataFrame:
    """(`list`, `name`, `place`, `vec`) for every list that `lists_of(graph, vectors)` names, in its order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph = Graph(centres)
        most = graph.at_once()
        for batch in batches:
            for at in range(0, batch.num_rows, most):
                part = batch.slice(at, most)
                found = lists_of(graph, vectors.matrix(part.column(1)))
                row = np.repeat(np.arange(part.num_rows), [len(f) for f in found])
                place = np.concatenate([np.arange(len(f)) for f in found])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate(found).astype(np.int64)), part.column(0).take(pa.array(row)), pa.array(place), part.column(1).take(pa.array(row)),
                ], ["list", name, "place", "vec"])

    return frame.select(name, "vec").mapInArrow(run, f"list long, {name} long, place long, vec array<double>")


def nearest(
    rows: DataFrame, asking: Column, k: int, id_col: str = "vec_id", vec_col: str = "embedding", ratio: float = RATIO, beam: int = BEAM, size: int = LIST,
) -> DataFrame:
    """The k nearest found (largest inner product) of every row for which `asking` (over `id`) holds, among all
    other rows: `query_id`, `rank`, `vec_id`, `score`."""
    ship_package(rows.sparkSession, "millrace")
    clean = materialize(vectors.usable(rows, id_col, vec_col, zero=False), "usable")
    found = vectors.distinct(clean, k)
    n, square = found.agg(F.count(F.lit(1)), F.max(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))).first()
    ask = clean.filter(asking)
    known = found.withColumn("_h", F.xxhash64("vec"))
    queries = materialize(ask.select("vec").distinct().withColumn("_h", F.xxhash64("vec")).join(known, ["_h", "vec"]).select(F.col("vid").alias("qid"), "vec"), "queries")
    if not n:
        return vectors.answer(ask, found, found.select(F.col("vid").alias("qid"), "vid", F.lit(0.0).alias("score")), k, F.col("score"))

    norm = float(square) ** 0.5
    lists = min(MOST_LISTS, 1 << max(0, math.ceil(math.log2(n / size))))
    centres, spread = centroids(vectors.lifted(vectors.sample(found), norm), lists)

    def post(graph: Graph, x: np.ndarray) -> list[np.ndarray]:
        return postings(graph, vectors.lifted(x, norm))

    homes = np.zeros(len(centres), dtype=np.int64)

    def read(graph: Graph, x: np.ndarray) -> list[np.ndarray]:
        return graph.reading(np.hstack([x, np.zeros((len(x), 1))]), homes, spread, k + 1, ratio, beam)

    posted = materialize(_spread(found, "vid", post, centres), "postings")
    # every vector is at home in one list
    for r in posted.filter("place = 0").groupBy("list").count().collect():
        homes[r["list"]] = r["count"]
    blocks = vectors.in_units(vectors.pack(posted, ["list", "vid"]), "list")
    lookups = _spread(queries, "qid", read, centres).select("list", "qid", "place")
    wanted = materialize(lookups.join(blocks.select("list", "unit").distinct(), "list"), "wanted")
    top = reached = None
    low, high = 0, STEP
    while low < len(centres):
        # what the nearest lists hold sets the score that vectors of further ones must reach
        now = wanted.filter((F.col("place") >= low) & (F.col("place") < high)).select("unit", "qid")
        scanned = vectors.scan(blocks, now, queries, k + 1, reached)
        top = materialize(vectors.best(scanned if top is None else scanned.unionByName(top), k + 1), "top")
        reached = vectors.kth(top, k)
        low, high = high, high * 4
    return vectors.answer(ask, found, top, k, F.col("score"))

"""Parts that the vector searches share: usable vectors, distinct vectors, packed blocks, block scans.

A search runs over distinct vectors. Of the ids that share one vector only the least k + 1 can be
among the k nearest of anything, so a vector with any number of copies is one row, without loss.
Vectors travel in blocks: one row holds a matrix of bounded size and the ids of its rows. A scan
brings the queries that want a block to it, in groups of bounded size, and keeps the best per query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize

BLOCK = 1024
GROUP = 1024
SAMPLE = 20_000


def usable(vectors: DataFrame, id_col: str, vec_col: str, component=None, zero: bool = True) -> DataFrame:
    """(`id`, `vec` array<double>): no null ids, vectors that are not null, empty or of another length than
    most, and hold finite numbers only; `zero` keeps all-zero vectors. `component` maps each number."""
    vec = F.col(vec_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), vec.alias("vec")).filter(F.col("id").isNotNull() & (F.size("vec") > 0))
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(fine)
    if not zero:
        rows = rows.filter(F.exists("vec", lambda x: x != 0))
    if component is not None:
        rows = rows.withColumn("vec", F.transform("vec", component))
    usual = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("vec") == (usual["n"] if usual else 0))


def distinct(rows: DataFrame, k: int) -> DataFrame:
    """(`vid`, `vec`, `ids`): each vector once, with its least k + 1 ids; `vid` is the least."""
    own = W.partitionBy("_hash", "vec").orderBy("id")
    least = rows.withColumn("_hash", F.xxhash64("vec")).withColumn("_n", F.row_number().over(own)).filter(F.col("_n") <= k + 1)
    grouped = least.groupBy("_hash", "vec").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    return materialize(grouped.select(F.element_at("ids", 1).alias("vid"), "vec", "ids"), "vectors")


def sample(found: DataFrame, most: int = SAMPLE) -> np.ndarray:
    """At most `most` vectors, by hash of their id."""
    rows = found.select("vec", F.xxhash64("vid").alias("_h")).orderBy("_h").limit(most).collect()
    return np.array([r["vec"] for r in rows], dtype=np.float64) if rows else np.zeros((0, 1))


def matrix(column: pa.Array) -> np.ndarray:
    """A list column without nulls, all of one length, as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), len(flat) // max(1, len(column)))


def lifted(x: np.ndarray, norm: float) -> np.ndarray:
    """One more component that brings every row to length `norm`: nearest then is largest inner product."""
    rest = np.maximum(norm * norm - np.einsum("ij,ij->i", x, x), 0.0)
    return np.hstack([x, np.sqrt(rest)[:, None]])


def pack(rows: DataFrame, keys: list[str], measure: str | None = None, size: int = BLOCK) -> DataFrame:
    """Blocks of (`keys[0]`, `vid`, `vec`): sorted by `keys`, a block holds one value of `keys[0]`.

    Gives `block`, the first key, `low` and `high` of `measure` in the block, the number of vectors `n`, and
    the packed ids and matrix.
    """
    first, rest = keys[0], keys[1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, number = TaskContext.get().partitionId(), 0
        held: list[tuple] = []
        label = None

        def flush() -> pa.RecordBatch:
            nonlocal held, number
            vids, spans, vecs = (np.concatenate([h[i] for h in held]) for i in range(3))
            row = [
                pa.array([(task << 32) | number], pa.int64()), pa.array([label], pa.int64()), pa.array([float(spans.min())]),
                pa.array([float(spans.max())]), pa.array([len(vids)], pa.int64()), pa.array([vids.astype("<i8").tobytes()], pa.binary()), pa.array([vecs.astype("<f8").tobytes()], pa.binary()),
            ]
            held, number = [], number + 1
            return pa.RecordBatch.from_arrays(row, ["block", first, "low", "high", "n", "vids", "vecs"])

        for batch in batches:
            if not batch.num_rows:
                continue
            group = batch.column(0).to_numpy(zero_copy_only=False)
            vids, spans = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            vecs = matrix(batch.column(3))
            at = 0
            while at < len(group):
                full = sum(len(h[0]) for h in held)
                if held and (group[at] != label or full >= size):
                    yield flush()
                    full = 0
                label = int(group[at])
                end = min(at + int(np.searchsorted(group[at:], label, side="right")), at + size - full)
                held.append((vids[at:end], spans[at:end], vecs[at:end]))
                at = end
        if held:
            yield flush()

    span = F.col(measure) if measure else F.lit(0.0)
    ordered = rows.select(F.col(first).cast("bigint").alias(first), "vid", span.cast("double").alias("_span"), "vec", *[F.col(c).alias(f"_k{i}") for i, c in enumerate(rest)])
    ordered = ordered.repartitionByRange(first, *[f"_k{i}" for i in range(len(rest))]).sortWithinPartitions(first, *[f"_k{i}" for i in range(len(rest))])
    packed = ordered.select(first, "vid", "_span", "vec").mapInArrow(run, f"block long, {first} long, low double, high double, n long, vids binary, vecs binary")
    return materialize(packed, "blocks")


def in_units(blocks: DataFrame, key: str, size: int = BLOCK) -> DataFrame:
    """`blocks` with `unit`: neighbouring blocks of one key that together hold about `size` vectors, so the
    number of units follows the data and not the number of tasks that packed it."""
    before = W.partitionBy(key).orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    held = F.coalesce(F.sum("n").over(before), F.lit(0))
    unit = (F.shiftleft(F.col(key), 32) + F.floor(held / F.lit(size))).cast("bigint")
    return materialize(blocks.join(blocks.select("block", "n", key).select("block", unit.alias("unit")), "block"), "units")


def scan(blocks: DataFrame, wanted: DataFrame, queries: DataFrame, k: int, reached: DataFrame | None = None) -> DataFrame:
    """(`qid`, `vid`, `score`): the best k of each wanted (`unit`, `qid`), ties to the smaller vid.

    `reached` (`qid`, `reached`) leaves out what scores less than a query's k-th best so far. A unit
    meets its queries in groups of about `GROUP`, so neither side of a group grows with the data.
    """
    load = wanted.groupBy("unit").agg(F.ceil(F.count(F.lit(1)) / GROUP).cast("int").alias("_groups"))
    asked = wanted.join(load, "unit").withColumn("_group", F.pmod(F.xxhash64("qid"), F.col("_groups")).cast("int"))
    known = queries.select("qid", "vec")
    known = known.withColumn("reached", F.lit(None).cast("double")) if reached is None else known.join(reached, "qid", "left")
    asked = asked.join(known, "qid").select("unit", "_group", "qid", "vec", F.coalesce("reached", F.lit(float("-inf"))).alias("reached"))
    held = blocks.select("unit", "vids", "vecs").join(load, "unit").withColumn("_group", F.explode(F.sequence(F.lit(0), F.col("_groups") - 1)))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"qid": pa.array([], pa.int64()), "vid": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        qids = left.column("qid").to_numpy()
        asked = matrix(left.column("vec").combine_chunks())
        vids = np.concatenate([np.frombuffer(b.as_buffer(), "<i8") for b in right.column("vids")])
        vecs = np.concatenate([np.frombuffer(b.as_buffer(), "<f8") for b in right.column("vecs")]).reshape(len(vids), -1)
        order = np.argsort(vids, kind="stable")
        vids, score = vids[order], asked @ vecs[order].T
        # stable by vid, then by falling score
        best = np.argsort(-score, axis=1, kind="stable")[:, :k]
        value = np.take_along_axis(score, best, axis=1)
        row, col = np.nonzero(value >= left.column("reached").to_numpy()[:, None])
        return pa.table({"qid": pa.array(qids[row]), "vid": pa.array(vids[best[row, col]]), "score": pa.array(value[row, col])})

    pairs = asked.groupBy("unit", "_group").cogroup(held.select("unit", "_group", "vids", "vecs").groupBy("unit", "_group"))
    return pairs.applyInArrow(run, "qid long, vid long, score double")


def kth(top: DataFrame, k: int) -> DataFrame:
    """(`qid`, `reached`): the score of the last of k + 1 vectors known, for queries that have as many."""
    return top.groupBy("qid").agg(F.when(F.count(F.lit(1)) > k, F.min("score")).alias("reached"))


def best(scanned: DataFrame, k: int) -> DataFrame:
    """The k best of each query; a vector found in several blocks counts once."""
    once = scanned.groupBy("qid", "vid").agg(F.max("score").alias("score"))
    order = W.partitionBy("qid").orderBy(F.desc("score"), "vid")
    return once.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= k).drop("_rank")


def answer(asking: DataFrame, found: DataFrame, top: DataFrame, k: int, score: Column) -> DataFrame:
    """Rows per query id of (`id`, `vec`): `query_id`, `rank`, `vec_id`, `score`, the query's own id left out.

    `top` holds k + 1 distinct vectors per distinct query (`qid` is its vid): without its own id k are left.
    """
    ids = top.join(found.select("vid", "ids"), "vid").select("qid", score.alias("score"), F.explode("ids").alias("id"))
    order = W.partitionBy("qid").orderBy(F.desc("score"), "id")
    least = ids.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= k + 1)
    lists = least.groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("_n", "id", "score"))).alias("_list"))
    # one row per distinct vector, however many ids ask for it
    names = asking.select(F.col("id").alias("query_id"), F.xxhash64("vec").alias("_hash"), "vec")
    known = found.select(F.xxhash64("vec").alias("_hash"), "vec", F.col("vid").alias("qid"))
    named = names.join(known, ["_hash", "vec"]).select("query_id", "qid").join(lists, "qid")
    others = F.slice(F.filter("_list", lambda x: x["id"] != F.col("query_id")), 1, k)
    return named.select("query_id", F.posexplode(others).alias("_at", "_x")).select(
        "query_id", (F.col("_at") + 1).cast("int").alias("rank"), F.col("_x.id").alias("vec_id"), F.col("_x.score").alias("score")
    )

"""Near-duplicates for cleaning a corpus: five-word shingles, a Jaccard similarity of 0.8 or more.

Pairs are proposed by the fingerprints of `simhash`, here over the five-word shingles: its deletion
variants find all pairs that differ in at most three bits. Alone they cannot serve: at 0.8 about one bit
in seven differs, and segments of which one differs in at most one bit would then have six to nine bits
and propose nearly every pair. Further off, pairs are proposed by 256 minima over the shingles' hashes, cut
into 32 bands of eight. A pair meets in one of them with probability 1 - (1 - s^8)^32: 0.997 at 0.8, 0.99999
at 0.9. Every pair proposed is then verified by the exact Jaccard similarity of its shingle sets, so
documents that only share a fingerprint or a band stay.

Texts of equal shingle sets are one node. A bucket of more than `FEW` nodes is dealt, by another draw in
each band, into cells of about `CELL`, and pairs are formed inside cells: linear in the bucket, and enough
to join groups of copies. A node also keeps one byte of each minimum: pairs of which fewer than 0.7 agree
are dropped before any text moves (a pair at 0.8 lies four standard deviations above; 3 in 100,000 are
lost). Pairs are filtered so and verified in two rounds: a node's likeliest partner of either kind, then
all pairs that are not in one component yet.

No cell loses a pair: a bucket of more than `FEW` nodes that is still in several components is compared
whole, in pairs of blocks of about `BLOCK` texts that give only links between components. This exact way
costs the square of such a bucket in arithmetic, but no pairs are written.

Documents are told apart by (doc_id, hash of the text) and only ever joined with narrow rows: texts of the
nodes that are compared, and at the end the rows that go.

Defined results as in `simhash`: null or wordless texts are alike, fewer than five words are one shingle.
Of rows that repeat the kept (doc_id, text) one stays, the least in JSON.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize, scratch_path, scratch_scope, ship_package, small_or_not
from . import simhash
from .components import connected

WIDTH = 5
ALIKE = 0.8
BANDS, ROWS = 32, 8
FEW = 32
CELL = 16
BLOCK = 512
BLOCK_BYTES = 2 << 20
LIKELY = 0.7
_DRAW = np.random.default_rng(11)
_TIMES = _DRAW.integers(0, 1 << 64, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
_PLUS = _DRAW.integers(0, 1 << 64, BANDS * ROWS, dtype=np.uint64)


def shingles(text: str | None) -> np.ndarray:
    """The set of shingle hashes, sorted."""
    parts = [np.array(found, dtype="<u8") for found in simhash.hashes(text, WIDTH) if found]
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, dtype="<u8")


def alike(a: np.ndarray, b: np.ndarray, least: float = ALIKE) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= least * (len(a) + len(b) - both)


def signature(text: str | None) -> tuple[int, list[int], bytes, int]:
    """Hash of the shingle set, one value per band, a byte of each minimum (neither without words), and the fingerprint."""
    parts = [np.array(found, dtype="<u8") for found in simhash.hashes(text, WIDTH) if found]
    if not parts:
        return 0, [], b"", 0
    found = np.unique(np.concatenate(parts))
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(found), 512):
        np.minimum(least, (found[i:i + 512, None] * _TIMES + _PLUS).min(axis=0), out=least)
    rows = least.reshape(BANDS, ROWS)
    # the high bits of a minimum are zeros for the most part
    mixed = ((least * _TIMES) >> np.uint64(32)).astype(np.uint8)
    values = [xxhash.xxh64_intdigest(r.tobytes(), band) for band, r in enumerate(rows)]
    return xxhash.xxh64_intdigest(found.tobytes()), values, mixed.tobytes(), simhash.majority(parts)


def _signed(values: list[int]) -> np.ndarray:
    return np.array(values, dtype=np.uint64).view(np.int64)


def signatures(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        found = [signature(t.as_py()) for t in batch]
        keys, bands, minima, prints = zip(*found, strict=True) if found else ((), (), (), ())
        ends = np.concatenate([[0], np.cumsum([len(b) for b in bands])]).astype(np.int32)
        listed = pa.ListArray.from_arrays(pa.array(ends), pa.array(_signed([v for b in bands for v in b])))
        columns = [pa.array(_signed(list(keys))), listed, pa.array(list(minima), pa.binary()), pa.array(_signed(list(prints)))]
        yield pa.StructArray.from_arrays(columns, ["fp", "bands", "minima", "print"])


def likely(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Whether enough minima agree."""
    for left, right in batches:
        a, b = (np.frombuffer(b"".join(side.to_pylist()), dtype=np.uint8).reshape(len(side), -1) for side in (left, right))
        yield pa.array((a == b).sum(axis=1) >= LIKELY * BANDS * ROWS, pa.bool_())


def verdicts(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    last = held = None
    for left, right in batches:
        out = []
        for a, b in zip(left, right, strict=True):
            a = a.as_py()
            if held is None or a != last:
                last, held = a, shingles(a)
            out.append(alike(held, shingles(b.as_py())))
        yield pa.array(out, pa.bool_())


def near_prints(nodes: DataFrame) -> DataFrame:
    """(`a`, `b`): nodes of (`fp`, `print`) whose fingerprints differ in at most three bits, enough to join
    all that do. The least node of a fingerprint stands for it and is paired with its others."""
    prints = materialize(nodes.groupBy("print").agg(F.min("fp").alias("_node")), "prints")
    left = prints.select(F.col("print").alias("a"), F.col("_node").alias("_left"))
    right = prints.select(F.col("print").alias("b"), F.col("_node").alias("_right"))
    linked = simhash.links(prints.select(F.col("print").alias("fp"))).join(left, "a").join(right, "b")
    between = linked.select(F.least("_left", "_right").alias("a"), F.greatest("_left", "_right").alias("b"))
    within = nodes.select("fp", "print").join(prints, "print").filter(F.col("fp") != F.col("_node"))
    return materialize(between.unionByName(within.select(F.col("_node").alias("a"), F.col("fp").alias("b"))).distinct(), "near_prints")


def proposed(nodes: DataFrame, few: int = FEW, cell: int = CELL) -> DataFrame:
    """(`a`, `b`, `n`): pairs of (`fp`, `bands`) that meet, in how many bands."""
    rows = nodes.select("fp", F.explode("bands").alias("value"))
    # counted before anything is joined, so a bucket of any size is one row of a task
    shared = rows.groupBy("value").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    cells = F.when(F.col("_n") > few, F.ceil(F.col("_n") / F.lit(cell))).otherwise(F.lit(1))
    dealt = rows.join(shared, "value").select("value", F.pmod(F.xxhash64("fp", "value"), cells).alias("_cell"), "fp")
    met = dealt.groupBy("value", "_cell").agg(F.array_sort(F.collect_list("fp")).alias("_m")).filter(F.size("_m") > 1)
    pairs = met.select("_m", F.posexplode("_m").alias("_i", "a")).select("a", F.explode(F.slice("_m", F.col("_i") + 2, F.size("_m"))).alias("b"))
    return materialize(pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")), "pairs")


def _pairwise(fn, a: str, b: str):
    fn.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    return F.arrow_udf(fn, "boolean")(F.col(a), F.col(b))


def promising(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs of which enough minima, of (`fp`, `minima`), agree."""
    left = nodes.select(F.col("fp").alias("a"), F.col("minima").alias("_left"))
    right = nodes.select(F.col("fp").alias("b"), F.col("minima").alias("_right"))
    both = pairs.join(left, "a").join(right, "b")
    return materialize(both.select("a", "b", _pairwise(likely, "_left", "_right").alias("_ok")).filter("_ok").drop("_ok"), "promising")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The (`a`, `b`) whose texts, of (`fp`, `text`), are alike."""
    left = texts.select(F.col("fp").alias("a"), F.col("text").alias("_left"))
    right = texts.select(F.col("fp").alias("b"), F.col("text").alias("_right"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b")
    return materialize(both.select("a", "b", _pairwise(verdicts, "_left", "_right").alias("_ok")).filter("_ok").select("a", "b"), "verified")


def texts_of(wanted: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """(`fp`, `text`) of the wanted nodes: that of a node's first document, whose other copies stay where they are."""
    first = nodes.select("fp", "_first").join(wanted, "fp", "left_semi").select("fp", F.col("_first.doc_id").alias("_id"), F.col("_first.body").alias("_body"))
    found = _placed(docs).join(small_or_not(first, "wanted"), F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_at") == F.col("_body")))
    # one row for each repeat of the first document
    return materialize(found.groupBy("fp").agg(F.first(F.col("_row.text")).alias("text")), "texts")


def _placed(docs: DataFrame) -> DataFrame:
    return docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_doc"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("_at"))


def cross_links(fps: np.ndarray, roots: np.ndarray, side: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that join what alike texts of different roots join, between sides 0 and 1, or within 0 if there is no 1."""
    within = not (side == 1).any()
    left = np.flatnonzero(side == 0)
    right = left if within else np.flatnonzero(side == 1)
    size = np.array([len(x) for x in sets])
    row = np.repeat(np.arange(len(sets)), size)
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    both = np.zeros((len(left), len(right)), dtype=np.float32)
    # shingles of one text only add nothing; columns go in runs, so a block of long texts stays small
    order = np.argsort(column, kind="stable")
    order = order[times[column[order]] > 1]
    shared, column = np.unique(column[order], return_inverse=True)
    row, step = row[order], 4096
    for low in range(0, len(shared), step):
        a, b = np.searchsorted(column, [low, low + step])
        if a == b:
            continue
        part = np.zeros((len(sets), step), dtype=np.float32)
        part[row[a:b], column[a:b] - low] = 1
        both += part[left] @ part[right].T
    union = size[left][:, None] + size[right][None, :] - both
    near = (both >= ALIKE * union) & (roots[left][:, None] != roots[right][None, :])
    out, open_ = [], near.any(axis=1)
    seen = np.zeros(len(right), dtype=bool)
    # breadth first over the rows: each text is reached once, so links stay fewer than texts
    while open_.any():
        queue = [int(np.flatnonzero(open_)[0])]
        open_[queue[0]] = False
        while queue:
            i = queue.pop()
            for j in np.flatnonzero(near[i] & ~seen).tolist():
                seen[j] = True
                out.append((int(fps[left[i]]), int(fps[right[j]])))
                for k in np.flatnonzero(near[:, j] & open_).tolist():
                    open_[k] = False
                    queue.append(k)
                    out.append((int(fps[left[k]]), int(fps[right[j]])))
    return out


def across(nodes: DataFrame, linked: DataFrame, docs: DataFrame, few: int, block: int = BLOCK) -> DataFrame:
    """(`a`, `b`): links between components of `linked` within buckets that were dealt into cells."""
    roots = materialize(connected(linked, "a", "b"), "roots")
    named = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "bands", F.coalesce("root", "fp").alias("root"))
    rows = named.select("fp", "root", F.explode("bands").alias("value"))
    split = rows.groupBy("value").agg(F.count(F.lit(1)).alias("_n"), F.min("root").alias("_low"), F.max("root").alias("_high"))
    split = materialize(split.filter((F.col("_n") > few) & (F.col("_low") != F.col("_high"))).select("value"), "split_buckets")
    members = materialize(rows.join(split, "value"), "members")
    if members.isEmpty():
        return members.select(F.col("fp").alias("a"), F.col("fp").alias("b"))
    texts = texts_of(members.select("fp").distinct(), nodes, docs)
    sized = members.join(texts.select("fp", F.octet_length("text").alias("_bytes")), "fp")
    load = sized.groupBy("value").agg(F.ceil(F.greatest(F.count(F.lit(1)) / block, F.sum("_bytes") / BLOCK_BYTES)).cast("int").alias("_parts"))
    own = F.pmod(F.xxhash64("fp", "value"), F.col("_parts")).cast("int")
    dealt = members.join(load, "value").select("value", "fp", "root", own.alias("_own"), F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_other"))
    dealt = dealt.select("value", F.least("_own", "_other").alias("_i"), F.greatest("_own", "_other").alias("_j"), "fp", "root",
                         (F.col("_own") > F.col("_other")).cast("int").alias("side"))

    def run(group: pa.Table) -> pa.Table:
        fps, roots, side = (group.column(c).to_numpy() for c in ("fp", "root", "side"))
        found = cross_links(fps, roots, side, [shingles(t.as_py()) for t in group.column("text")]) if len(np.unique(roots)) > 1 else []
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    blocks = dealt.join(texts, "fp").select("value", "_i", "_j", "fp", "root", "side", "text").groupBy("value", "_i", "_j")
    return materialize(blocks.applyInArrow(run, "a long, b long").distinct(), "across")


def _ends(pairs: DataFrame) -> DataFrame:
    # each side on its own: pairs are aggregated as they are read, not doubled first
    left, right = (pairs.select(F.col(end).alias("fp")).distinct() for end in ("a", "b"))
    return left.unionByName(right).distinct()


def links(nodes: DataFrame, docs: DataFrame, few: int = FEW, cell: int = CELL, block: int = BLOCK) -> DataFrame:
    """(`a`, `b`): alike nodes of (`fp`, `bands`, `minima`, `print`, `_first`), enough to join all that meet in
    a band or by their fingerprints."""
    near, pairs = near_prints(nodes), proposed(nodes, few, cell)
    # at most one pair of a kind per node is looked at before components are known: a group of copies has many
    best = pairs.groupBy("b").agg(F.max(F.struct("n", "a")).alias("_x")).select("_x.a", "b")
    best = materialize(best.unionByName(near.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")).distinct(), "best")
    likeliest = promising(best, nodes)
    first = verified(likeliest, texts_of(_ends(likeliest), nodes, docs))
    roots = materialize(connected(first, "a", "b"), "roots")
    rest = pairs.select("a", "b").unionByName(near).join(best, ["a", "b"], "left_anti")
    for end in ("a", "b"):
        rest = rest.join(roots.select(F.col("node").alias(end), F.col("root").alias(f"_{end}")), end, "left")
    rest = rest.filter(F.coalesce("_a", "a") != F.coalesce("_b", "b")).select("a", "b").distinct()
    rest = promising(materialize(rest, "rest"), nodes)
    texts = texts_of(_ends(rest), nodes, docs)
    linked = first.unionByName(verified(rest, texts))
    return linked.unionByName(across(nodes, linked, docs, few, block))


def keep_one(docs: DataFrame, few: int = FEW, cell: int = CELL, block: int = BLOCK) -> DataFrame:
    """`docs` with one row per component of alike texts: that of the smallest doc_id, of its rows the least text."""
    spark = docs.sparkSession
    ship_package(spark, "millrace")
    lost_path, repeated_path = scratch_path(spark, "lost"), scratch_path(spark, "repeated")
    with scratch_scope(spark):
        signatures.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
        signed = F.arrow_udf(signatures, "struct<fp:bigint,bands:array<bigint>,minima:binary,print:bigint>")(F.col("text"))
        rows = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("body"), signed.alias("_s"))
        rows = materialize(rows.select("doc_id", "body", "_s.*"), "signed")
        name = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "body")
        nodes = materialize(rows.groupBy("fp").agg(F.min(name).alias("_first"), F.first("bands").alias("bands"), F.first("minima").alias("minima"), F.min("print").alias("print")), "nodes")
        roots = materialize(connected(links(nodes, docs, few, cell, block), "a", "b"), "roots")
        named = nodes.select("fp", "_first").join(roots, nodes["fp"] == roots["node"], "left").select("_first", F.coalesce("root", "fp").alias("root"))
        kept = named.groupBy("root").agg(F.min("_first").alias("_first")).select(F.col("_first.doc_id").alias("_id"), F.col("_first.body").alias("_body"))
        # from here on rows are (doc_id, hash of the text)
        held = rows.groupBy("doc_id", "body").agg(F.count(F.lit(1)).alias("copies"))
        held = held.join(kept.withColumn("_kept", F.lit(True)), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("body") == F.col("_body")), "left")
        held = materialize(held.select(F.col("doc_id").alias("_id"), F.col("body").alias("_body"), "copies", "_kept"), "held")
        held.filter(F.col("_kept").isNull() | (F.col("copies") > 1)).select("_id", "_body").write.parquet(lost_path)
        held.filter(F.col("_kept") & (F.col("copies") > 1)).select("_id", "_body").write.parquet(repeated_path)
    same = F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_at") == F.col("_body"))
    lost, repeated = (spark.read.schema(rows.select(F.col("doc_id").alias("_id"), F.col("body").alias("_body")).schema).parquet(p) for p in (lost_path, repeated_path))
    out = _placed(docs).join(small_or_not(lost, "lost_rows"), same, "left_anti").select("_row.*")
    if repeated.isEmpty():
        return out
    # one of the rows that repeat a kept one; each task hands on one of its own
    own = W.partitionBy("_doc", "_at").orderBy(F.to_json("_row"))
    again = _placed(docs).join(small_or_not(repeated, "repeated_rows"), same, "left_semi")
    return out.unionByName(again.withColumn("_n", F.row_number().over(own)).filter("_n = 1").select("_row.*"))

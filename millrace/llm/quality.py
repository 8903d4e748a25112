"""Quality classifier: Gaussian kernel ridge by random Fourier features, calibrated by isotonic regression.

Every document becomes a few statistics of its whole text (lengths, character classes, repetition),
counted by Arrow and numpy over batches. The kernel is approximated by cosine features whose
frequencies come from a seed, so no model but the weights has to travel. The normal equations are
summed per partition and fold; their sum over all folds but one scores that fold, so the calibration
(pool adjacent violators over a fixed histogram of out-of-fold scores) sees no fitted row, and their
whole sum is the final model. The driver receives `FOLDS` matrices of a fixed size and one histogram,
whatever the number of documents. At most `most` labelled rows are used, chosen by hash.

Defined results: null text is empty; empty texts get a score as any other; null labels teach nothing;
without any label every score is 0.5; repeated rows are scored and learned row by row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .words import slices

STATISTICS = 13
COSINES = 256
FOLDS = 5
PARTS = 8
BINS = 2048
MOST_LABELS = 200_000
RIDGE = 1.0
WIDTH = 2.5
THRESHOLD = 0.7
# bytes looked at together; the arrays over them take some twenty times that
LOT_BYTES = 1 << 20

# byte classes: letters, capitals, digits, white space but line ends, line ends, stops, shouts, bars, other symbols, beyond ASCII
_CLASSES = 10
_CLASS = np.full(256, 8, dtype=np.uint8)
_CLASS[0x80:] = 9
_CLASS[ord("a"):ord("z") + 1] = 0
_CLASS[ord("A"):ord("Z") + 1] = 1
_CLASS[ord("0"):ord("9") + 1] = 2
_CLASS[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = 3
_CLASS[0x0A] = 4
_CLASS[[ord(c) for c in ".,;:'\"()-"]] = 5
_CLASS[[ord(c) for c in "!?"]] = 6
_CLASS[ord("|")] = 7


def statistics(texts: pa.StringArray) -> np.ndarray:
    """`STATISTICS` numbers per text; no nulls."""
    n = len(texts)
    if not n:
        return np.zeros((0, STATISTICS))
    size = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    raw = np.frombuffer(b"".join(v.as_buffer() for v in texts), dtype=np.uint8)
    row = np.repeat(np.arange(n), size)
    kinds = np.bincount(row * _CLASSES + _CLASS[raw], minlength=n * _CLASSES).reshape(n, _CLASSES).astype(float)

    split = pc.ascii_split_whitespace(texts)
    words = split.flatten()
    owner = np.repeat(np.arange(n), pc.list_value_length(split).to_numpy(zero_copy_only=False))
    code = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    full = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
    owner, code = owner[full], code[full]
    count = np.bincount(owner, minlength=n).astype(float)
    again = (owner[1:] == owner[:-1]) & (code[1:] == code[:-1])
    repeats = np.bincount(owner[1:][again], minlength=n)
    span = int(code.max()) + 1 if len(code) else 1
    distinct = np.bincount(np.unique(owner * span + code) // span, minlength=n)

    some, total = np.maximum(count, 1), np.maximum(size, 1)
    letters = np.maximum(kinds[:, 0] + kinds[:, 1] + kinds[:, 9], 1)
    return np.column_stack([
        np.log1p(count), (size - kinds[:, 3] - kinds[:, 4]) / some, kinds[:, 1] / letters, kinds[:, 2] / total,
        kinds[:, 8] / some, kinds[:, 7] / some, kinds[:, 6] / some, kinds[:, 5] / some, kinds[:, 4] / some,
        repeats / some, np.log1p(distinct) / np.log1p(some), kinds[:, 9] / total, (count == 0).astype(float),
    ])


def _texts(batch: pa.Array) -> np.ndarray:
    parts = [statistics(s) for s in slices(pc.fill_null(batch, ""), LOT_BYTES)]
    return np.vstack(parts) if parts else np.zeros((0, STATISTICS))


def text_statistics(text: Column) -> Column:
    """`statistics` as an array<double> column."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = _texts(batch)
            offsets = np.arange(0, found.size + 1, STATISTICS, dtype=np.int32)
            yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.ravel()))

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "array<double>")(text)


@dataclass(frozen=True)
class Model:
    """Centre and scale of the statistics, ridge weights, and the calibration curve."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    at: np.ndarray
    level: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = cosines(x, self.centre, self.scale) @ self.weights
        return np.clip(np.interp(raw, self.at, self.level), 0.0, 1.0)


def cosines(x: np.ndarray, centre: np.ndarray, scale: np.ndarray, seed: int = 11) -> np.ndarray:
    """Random Fourier features of a Gaussian kernel over standardised statistics, and a constant."""
    rng = np.random.default_rng(seed)
    frequency = rng.standard_normal((STATISTICS, COSINES)) / WIDTH
    phase = rng.uniform(0, 2 * np.pi, COSINES)
    z = np.clip((x - centre) / scale, -5, 5)
    return np.hstack([np.sqrt(2 / COSINES) * np.cos(z @ frequency + phase), np.ones((len(x), 1))])


def learning_rows(labels: DataFrame, most: int = MOST_LABELS) -> DataFrame:
    """(`doc_id`, `quality`) that may teach: known, not held out, at most about `most`, each with a fold."""
    known = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).filter(~held_out(F.col("doc_id")))
    n = known.count()
    draw = F.xxhash64(F.lit("draw"), "doc_id").bitwiseAND((1 << 30) - 1)
    chosen = known.filter(draw < F.lit(int((1 << 30) * min(1.0, most / max(n, 1)))))
    fold = F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(FOLDS)).cast("int")
    return chosen.select("doc_id", F.col("quality").cast("double").alias("quality"), fold.alias("fold"))


def held_out(doc_id: Column) -> Column:
    """Rows that are kept for testing: a quarter, by crc32 of the id's text."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(found: DataFrame, labels: DataFrame, most: int = MOST_LABELS) -> Model:
    """Model from (`doc_id`, `stats`) and (`doc_id`, `quality`)."""
    ship_package(found.sparkSession, "millrace")
    taught = found.select("doc_id", "stats").join(learning_rows(labels, most), "doc_id").select("fold", "quality", "stats")
    taught = taught.repartition(PARTS).persist()
    try:
        return _fit(taught)
    finally:
        taught.unpersist()


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), STATISTICS)


def _fit(taught: DataFrame) -> Model:
    first = [F.sum(F.get("stats", F.lit(i))).alias(f"a{i}") for i in range(STATISTICS)]
    second = [F.sum(F.get("stats", F.lit(i)) * F.get("stats", F.lit(i))).alias(f"b{i}") for i in range(STATISTICS)]
    n, *sums = taught.agg(F.count(F.lit(1)), *first, *second).first()
    if not n:
        zero = np.zeros(STATISTICS)
        return Model(zero, zero + 1, np.zeros(COSINES + 1), np.array([0.0]), np.array([0.5]))
    centre = np.array(sums[:STATISTICS]) / n
    scale = np.sqrt(np.maximum(np.array(sums[STATISTICS:]) / n - centre**2, 1e-8))
    size = COSINES + 1

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        total = np.zeros((FOLDS, size, size + 1))
        for batch in batches:
            fold, y = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            z = cosines(_matrix(batch.column(2)), centre, scale)
            for k in range(FOLDS):
                own = z[fold == k]
                total[k, :, :size] += own.T @ own
                total[k, :, size] += own.T @ y[fold == k]
        columns = [pa.array(range(FOLDS), pa.int32()), pa.array([part] * FOLDS, pa.int32()), pa.array([t.tobytes() for t in total], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["fold", "part", "sums"])

    def add(group: pa.Table) -> pa.Table:
        total = np.zeros(size * (size + 1))
        # in the order of the parts, so that reruns agree to the last bit
        for sums in group.sort_by("part").column("sums"):
            total += np.frombuffer(sums.as_buffer())
        return pa.table({"fold": group.column("fold").slice(0, 1), "sums": pa.array([total.tobytes()], pa.binary())})

    # summed before they are sent: the driver gets one matrix per fold
    parts = taught.mapInArrow(equations, "fold int, part int, sums binary")
    summed = np.zeros((FOLDS, size, size + 1))
    for r in parts.groupBy("fold").applyInArrow(add, "fold int, sums binary").collect():
        summed[r["fold"]] = np.frombuffer(r["sums"]).reshape(size, size + 1)
    whole = summed.sum(axis=0)

    def solve(m: np.ndarray) -> np.ndarray:
        return np.linalg.solve(m[:, :size] + RIDGE * np.eye(size), m[:, size])

    apart = np.stack([solve(whole - summed[k]) for k in range(FOLDS)])

    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fold, y = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            raw = (cosines(_matrix(batch.column(2)), centre, scale) * apart[fold]).sum(axis=1)
            place = np.clip(np.floor((raw + 1) / 3 * BINS), 0, BINS - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(y)], ["bin", "y"])

    bins = taught.mapInArrow(histogram, "bin long, y double").groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("y")).orderBy("bin").collect()
    at, level = isotonic([(b["bin"] + 0.5) / BINS * 3 - 1 for b in bins], [b["n"] for b in bins], [b["y"] for b in bins])
    return Model(centre, scale, solve(whole), at, level)


def isotonic(x: list[float], n: list[int], y: list[float]) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over ascending `x` with counts and sums; ends of each pool and its share."""
    pools: list[list[float]] = []
    for a, c, s in zip(x, n, y, strict=True):
        pools.append([a, a, c, s])
        while len(pools) > 1 and pools[-2][3] * pools[-1][2] >= pools[-1][3] * pools[-2][2]:
            _, b, c2, s2 = pools.pop()
            pools[-1] = [pools[-1][0], b, pools[-1][2] + c2, pools[-1][3] + s2]
    at = np.array([v for p in pools for v in (p[0], p[1])])
    level = np.array([p[3] / p[2] for p in pools for _ in (0, 1)])
    return at, level


def scores(model: Model, value: Column, of_text: bool = False) -> Column:
    """Score of a statistics column, or of a text column."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(model.score(_texts(batch) if of_text else _matrix(batch)))

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "double")(value)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, most: int = MOST_LABELS) -> DataFrame:
    """`docs` whose score reaches `threshold`. Only statistics of labelled documents are kept between passes."""
    ship_package(docs.sparkSession, "millrace")
    model = fit(docs.select("doc_id", text_statistics(F.col("text")).alias("stats")), labels, most)
    rows = docs.select(F.struct("*").alias("_row"))
    scored = rows.withColumn("_score", scores(model, F.col("_row.text"), of_text=True))
    return scored.filter(F.col("_score") >= threshold).select("_row.*")

"""Line dedup: lines that many documents share stay in one document only, told by keep bitmaps.

Every long enough line becomes a row of 128 hash bits of its key, its document and its position; the
text itself stays where it is. The rows are range-partitioned by hash, then document (largest first),
then position, and sorted so inside a range: a line that a third of all documents hold spreads over
as many ranges as its share asks for. Each task streams its range and holds no more of a key than the
lines of one document: the document met first keeps the line, the others lose it once a key is known
to be in enough documents. The keys at the two ends of a range may go on in its neighbours; their rows
are marked, and one summary row per end tells how many documents each range saw, so that a look-up of
at most two rows per task decides them.

The positions lost become bitmaps: per document, runs of `SPAN` lines with one bit per line (1 keeps),
deflated; runs and lines behind the last lost one are kept and not stored. A bitmap moves to its
text by (doc_id, hash of the text), and nothing but the bitmap says what stays.

Defined results: null or empty text is one empty line; a null doc_id is the smallest document; rows
that share a doc_id are one document when documents are counted, and each returns its own lines;
repeated rows have one bitmap and all use it; other columns stay, but for those named like the added
ones, which are replaced; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize, ship_package

LEAST_CHARS = 20
LEAST_DOCS = 3
SPAN = 1 << 15

_BLANK = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_NULL = -(1 << 63)
_DECIDED, _OPEN, _SUMMARY = 0, 1, 2
_STREAMED = "kind int, h1 long, h2 long, doc long, body long, pos int, lead boolean, task int, last long, n long"


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(_BLANK)), _UPPER, _UPPER.lower())


def _place(doc_id: str, text: str) -> list[Column]:
    """What a bitmap finds its text by."""
    return [F.coalesce(F.col(doc_id).cast("bigint"), F.lit(_NULL)).alias("doc"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("body")]


def line_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS) -> DataFrame:
    """(`h1`, `h2`, `doc`, `body`, `pos`) of every line whose key has at least `least_chars` code points."""
    lines = docs.select(*_place(doc_id, text), F.posexplode(F.split(F.col(text), "\n")).alias("pos", "line"))
    # bytes are never fewer than code points: short lines go before they are looked at
    keyed = lines.filter(F.octet_length("line") >= least_chars).select("doc", "body", "pos", line_key(F.col("line")).alias("key"))
    long = keyed.filter(F.char_length("key") >= least_chars)
    return long.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc", "body", "pos")


class _Stream:
    """First occurrences in one sorted range; see the module's text for what is decided when."""

    def __init__(self, task: int, least_docs: int):
        self.task, self.least = task, least_docs
        self.key: tuple[int, int] | None = None
        self.first_run = True
        self.docs = self.first = self.last = 0
        # rows of documents behind the first, while too few documents are known
        self.waiting: list[tuple[np.ndarray, ...]] = []

    def _rows(self, kind: int, rows: tuple[np.ndarray, ...], lead: np.ndarray | None = None) -> pa.RecordBatch:
        n = len(rows[0])
        lead = np.zeros(n, dtype=bool) if lead is None else lead
        none = pa.nulls(n, pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, kind, dtype=np.int32)), *(pa.array(r) for r in rows), pa.array(lead), pa.nulls(n, pa.int32()), none, none],
            ["kind", "h1", "h2", "doc", "body", "pos", "lead", "task", "last", "n"],
        )

    def _summary(self) -> pa.RecordBatch:
        values = [_SUMMARY, *self.key, self.first, None, None, None, self.task, self.last, self.docs]
        kinds = [pa.int32(), *[pa.int64()] * 4, pa.int32(), pa.bool_(), pa.int32(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)],
                                          ["kind", "h1", "h2", "doc", "body", "pos", "lead", "task", "last", "n"])

    def batch(self, rows: tuple[np.ndarray, ...]) -> Iterator[pa.RecordBatch]:
        h1, h2, doc = rows[:3]
        m = len(h1)
        begins = np.ones(m, dtype=bool)
        begins[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        goes_on = self.key is not None and self.key == (int(h1[0]), int(h2[0]))
        begins[0] = not goes_on
        other = begins.copy()
        other[1:] |= doc[1:] != doc[:-1]
        if goes_on:
            other[0] = int(doc[0]) != self.last
        elif self.key is not None:
            yield from self._close()
        # run 0 is the one that goes on; a row's rank is the number of documents before its own in the run
        run, seen, starts = np.cumsum(begins), np.cumsum(other), np.flatnonzero(begins)
        base = np.concatenate([[1 - self.docs], seen[starts]])
        rank = seen - base[run]
        ends = np.concatenate([starts, [m]]) - 1
        total = np.where(ends >= 0, rank[np.maximum(ends, 0)] + 1, 0)
        # the task's first run stays open: rows before it may belong to it
        opening = (run == (0 if goes_on else 1)) if self.first_run else np.zeros(m, dtype=bool)
        if opening.any():
            yield self._rows(_OPEN, tuple(r[opening] for r in rows), rank[opening] == 0)
        decided = (rank >= 1) & (total[run] >= self.least) & ~opening
        if goes_on and not self.first_run:
            if total[0] >= self.least:
                yield from self._release(_DECIDED)
            elif len(starts):
                self.waiting = []
        if decided.any():
            yield self._rows(_DECIDED, tuple(r[decided] for r in rows))
        if len(starts):
            if goes_on and self.first_run:
                self.docs, self.last = int(total[0]), int(doc[ends[0]]) if ends[0] >= 0 else self.last
                yield self._summary()
                self.first_run = False
            elif self.first_run and len(starts) > 1:
                self.key, self.first = (int(h1[0]), int(h2[0])), int(doc[0])
                self.docs, self.last = int(total[1]), int(doc[ends[1]])
                yield self._summary()
                self.first_run = False
            at = starts[-1]
            self.key, self.first = (int(h1[at]), int(h2[at])), int(doc[at])
        self.docs, self.last = int(total[run[-1]]), int(doc[-1])
        if not self.first_run and self.docs < self.least:
            held = (run == run[-1]) & (rank >= 1)
            if held.any():
                self.waiting.append(tuple(r[held] for r in rows))

    def _release(self, kind: int) -> Iterator[pa.RecordBatch]:
        for held in self.waiting:
            yield self._rows(kind, held)
        self.waiting = []

    def _close(self) -> Iterator[pa.RecordBatch]:
        """The open run has ended between two batches."""
        self.waiting = []
        if self.first_run:
            yield self._summary()
            self.first_run = False

    def end(self) -> Iterator[pa.RecordBatch]:
        """The last run may go on in the next range."""
        if self.key is not None:
            yield from self._release(_OPEN)
            yield self._summary()


def lost_lines(rows: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(`doc`, `body`, `pos`) of the lines that go: keys in `least_docs` documents or more, but for the largest."""
    ship_package(rows.sparkSession, "millrace")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        stream = _Stream(TaskContext.get().partitionId(), least_docs)
        for batch in batches:
            if batch.num_rows:
                yield from stream.batch(tuple(c.to_numpy(zero_copy_only=False) for c in batch.columns))
        yield from stream.end()

    order = ["h1", "h2", F.desc("doc"), "body", "pos"]
    ranged = rows.select("h1", "h2", "doc", "body", "pos").repartitionByRange(*order).sortWithinPartitions(*order)
    streamed = materialize(ranged.mapInArrow(run, _STREAMED), "line_runs")
    # at most two rows per task; a document at the seam of two ranges is counted in both
    met = W.partitionBy("h1", "h2").orderBy("task")
    seam = (F.lag("last").over(met) == F.col("doc")).cast("bigint")
    ends = streamed.filter(F.col("kind") == _SUMMARY).withColumn("twice", F.coalesce(seam, F.lit(0)))
    whole = ends.groupBy("h1", "h2").agg((F.sum("n") - F.sum("twice")).alias("total"), F.max("doc").alias("top"))
    opened = streamed.filter(F.col("kind") == _OPEN).join(F.broadcast(whole), ["h1", "h2"])
    opened = opened.filter((F.col("total") >= least_docs) & (~F.col("lead") | (F.col("doc") != F.col("top"))))
    return streamed.filter(F.col("kind") == _DECIDED).select("doc", "body", "pos").unionByName(opened.select("doc", "body", "pos"))


def _deflated(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        out = []
        for lost in batch:
            gone = lost.values.to_numpy(zero_copy_only=False)
            # whole bytes, so that no bit behind the last lost line reads as lost
            bits = np.ones((int(gone.max()) // 8 + 1) * 8, dtype=np.uint8)
            bits[gone] = 0
            out.append(zlib.compress(np.packbits(bits, bitorder="little").tobytes()))
        yield pa.array(out, pa.binary())


_deflated.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}


def keep_bitmaps(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS
) -> DataFrame:
    """(`doc`, `body`, `n_dropped`, `keep` array<struct<span int, bits binary>>) of the documents that lose lines."""
    # ranges are sampled before rows are dealt out: the narrow rows are read twice, the texts once
    rows = materialize(line_rows(docs, doc_id, text, least_chars), "line_rows")
    lost = lost_lines(rows, least_docs)
    # as a set: rows that are repeated lose the same lines
    spans = lost.groupBy("doc", "body", F.floor(F.col("pos") / SPAN).cast("int").alias("span")).agg(F.collect_set(F.col("pos") % SPAN).alias("gone"))
    bits = F.arrow_udf(_deflated, "binary")(F.col("gone"))
    packed = spans.select("doc", "body", "span", F.size("gone").cast("bigint").alias("n"), bits.alias("bits"))
    runs = F.array_sort(F.collect_list(F.struct("span", "bits"))).alias("keep")
    return materialize(packed.groupBy("doc", "body").agg(F.sum("n").alias("n_dropped"), runs), "keep_bitmaps")


def kept_positions(n_lines: int, keep: list[dict] | None) -> np.ndarray:
    """One bool per line, from a bitmap; null keeps all."""
    kept = np.ones(n_lines, dtype=bool)
    for part in keep or []:
        bits = np.unpackbits(np.frombuffer(zlib.decompress(part["bits"]), dtype=np.uint8), bitorder="little")
        at = part["span"] * SPAN
        size = min(len(bits), n_lines - at)
        kept[at:at + size] = bits[:size]
    return kept


def _kept_text(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for texts, keeps in batches:
        out = []
        for text, keep in zip(texts, keeps, strict=True):
            if not keep.is_valid:
                out.append(None)
                continue
            lines = text.as_py().split("\n")
            out.append("\n".join([lines[i] for i in np.flatnonzero(kept_positions(len(lines), keep.as_py()))]))
        yield pa.array(out, pa.string())


_kept_text.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with the lines that stay as `text`, and `n_lines` (before), `n_dropped`, `keep`.

    Texts that lose nothing do not leave the JVM. A side of bitmaps that Spark knows to be small is
    broadcast; else texts are shuffled once, and hashed bitmaps spare them a sort.
    """
    ship_package(docs.sparkSession, "millrace")
    added = ("n_lines", "n_dropped", "keep")
    doc, body = _place(doc_id, text)
    placed = docs.select(F.struct("*").alias("_row"), doc, body, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    met = placed.join(bitmaps.hint("shuffle_hash"), ["doc", "body"], "left")
    n_lines = F.octet_length("_text") - F.octet_length(F.replace("_text", F.lit("\n"), F.lit(""))) + 1
    some = F.when(F.col("keep").isNotNull(), F.col("_text"))
    met = met.withColumn("_kept", F.arrow_udf(_kept_text, "string")(some, F.col("keep")))
    return met.select(
        *[F.col("_row")[c].alias(c) for c in docs.columns if c.lower() not in (*added, text.lower())],
        F.coalesce("_kept", "_text").alias(text), n_lines.cast("bigint").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("bigint").alias("n_dropped"), "keep",
    )

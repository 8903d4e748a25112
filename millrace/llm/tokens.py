"""Token ids in binary segments, with Elias-Fano encoded document boundaries.

Documents are sorted by id, the head of the text and its hash (one range shuffle of the texts), encoded where they lie and packed into
segments of about `SEGMENT` ids. A segment is one binary value that stands on its own:

    header   magic, version, ids per document and in all, ids written by earlier segments of the task,
             bytes per id, low bits per boundary, documents without id, length of each part
    doc_ids  Elias-Fano code of (doc_id - first doc_id)
    ends     Elias-Fano code of each document's end in the id array
    ids      the concatenated ids, little-endian, two bytes where the vocabulary allows, else four

An Elias-Fano code keeps n ascending values below u in n * (2 + log2(u / n)) bits: the low bits
packed, the high bits in unary, and the place of every 64th one for `select`. Offsets come from
select; there is no table of 64-bit offsets. Segments are rows of a Parquet table (`task`, `segment`,
`payload`), so commit, retry and any store are Spark's affair. A segment knows the ids before it in
its task; those of earlier tasks are one sum per task.

Defined results: null text is empty (only the end id); null doc_ids come first; equal doc_ids are
ordered by the first 64 characters of their texts, then by a hash of them; an empty table writes no segment and reads as no rows.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import scratch_path, ship_package
from .words import MOST_WORDS, WordTable, slices

SEGMENT = 1 << 20
SELECT_STEP = 64
# characters that order the texts of one id
HEAD = 64
_MAGIC = b"MRTS"
_HEADER = struct.Struct("<4sHHQQQQqHHQQQ")

_workers: dict[int, "Encoder"] = {}


# --- Elias-Fano ----------------------------------------------------------------------------------


def ef_encode(values: np.ndarray) -> bytes:
    """Ascending non-negative integers."""
    n = len(values)
    top = int(values[-1]) if n else 0
    low_bits = max(0, (max(top, 1) // max(n, 1)).bit_length() - 1)
    values = values.astype(np.uint64)
    ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
    high = np.zeros(int(ones[-1]) + 1 if n else 0, dtype=np.uint8)
    high[ones] = 1
    low = (values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
    parts = [
        np.packbits(low.astype(np.uint8).ravel(), bitorder="little").tobytes(),
        np.packbits(high, bitorder="little").tobytes(),
        ones[::SELECT_STEP].astype("<u4").tobytes(),
    ]
    return struct.pack("<QHIII", n, low_bits, *map(len, parts)) + b"".join(parts)


class EliasFano:
    """Reader with `select`: the i-th value, from the nearest sampled one on."""

    _HEAD = struct.Struct("<QHIII")

    def __init__(self, data: memoryview):
        self.n, self.low_bits, low, high, sample = self._HEAD.unpack_from(data)
        at = self._HEAD.size
        self.low = np.frombuffer(data, np.uint8, low, at)
        self.high = np.frombuffer(data, np.uint8, high, at + low)
        self.sample = np.frombuffer(data, "<u4", sample // 4, at + low + high)

    def select(self, i: int) -> int:
        """Value i: its one in the high bits is looked for from the last sample before it."""
        place = int(self.sample[i // SELECT_STEP])
        left = i % SELECT_STEP
        byte = place // 8
        mask = (0xFF << (place % 8)) & 0xFF
        while True:
            bits = int(self.high[byte]) & mask
            count = bits.bit_count()
            if left < count:
                for _ in range(left):
                    bits &= bits - 1
                one = byte * 8 + (bits & -bits).bit_length() - 1
                break
            left, byte, mask = left - count, byte + 1, 0xFF
        return ((one - i) << self.low_bits) | self._low(i)

    def _low(self, i: int) -> int:
        at = i * self.low_bits
        raw = int.from_bytes(self.low[at // 8:(at + self.low_bits + 7) // 8].tobytes(), "little")
        return (raw >> (at % 8)) & ((1 << self.low_bits) - 1)

    def all(self) -> np.ndarray:
        """Every value, by one pass over both parts."""
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[:self.n]
        high = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        bits = np.unpackbits(self.low, bitorder="little")[:self.n * self.low_bits].reshape(self.n, self.low_bits)
        low = (bits.astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
        return (high | low).astype(np.int64)


# --- segments ------------------------------------------------------------------------------------


def pack(doc_ids: list[int | None], ends: np.ndarray, ids: np.ndarray, before: int, width: int) -> bytes:
    """One segment; `doc_ids` ascend, nulls first."""
    known = [d for d in doc_ids if d is not None]
    first = known[0] if known else 0
    # differences of 64-bit ids need all 64 bits
    names = ef_encode(np.array([d - first for d in known], dtype=np.uint64))
    bounds = ef_encode(ends)
    body = ids.astype("<u2" if width == 2 else "<u4").tobytes()
    nulls = len(doc_ids) - len(known)
    head = _HEADER.pack(_MAGIC, 1, width, len(doc_ids), len(ids), before, nulls, first, 0, 0, len(names), len(bounds), len(body))
    return b"".join([head, names, bounds, body])


class Segment:
    """A packed segment; ids of a document are a view, found by two selects."""

    def __init__(self, payload: bytes):
        data = memoryview(payload)
        magic, version, width, self.n_docs, self.n_ids, self.before, self.nulls, self.first, _, _, names, bounds, body = _HEADER.unpack_from(data)
        if magic != _MAGIC or version != 1:
            raise ValueError("not a token segment")
        at = _HEADER.size
        self.names = EliasFano(data[at:at + names])
        self.ends = EliasFano(data[at + names:at + names + bounds])
        self.ids = np.frombuffer(data, "<u2" if width == 2 else "<u4", self.n_ids, at + names + bounds)

    def doc_ids(self) -> list[int | None]:
        return [None] * self.nulls + [self.first + int(x) for x in self.names.all().view(np.uint64)]

    def document(self, i: int) -> tuple[int, np.ndarray]:
        """(start in the segment, ids) of document i."""
        start = self.ends.select(i - 1) if i else 0
        return start, self.ids[start:self.ends.select(i)]


# --- encoding ------------------------------------------------------------------------------------


# fixed values: the pattern of the tokenizer that words may be taken apart for, and its normaliser's steps
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_STEPS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
# a word of Latin letters with stops behind it: both parts are cut by the pattern, and composed already
_PLAIN = "^(?P<letters>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<stops>[.,;:!?]*)$"
# the byte-level alphabet: a printable Latin-1 byte is its own letter, the others are numbered from 256 on
_HIDDEN = [b for b in range(256) if not (0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE)]
_LETTER = {b: 256 + n for n, b in enumerate(_HIDDEN)}


def takes_apart(source: str) -> bool:
    """Whether the tokenizer's own settings say that white space ends a token and is dropped, and that
    letters and stops are encoded apart, in lower case and in the byte alphabet, by its model alone."""
    kind = json.loads(source)
    cut = {"type": "Split", "pattern": {"Regex": _PATTERN}, "behavior": "Removed", "invert": True}
    spell = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False}
    steps = (kind.get("pre_tokenizer") or {}).get("pretokenizers") or []
    seen = [{k: v for k, v in step.items() if k != "trim_offsets"} for step in steps]
    special = all(re.search("[^A-Za-zÀ-ÿ.,;:!?]", t["content"]) for t in kind.get("added_tokens") or [])
    return seen == [cut, spell] and (kind.get("normalizer") or {}).get("normalizers") == _STEPS and kind["model"]["type"] == "BPE" and special


class Encoder:
    """Ids of texts. Where the tokenizer allows it (`takes_apart`), texts are split at white space and
    plain words into letters and stops, by Arrow; a worker encodes each part once. Other tokenizers get
    whole texts."""

    def __init__(self, source: str, most: int = MOST_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(source)
        self.model = self.tokenizer.model
        self.dtype = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.apart = takes_apart(source)
        self.parts = WordTable(self._parts, self.dtype, most)

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def _parts(self, keys: list[str]) -> tuple[list[list[int]], list[bool]]:
        """Letters and stops are led by a space, which no word holds, and go to the model; words go to the tokenizer."""
        rest = iter(self._whole([k for k in keys if k[:1] != " "]))
        out = []
        for key in keys:
            if key[:1] == " ":
                letters = key[1:] if key.isascii() else key[1:].encode().decode("latin-1").translate(_LETTER)
                out.append([t.id for t in self.model.tokenize(letters)])
            else:
                out.append(next(rest))
        return out, [False] * len(out)

    def words(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Places of both parts of each word, -1 where there is none."""
        found = pc.extract_regex(words, _PLAIN)
        plain = found.is_valid().to_numpy(zero_copy_only=False)
        own, other = np.full(len(words), -1, dtype=np.int64), np.full(len(words), -1, dtype=np.int64)
        found = found.filter(pa.array(plain))
        letters = pc.binary_join_element_wise(" ", pc.utf8_lower(found.field("letters")), "")
        stops = pc.binary_join_element_wise(" ", found.field("stops"), "")
        stopped = pc.not_equal(stops, " ").to_numpy(zero_copy_only=False)
        at = np.flatnonzero(plain)
        keys = pa.concat_arrays([letters, stops.filter(pa.array(stopped)), words.filter(pa.array(~plain))]).dictionary_encode()
        code = self.parts.places(keys.dictionary.to_pylist())[keys.indices.to_numpy(zero_copy_only=False)]
        own[at] = code[:len(at)]
        other[at[stopped]] = code[len(at):len(at) + int(stopped.sum())]
        own[~plain] = code[len(at) + int(stopped.sum()):]
        return own, other

    def encode(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and where each text's ids end; no nulls."""
        if not self.apart:
            found = self._whole(texts.to_pylist())
            return np.array([i for ids in found for i in ids], dtype=self.dtype), np.cumsum([len(f) for f in found], dtype=np.int64)
        split = pc.ascii_split_whitespace(texts)
        numbered = split.flatten().dictionary_encode()
        own, other = self.words(numbered.dictionary)
        codes = numbered.indices.to_numpy(zero_copy_only=False)
        pieces = np.stack([own, other], axis=1)[codes].ravel()
        ids, ends = self.parts.take(pieces)
        last = 2 * np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))
        return ids, np.concatenate([[0], ends])[last]


def _encoder(source: str) -> Encoder:
    """One per worker and tokenizer."""
    key = hash(source)
    if key not in _workers:
        _workers.clear()
        _workers[key] = Encoder(source)
    return _workers[key]


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, segment: int = SEGMENT) -> None:
    """Encode (`doc_id`, `text`) in ascending id order into segments at `path`.

    `tokenizer` is the library's JSON (a few MB, carried in the task).
    """
    spark = docs.sparkSession
    ship_package(spark, "millrace")
    source = spark.sparkContext.broadcast(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        table = _encoder(source.value)
        width = 2 if table.dtype is np.uint16 and end_id < 1 << 16 else 4
        task, number, before = TaskContext.get().partitionId(), 0, 0
        names: list[int | None] = []
        ends: list[np.ndarray] = []
        parts: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal names, ends, parts, held, number, before
            payload = pack(names, np.concatenate(ends), np.concatenate(parts), before, width)
            row = pa.RecordBatch.from_arrays(
                [pa.array([task], pa.int32()), pa.array([number], pa.int32()), pa.array([len(names)], pa.int64()), pa.array([held], pa.int64()), pa.array([payload], pa.binary())],
                ["task", "segment", "n_docs", "n_ids", "payload"],
            )
            number, before = number + 1, before + held
            names, ends, parts, held = [], [], [], 0
            return row

        for batch in batches:
            doc_ids, at = batch.column(0).to_pylist(), 0
            for texts in slices(pc.fill_null(batch.column(1), ""), segment * 8):
                ids, upto = table.encode(texts)
                n = len(texts)
                # the end id goes behind each document's ids
                ids = np.insert(ids, upto, end_id)
                upto = upto + np.arange(1, n + 1)
                names += doc_ids[at:at + n]
                ends.append(held + upto)
                parts.append(ids)
                at, held = at + n, held + len(ids)
                if held >= segment:
                    yield flush()
        if names:
            yield flush()

    order = ["doc_id", "_head", "_hash", "_row"]
    named = docs.select("doc_id", "text", F.substring("text", 1, HEAD).alias("_head"), F.xxhash64("text").alias("_hash"), F.monotonically_increasing_id().alias("_row"))
    # an id, or a row, that fills a third of the table is dealt to many tasks
    ordered = named.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    ordered.mapInArrow(run, "task int, segment int, n_docs long, n_ids long, payload binary").write.mode("overwrite").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """`doc_id`, `start`, `n_tokens`, `ids_crc32` per document, from the segments alone."""
    ship_package(spark, "millrace")
    rows = spark.read.parquet(path)
    # one row per writing task
    before = W.orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    offsets = rows.groupBy("task").agg(F.sum("n_ids").alias("_n")).select("task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, payload in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                s = Segment(payload.as_py())
                starts, counts, sums = [], [], []
                for i in range(s.n_docs):
                    start, ids = s.document(i)
                    starts.append(base + s.before + start)
                    counts.append(len(ids))
                    sums.append(zlib.crc32(ids.astype("<u4").tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s.doc_ids(), pa.int64()), *(pa.array(x, pa.int64()) for x in (starts, counts, sums))],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    placed = rows.join(F.broadcast(offsets), "task").select("base", "payload")
    return placed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def write_and_read(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    path = scratch_path(docs.sparkSession, "segments")
    write(docs, path, tokenizer, end_id)
    return read(docs.sparkSession, path)

"""Cross-tokenizer alignment: divide and conquer at ends that both tokenizers share.

Two tokenizers cut the same bytes; A is a byte-level tokenizer of the tokenizers library, B a
sentencepiece model. Texts of a batch are encoded word by word (each word of a worker once), and their
tokens' ends lie on one axis, text behind text. An interval that both cut at its ends is divided: from
the middle token of A on, ends are looked for by bisection in the other list, in turns and to either
side, until one is common. Both halves are divided again, all intervals of a batch at a time; an
interval without a common end inside is a group. Within a group every overlapping pair of an A and a B
token is a link, found by bisection as well.

Counts of id pairs over the whole corpus follow without moving links: a batch becomes one packed row
with its distinct pairs, and per document which of them it has how often. Distinct pairs of batches are
summed by id pair, looked up again per batch, and meet their packed row. A batch holds about `SLICE`
bytes of text (or one longer text), so no row outgrows a task.

Defined results: null and empty texts, and texts whose joined A or B bytes differ from a space and the
text (such as those with the character that B writes for a space), have no tokens: zeros and ''. Every
row is a document of its own, so repeated rows and ids are counted row by row, and a null doc_id stays;
extra columns take no part; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, ship_package
from .spm import BYTE, MARK, parse
from .tokens import _HIDDEN
from .words import SLICE, WordTable, slices

# white space as the A tokenizer's pattern sees it
_WS = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\p{Z}]"
# texts, led by a space, that may not be cut at each space: A joins runs of white space, B runs of spaces
_WHOLE = f"{_WS} {_WS}| $|  |{MARK}"

_workers: dict[int, "Pair"] = {}


class Pair:
    """Both tokenizers of a worker; ids of B follow those of A, so one word table holds both."""

    def __init__(self, a_json: str, b_model: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_json)
        # their strings in a text are plain text
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        letters = byte_alphabet()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        own = [b""] * (max(vocabulary.values()) + 1)
        for piece, i in vocabulary.items():
            own[i] = b"".join(letters.get(c, c.encode()) for c in piece)
        model = parse(b_model)
        self.separable = model.separable and splits_before_spaces(a_json)
        other = [bytes([int(p[3:5], 16)]) if t == BYTE else p.replace(MARK, " ").encode() for p, _, t in model.pieces]
        self.n_a, self.n_b = len(own), len(other)
        self.bytes = own + other
        self.size = np.array([len(x) for x in self.bytes], dtype=np.int64)
        names = [str(i).encode() for i in [*range(self.n_a), *range(self.n_b)]]
        # a token's number as it is written inside its group, and as the last of its side
        ends = [b"|"] * self.n_a + [b";"] * self.n_b
        self.written = np.array([n + b"," for n in names] + [n + e for n, e in zip(names, ends, strict=True)], dtype=object)
        self.words = WordTable(self._words, np.int32)

    def whole(self, texts: list[str]) -> tuple[list[list[int]], list[bool]]:
        """Ids of both, A's first, and a mark where either does not give back a space and the text."""
        a = [e.ids for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        b = self.b.encode(texts, num_threads=1)
        data, n_a = self.bytes, self.n_a
        out, bad = [], []
        for text, x, y in zip(texts, a, b, strict=True):
            want = b" " + text.encode()
            bad.append(b"".join([data[i] for i in x]) != want or b"".join([data[i + n_a] for i in y]) != want)
            out.append([*x, *[i + n_a for i in y]])
        return out, bad

    _words = whole

    def encode(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts in order, where each text's ids end, and a mark per text that has no tokens."""
        n = len(texts)
        empty = pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        if self.separable:
            whole = pc.match_substring_regex(pc.binary_join_element_wise(" ", texts, ""), _WHOLE).to_numpy(zero_copy_only=False) & ~empty
        else:
            whole = ~empty
        plain = np.flatnonzero(~whole & ~empty)
        parts: list[np.ndarray] = [np.zeros(0, dtype=np.int32)] * n
        bad = empty.copy()
        if len(plain):
            ids, ends, marked = self.words.gather(pc.split_pattern(texts.take(pa.array(plain)), " "))
            if len(plain) == n:
                return ids, ends, marked
            for i, part, m in zip(plain.tolist(), np.split(ids, ends[:-1]), marked.tolist(), strict=True):
                parts[i], bad[i] = part, m
        for i in np.flatnonzero(whole).tolist():
            (found,), (bad[i],) = self.whole([texts[i].as_py()])
            parts[i] = np.array(found, dtype=np.int32)
        return np.concatenate(parts) if n else np.zeros(0, dtype=np.int32), np.cumsum([len(p) for p in parts]), bad


def byte_alphabet() -> dict[str, bytes]:
    """The byte that each letter of the byte-level alphabet stands for."""
    numbered = {256 + n: b for n, b in enumerate(_HIDDEN)}
    shown = {b: b for b in range(256) if b not in set(_HIDDEN)}
    return {chr(c): bytes([b]) for c, b in (shown | numbered).items()}


def splits_before_spaces(a_json: str) -> bool:
    """Whether the tokenizer is known to cut before each space that follows a word: byte-level with its own
    pattern, nothing normalised, no prefix added."""
    kind = json.loads(a_json)
    first = kind.get("pre_tokenizer") or {}
    return kind.get("normalizer") is None and first.get("type") == "ByteLevel" and first.get("use_regex", True) and not first.get("add_prefix_space", True)


# --- groups and links ----------------------------------------------------------------------------


def common_ends(a_end: np.ndarray, b_end: np.ndarray, a_cut: np.ndarray, b_cut: np.ndarray) -> None:
    """Mark in `a_cut` and `b_cut` (given with the last token of each text marked) the tokens whose end is shared."""
    last_a, last_b = np.flatnonzero(a_cut), np.flatnonzero(b_cut)
    # intervals of tokens: al..ah of A, bl..bh of B, behind the last one
    al, ah = np.concatenate([[0], last_a[:-1] + 1]), last_a + 1
    bl, bh = np.concatenate([[0], last_b[:-1] + 1]), last_b + 1
    while True:
        divisible = (ah - al > 1) & (bh - bl > 1)
        al, ah, bl, bh = al[divisible], ah[divisible], bl[divisible], bh[divisible]
        if not len(al):
            return
        i, j = _to_the_right(a_end, b_end, (al + ah) // 2 - 1)
        inside = i < ah - 1
        lone = np.flatnonzero(~inside)
        if len(lone):
            i[lone], j[lone] = _to_the_left(a_end, b_end, (al[lone] + ah[lone]) // 2 - 1, al[lone])
        found = i >= al
        # right of an end found to the left there is no other
        more = found & inside
        a_cut[i[found]] = True
        b_cut[j[found]] = True
        al, ah, bl, bh = (
            np.concatenate([al[found], i[more] + 1]), np.concatenate([i[found] + 1, ah[more]]),
            np.concatenate([bl[found], j[more] + 1]), np.concatenate([j[found] + 1, bh[more]]),
        )


def _to_the_right(a_end: np.ndarray, b_end: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first common end at or behind that of A's token `start`, as tokens of A and B."""
    i, j = start.copy(), np.searchsorted(b_end, a_end[start])
    left = np.flatnonzero(b_end[j] != a_end[i])
    while len(left):
        # step to the other list's next end, there and back
        i[left] = np.searchsorted(a_end, b_end[j[left]])
        left = left[a_end[i[left]] != b_end[j[left]]]
        j[left] = np.searchsorted(b_end, a_end[i[left]])
        left = left[b_end[j[left]] != a_end[i[left]]]
    return i, j


def _to_the_left(a_end: np.ndarray, b_end: np.ndarray, start: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The last common end before that of A's token `start`; A's token is below `least` where there is none."""
    i, j = start.copy(), np.searchsorted(b_end, a_end[start]) - 1
    left = np.arange(len(i))
    while len(left):
        gone = left[j[left] < 0]
        i[gone] = -1
        left = left[j[left] >= 0]
        i[left] = np.searchsorted(a_end, b_end[j[left]], side="right") - 1
        left = left[i[left] >= least[left]]
        left = left[a_end[i[left]] != b_end[j[left]]]
        j[left] = np.searchsorted(b_end, a_end[i[left]], side="right") - 1
        done = (j[left] >= 0) & (b_end[np.maximum(j[left], 0)] == a_end[i[left]])
        left = left[~done]
    return i, j


def links(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of A and B, one row per overlapping pair, in order."""
    a_start = np.concatenate([[0], a_end[:-1]])
    first = np.searchsorted(b_end, a_start, side="right")
    count = np.searchsorted(b_end, a_end) - first + 1
    upto = np.cumsum(count)
    a = np.repeat(np.arange(len(a_end)), count)
    return a, first[a] + np.arange(upto[-1] if len(upto) else 0) - (upto - count)[a]


@dataclass
class Aligned:
    """A batch of texts: numbers and digest per text, distinct pairs, and pairs per text."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: list[str]
    pairs: np.ndarray
    counts: np.ndarray
    upto: np.ndarray
    which: np.ndarray
    times: np.ndarray


def align(pair: Pair, texts: pa.StringArray) -> Aligned:
    """Groups and links of texts without nulls."""
    n = len(texts)
    ids, ends, bad = pair.encode(texts)
    text_of = np.repeat(np.arange(n), np.diff(ends, prepend=0))
    used = ~bad[text_of]
    ids, text_of = ids[used], text_of[used]
    is_a = ids < pair.n_a
    a_ids, a_text, b_ids, b_text = ids[is_a], text_of[is_a], ids[~is_a], text_of[~is_a]
    n_a, n_b = np.bincount(a_text, minlength=n), np.bincount(b_text, minlength=n)
    # both sides have the same bytes in every text that is left, so that one axis serves all texts
    a_end, b_end = np.cumsum(pair.size[a_ids]), np.cumsum(pair.size[b_ids])
    a_cut, b_cut = np.zeros(len(a_ids), dtype=bool), np.zeros(len(b_ids), dtype=bool)
    a_cut[np.cumsum(n_a)[n_a > 0] - 1] = True
    b_cut[np.cumsum(n_b)[n_b > 0] - 1] = True
    common_ends(a_end, b_end, a_cut, b_cut)
    n_groups = np.bincount(a_text[a_cut], minlength=n)
    groups = _digests(pair, a_ids, b_ids, a_cut, b_cut, n_a + n_b)

    a, b = links(a_end, b_end)
    n_links = np.bincount(a_text[a], minlength=n)
    codes = (a_ids[a].astype(np.int64) << 32) | (b_ids[b] - pair.n_a)
    pairs, which = np.unique(codes, return_inverse=True)
    counts = np.bincount(which, minlength=len(pairs))
    # pairs of one text, each once with its number
    keys, times = np.unique(a_text[a] * max(len(pairs), 1) + which, return_counts=True)
    upto = np.cumsum(np.bincount(keys // max(len(pairs), 1), minlength=n)) if len(keys) else np.zeros(n, dtype=np.int64)
    return Aligned(n_a, n_b, n_groups, n_links, groups, pairs, counts, upto, keys % max(len(pairs), 1), times)


def _digests(pair: Pair, a_ids: np.ndarray, b_ids: np.ndarray, a_cut: np.ndarray, b_cut: np.ndarray, sizes: np.ndarray) -> list[str]:
    """Per text the sha-256 of its groups as written in the module's contract; '' without tokens."""
    n_ids = pair.n_a + pair.n_b
    a_group, b_group = np.cumsum(a_cut) - a_cut, np.cumsum(b_cut) - b_cut
    # A's tokens of a group stand before B's
    a_upto, b_from = np.flatnonzero(a_cut) + 1, np.concatenate([[0], np.flatnonzero(b_cut) + 1])
    order = np.zeros(len(a_ids) + len(b_ids), dtype=np.int64)
    order[np.arange(len(a_ids)) + b_from[a_group]] = a_ids + a_cut * n_ids
    order[np.arange(len(b_ids)) + a_upto[b_group]] = b_ids + b_cut * n_ids
    written, at, out = pair.written[order], 0, []
    for size in sizes.tolist():
        out.append(hashlib.sha256(b"".join(written[at:at + size].tolist())[:-1]).hexdigest() if size else "")
        at += size
    return out


# --- corpus --------------------------------------------------------------------------------------

_BLOCK = (
    "block long, ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups array<string>, "
    "pairs array<long>, counts array<long>, upto binary, which binary, times binary"
)


def _lists(*columns: np.ndarray | list, kind: pa.DataType) -> list[pa.Array]:
    return [pa.array([c.tolist() if isinstance(c, np.ndarray) and kind == pa.string() else c], pa.list_(kind)) for c in columns]


def blocks(docs: DataFrame, a_json: str, b_model: bytes, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One packed row per batch of texts (see `Aligned`), written once."""
    spark = docs.sparkSession
    ship_package(spark, "millrace")
    held = spark.sparkContext.broadcast((a_json, b_model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pair, number = _pair(*held.value), TaskContext.get().partitionId() << 32
        for batch in batches:
            at = 0
            for texts in slices(pc.fill_null(batch.column(1), ""), SLICE):
                found = align(pair, texts)
                names = batch.column(0).slice(at, len(texts))
                at += len(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number], pa.int64()), pa.ListArray.from_arrays([0, len(texts)], names),
                        *_lists(found.n_a, found.n_b, found.n_groups, found.n_links, kind=pa.int64()), *_lists(found.groups, kind=pa.string()),
                        *_lists(found.pairs, found.counts, kind=pa.int64()),
                        *(pa.array([x.astype(t).tobytes()], pa.binary()) for x, t in ((found.upto, "<i8"), (found.which, "<i4"), (found.times, "<i4"))),
                    ],
                    ["block", "ids", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "counts", "upto", "which", "times"],
                )
                number += 1

    rows = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("text"))
    return materialize(rows.mapInArrow(run, _BLOCK), "aligned")


def _pair(a_json: str, b_model: bytes) -> Pair:
    key = hash((a_json, b_model))
    if key not in _workers:
        _workers.clear()
        _workers[key] = Pair(a_json, b_model)
    return _workers[key]


def pair_counts(packed: DataFrame) -> DataFrame:
    """(`pair`, `n`, `best`): links of each id pair in the corpus; `best` marks the highest of its B id."""
    each = packed.select(F.explode(F.arrays_zip("pairs", "counts")).alias("p")).select(F.col("p.pairs").alias("pair"), F.col("p.counts").alias("n"))
    total = materialize(each.groupBy("pair").agg(F.sum("n").alias("n")), "pair_counts")
    # a B id has at most as many pairs as A has ids
    top = total.groupBy(F.col("pair").bitwiseAND((1 << 32) - 1).alias("b")).agg(F.max("n").alias("most"))
    own = total.withColumn("b", F.col("pair").bitwiseAND((1 << 32) - 1)).join(top, "b")
    return own.select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def scored(packed: DataFrame, counts: DataFrame) -> DataFrame:
    """Rows per document: `id`, its numbers, `n_best`, `count_sum`, `groups`."""
    asked = packed.select("block", F.explode("pairs").alias("pair")).join(counts, "pair")
    # as many as the block has distinct pairs
    known = asked.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("pair", "n", "best"))).alias("known"))
    kept = ["ids", "n_a", "n_b", "n_groups", "n_links", "groups"]
    met = packed.select("block", *kept, "upto", "which", "times").join(known, "block", "left")
    rows = met.select(*kept, "upto", "which", "times", F.col("known.n").alias("n"), F.col("known.best").alias("best"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                part = {name: batch.column(name)[r] for name in batch.schema.names}
                upto, which, times = (np.frombuffer(part[c].as_buffer(), t) for c, t in (("upto", "<i8"), ("which", "<i4"), ("times", "<i4")))
                if part["n"].is_valid:
                    n = part["n"].values.to_numpy(zero_copy_only=False)
                    best = part["best"].values.to_numpy(zero_copy_only=False)
                    sums = np.concatenate([[0], np.cumsum(n[which] * times)])
                    bests = np.concatenate([[0], np.cumsum(best[which] * times.astype(np.int64))])
                else:
                    sums = bests = np.zeros(1, dtype=np.int64)
                before = np.concatenate([[0], upto[:-1]])
                yield pa.RecordBatch.from_arrays(
                    [*(part[c].values for c in kept), pa.array(bests[upto] - bests[before], pa.int64()), pa.array(sums[upto] - sums[before], pa.int64())],
                    ["id", "n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum"],
                )

    return rows.mapInArrow(run, "id long, n_a long, n_b long, n_groups long, n_links long, groups string, n_best long, count_sum long")


def aligned(docs: DataFrame, a_json: str, b_model: bytes, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    packed = blocks(docs, a_json, b_model, doc_id, text)
    found = scored(packed, pair_counts(packed))
    return found.select(F.col("id").alias(doc_id), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))

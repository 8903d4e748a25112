"""SentencePiece encoding and decoding on the tokenizers library.

The model file is read field by field and rebuilt: normaliser (its compiled map, extra spaces, the
leading space), the metaspace marker, unigram scores or pair merges ordered by score, byte fallback,
user-defined and control pieces. Each worker builds the tokenizer once and encodes batches with the
library's threads.

Where no piece has the marker behind another character, pieces never cross the start of a word, so
the marker splits a text without changing its ids, and words are encoded once per worker (`words`).
Parity is verified as it goes: every word (or whole text) that the backend encodes is encoded by the
sentencepiece library too, and where they differ sentencepiece's ids stand and `parity` is false.

Reading back puts the bytes of a document's pieces in a row and compares them with its text; where they
differ the library's decoder has the last word. Equal bytes are what the decoder gives: pieces other than
bytes hold whole characters, so a run of byte pieces inside a valid text is valid itself.

Defined results: null text is empty and has no ids; every row is encoded by itself; other columns
stay as they are.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .words import WordTable, slices

MARK = "▁"
# documents decoded at once: a list of ids takes far more room than the array
LOT = 256
# words a worker keeps, and bytes of text split into words at once: as fast as twice of both
KNOWN, LOT_BYTES = 400_000, 2 << 20
# fixed values of the file format
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6

_workers: dict[int, "Backend"] = {}


# --- model file ----------------------------------------------------------------------------------


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value, shift, at = value | (byte & 127) << shift, shift + 7, at + 1
        if byte < 128:
            return value, at


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protobuf message: integers as such, all else as bytes."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(data, at)
            yield tag >> 3, value
            continue
        if kind == 2:
            size, at = _varint(data, at)
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
        else:
            raise ValueError(f"unknown wire type {kind}")
        yield tag >> 3, data[at:at + size]
        at += size


@dataclass
class Model:
    pieces: list[tuple[str, float, int]]
    kind: int = UNIGRAM
    byte_fallback: bool = False
    unk_id: int = 0
    charsmap: bytes = b""
    dummy_prefix: bool = True
    collapse_spaces: bool = True
    escape_spaces: bool = True

    @property
    def separable(self) -> bool:
        """Whether words can be encoded apart."""
        inside = any(MARK in p.lstrip(MARK) for p, _, t in self.pieces if t in (NORMAL, USER_DEFINED))
        return not (inside or self.charsmap or self.collapse_spaces) and self.escape_spaces and self.dummy_prefix


def parse(data: bytes) -> Model:
    """The parts of a model file that encoding needs."""
    model = Model([])
    for number, value in fields(data):
        if number == 1:
            piece = dict(fields(value))
            score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
            model.pieces.append((piece.get(1, b"").decode(), score, piece.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(fields(value))
            model.kind = trainer.get(3, UNIGRAM)
            model.byte_fallback = bool(trainer.get(35, 0))
            model.unk_id = trainer.get(40, 0)
        elif number == 3:
            rule = dict(fields(value))
            model.charsmap = rule.get(2, b"")
            model.dummy_prefix, model.collapse_spaces, model.escape_spaces = (bool(rule.get(k, 1)) for k in (3, 4, 5))
    return model


# --- tokenizer -----------------------------------------------------------------------------------


def merges(model: Model) -> list[tuple[str, str]]:
    """Every way to put a piece together from two others, best score first, as pairs of known pieces."""
    place = {p: i for i, (p, _, t) in enumerate(model.pieces) if t in (NORMAL, USER_DEFINED, UNUSED)}
    found = []
    for piece, i in place.items():
        for cut in range(1, len(piece)):
            left, right = place.get(piece[:cut]), place.get(piece[cut:])
            if left is not None and right is not None:
                found.append((-model.pieces[i][1], i, left, right))
    return [(model.pieces[a][0], model.pieces[b][0]) for _, _, a, b in sorted(found)]


def build(model: Model):
    """The model as a `tokenizers.Tokenizer`."""
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    names = [p for p, _, _ in model.pieces]
    if model.kind == UNIGRAM:
        core = models.Unigram([(p, s) for p, s, _ in model.pieces], unk_id=model.unk_id, byte_fallback=model.byte_fallback)
    elif model.kind == BPE:
        core = models.BPE(
            {p: i for i, p in enumerate(names)}, merges(model), unk_token=names[model.unk_id], fuse_unk=True, byte_fallback=model.byte_fallback
        )
    else:
        raise ValueError("only unigram and BPE models")
    tokenizer = Tokenizer(core)

    steps = []
    if model.charsmap:
        steps.append(normalizers.Precompiled(model.charsmap))
    if model.collapse_spaces:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(MARK if model.escape_spaces else " "))
    if model.escape_spaces:
        steps.append(normalizers.Replace(" ", MARK))
    tokenizer.normalizer = normalizers.Sequence(steps)
    if model.separable:
        tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}+[^{MARK}]*|[^{MARK}]+"), "isolated")

    own = [AddedToken(p, normalized=False) for p, _, t in model.pieces if t == USER_DEFINED]
    if own:
        tokenizer.add_tokens(own)
    undo = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    if model.dummy_prefix:
        undo.append(decoders.Strip(content=" ", left=1, right=0))
    tokenizer.decoder = decoders.Sequence(undo)
    return tokenizer


def spoken(tokenizer) -> pa.LargeBinaryArray:
    """The bytes that each id stands for, by the steps of `build`'s decoder: marker to space, byte pieces to their byte."""
    out = []
    for i in range(max(tokenizer.get_vocab(with_added_tokens=True).values(), default=-1) + 1):
        piece = (tokenizer.id_to_token(i) or "").replace(MARK, " ")
        byte = re.fullmatch("<0x([0-9A-Fa-f]{2})>", piece)
        out.append(bytes([int(byte[1], 16)]) if byte else piece.encode())
    return pa.array(out, pa.large_binary())


class Backend:
    """Encoder and decoder of one worker."""

    def __init__(self, data: bytes):
        import sentencepiece

        self.model = parse(data)
        self.tokenizer = build(self.model)
        self.reference = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.words = WordTable(self._verified, np.int32, KNOWN)
        self.spoken = spoken(self.tokenizer)

    def _verified(self, texts: list[str]) -> tuple[list[list[int]], list[bool]]:
        """The backend's own ids, and where they differ from sentencepiece's, which then stand."""
        own = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        want = self.reference.encode(texts, num_threads=1)
        differs = [a != b for a, b in zip(own, want, strict=True)]
        return [b if d else a for a, b, d in zip(own, want, differs, strict=True)], differs

    def encode(self, texts: pa.StringArray) -> tuple[list[np.ndarray], list[bool]]:
        """Ids per text and whether both libraries agree on it."""
        n = len(texts)
        if self.model.separable:
            # runs of spaces make pieces of their own, and the marker itself reads as a space
            whole = pc.match_substring_regex(texts, f"^ | $|  |{MARK}|^$").to_numpy(zero_copy_only=False)
        else:
            whole = np.ones(n, dtype=bool)
        ids: list[np.ndarray] = [np.zeros(0, dtype=np.int32)] * n
        agree = [True] * n
        plain, odd = np.flatnonzero(~whole), np.flatnonzero(whole)
        if len(plain):
            flat, ends, differs = self.words.gather(pc.split_pattern(texts.take(pa.array(plain)), " "))
            for i, part, d in zip(plain.tolist(), np.split(flat, ends[:-1]), differs.tolist(), strict=True):
                ids[i], agree[i] = part, not d
        if len(odd):
            for i, found, d in zip(odd.tolist(), *self._verified(texts.take(pa.array(odd)).to_pylist()), strict=True):
                ids[i], agree[i] = np.array(found, dtype=np.int32), not d
        return ids, agree

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        return self.tokenizer.decode_batch([i.tolist() for i in ids], skip_special_tokens=True)

    def reads_back(self, ids: list[np.ndarray], texts: pa.StringArray) -> list[bool]:
        """Whether each text is what its ids decode to."""
        same = np.zeros(len(ids), dtype=bool)
        flat = np.concatenate(ids) if ids else np.zeros(0, dtype=np.int32)
        if len(flat):
            said = self.spoken.take(pa.array(flat))
            ends = np.cumsum([0, *map(len, ids)])
            offsets = np.frombuffer(said.buffers()[1], dtype=np.int64, count=len(flat) + 1)[ends]
            read = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(offsets), said.buffers()[2]])
            want = texts.cast(pa.large_binary())
            if self.model.dummy_prefix:
                want = pc.binary_join_element_wise(pa.scalar(b"", pa.large_binary()), want, pa.scalar(b" ", pa.large_binary()))
            same = pc.equal(read, want).to_numpy(zero_copy_only=False).copy()
        others = np.flatnonzero(~same)
        for at in range(0, len(others), LOT):
            lot = others[at:at + LOT]
            known = texts.take(pa.array(lot)).to_pylist()
            same[lot] = [a == b for a, b in zip(self.decode([ids[i] for i in lot]), known, strict=True)]
        return same.tolist()


def _backend(data: bytes, threads: int) -> Backend:
    key = hash(data)
    if key not in _workers:
        # the library reads both when it first runs; a worker has the cores of one task, not the machine's
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        _workers.clear()
        _workers[key] = Backend(data)
    return _workers[key]


def encode_documents(docs: DataFrame, model: bytes, text: str = "text", threads: int = 2) -> DataFrame:
    """`docs` with `ids` (array<int>), `n_tokens`, `ids_crc32`, `parity`, and `round_trip`: whether the
    ids read back as the text. `model` is the file's content (under a MB), carried in the task."""
    spark = docs.sparkSession
    ship_package(spark, "millrace")
    held = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        backend = _backend(held.value, threads)
        for batch in batches:
            ids, agree, back = [], [], []
            for texts in slices(pc.fill_null(batch, ""), LOT_BYTES):
                found, same = backend.encode(texts)
                ids += found
                agree += same
                back += backend.reads_back(found, texts)
            sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            flat = pa.array(np.concatenate(ids) if ids else np.zeros(0, dtype=np.int32), pa.int32())
            sums = [zlib.crc32(i.astype("<u4").tobytes()) for i in ids]
            ids.clear()
            yield pa.StructArray.from_arrays(
                [pa.ListArray.from_arrays(offsets, flat), pa.array(sizes), pa.array(sums, pa.int64()), pa.array(agree, pa.bool_()), pa.array(back, pa.bool_())],
                ["ids", "n_tokens", "ids_crc32", "parity", "round_trip"],
            )

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    kind = "ids array<int>, n_tokens long, ids_crc32 long, parity boolean, round_trip boolean"
    coded = docs.select(F.struct("*").alias("_row"), F.arrow_udf(run, kind)(F.col(text)).alias("_code"))
    added = ("ids", "n_tokens", "ids_crc32", "parity", "round_trip")
    return coded.select(*[F.col("_row")[c].alias(c) for c in docs.columns if c.lower() not in added], *[F.col("_code")[c].alias(c) for c in added])


def decode_documents(coded: DataFrame, model: bytes, ids: str = "ids") -> DataFrame:
    """`coded` with `decoded`, the text of its ids by the tokenizers library; null ids give null."""
    spark = coded.sparkSession
    ship_package(spark, "millrace")
    held = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        backend = _backend(held.value, 2)
        for batch in batches:
            known = batch.to_pylist()
            texts = iter(backend.tokenizer.decode_batch([i for i in known if i is not None], skip_special_tokens=True))
            yield pa.array([None if i is None else next(texts) for i in known], pa.string())

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return coded.withColumn("decoded", F.arrow_udf(run, "string")(F.col(ids)))

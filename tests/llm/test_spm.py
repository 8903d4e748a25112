import random
import struct

import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from millrace.llm import spm
from millrace.llm.queries import model_file

FILE = model_file("piece_bpe_32k.model")
TEXTS = [
    "Hello  world", None, "", "  a", " ", "a\nb\tc", "é ü ́x", "<s> x </s> <unk> <0x0A>", "　x", "a \n b", "日本 🎉 \U0001F9EA", "x" * 3000, "a b ",
    "aaaaaaaaab ttttthe", " " * 50, "word " * 20_000 + "end", "▁a b",
]


@pytest.fixture(scope="module")
def reference():
    return sentencepiece.SentencePieceProcessor(model_proto=FILE)


def test_parity_of_the_rebuilt_tokenizer(reference):
    tokenizer = spm.build(spm.parse(FILE))
    draw = random.Random(1)
    letters = "etaoin shrdluéü日\n.,-0123 THE▁"
    texts = [t or "" for t in TEXTS] + ["".join(draw.choice(letters) for _ in range(draw.randrange(80))) for _ in range(2000)]
    for text in texts:
        assert tokenizer.encode(text, add_special_tokens=False).ids == reference.encode(text)
        assert tokenizer.decode(reference.encode(text)) == reference.decode(reference.encode(text))


def test_documents(spark, reference):
    docs = spark.createDataFrame([(i, t, 9) for i, t in enumerate(TEXTS)] * 2, "doc_id long, text string, Ids int").withColumn("_code", F.lit("kept"))
    coded = spm.encode_documents(docs, FILE)
    assert coded.columns == ["doc_id", "text", "_code", "ids", "n_tokens", "ids_crc32", "parity", "round_trip"]
    for r in coded.collect():
        text = TEXTS[r["doc_id"]] or ""
        assert r["ids"] == reference.encode(text) and r["n_tokens"] == len(r["ids"]) and r["parity"]
        assert r["round_trip"] == ("▁" not in text)
    back = spm.decode_documents(coded, FILE).select("doc_id", "decoded").collect()
    assert all(r["decoded"] == (TEXTS[r["doc_id"]] or "").replace("▁", " ") for r in back)
    assert spm.encode_documents(docs.limit(0), FILE).count() == 0


def test_words_of_a_full_table_are_encoded_again(reference):
    backend = spm.Backend(FILE)
    backend.words.most = 5
    texts = ["one two three four", "five six seven", "one nine"]
    for _ in range(2):
        ids, agree = backend.encode(pa.array(texts))
        assert [i.tolist() for i in ids] == [reference.encode(t) for t in texts] and all(agree)


class Ids(list):
    """Ids known to come from the rebuilt tokenizer."""


def test_ids_are_the_backends_own_where_both_agree(reference):
    backend = spm.Backend(FILE)
    own = backend.tokenizer

    class Marked:
        def encode_batch_fast(self, texts, add_special_tokens):
            found = [e.ids for e in own.encode_batch_fast(texts, add_special_tokens=add_special_tokens)]
            return [type("Encoded", (), {"ids": Ids([7] if t == "odd" else i)}) for t, i in zip(texts, found, strict=True)]

    backend.tokenizer = Marked()
    ids, differs = backend._verified(["Hello world", "odd"])
    assert differs == [False, True] and isinstance(ids[0], Ids)
    assert ids == reference.encode(["Hello world", "odd"])


def message(*parts):
    out = b""
    for number, value in parts:
        if isinstance(value, int):
            out += bytes([number * 8]) + bytes([value])
        elif isinstance(value, float):
            out += bytes([number * 8 + 5]) + struct.pack("<f", value)
        else:
            out += bytes([number * 8 + 2, len(value)]) + value
    return out


def test_unigram_model_with_spaces_collapsed():
    pieces = [("<unk>", 0.0, 2), ("▁a", -1.0, 1), ("▁ab", -1.5, 1), ("b", -2.0, 1), ("▁", -3.0, 1), ("a", -2.5, 1)]
    data = b"".join(message((1, message((1, p.encode()), (2, s), (3, t)))) for p, s, t in pieces)
    data += message((2, message((3, 1))), (3, message((3, 1), (4, 1), (5, 1))))
    model = spm.parse(data)
    assert (model.kind, model.byte_fallback, model.separable) == (spm.UNIGRAM, False, False)
    tokenizer = spm.build(model)
    reference = sentencepiece.SentencePieceProcessor(model_proto=data)
    for text in ("ab", "a b", "  a   ab ", "abba", "aab bb"):
        assert tokenizer.encode(text, add_special_tokens=False).ids == reference.encode(text)


def test_fields_of_all_wire_types():
    data = bytes([1 * 8, 0xAC, 0x02]) + bytes([2 * 8 + 1]) + b"12345678" + bytes([3 * 8 + 2, 2]) + b"ab" + bytes([4 * 8 + 5]) + b"wxyz"
    assert list(spm.fields(data)) == [(1, 300), (2, b"12345678"), (3, b"ab"), (4, b"wxyz")]
    with pytest.raises(ValueError):
        list(spm.fields(bytes([3])))


def test_only_texts_that_differ_go_through_the_decoder(monkeypatch):
    backend = spm.Backend(FILE)
    texts = [t or "" for t in TEXTS] + ["🤖 \x00 \U0010FFFF", "a▁", "<0x41> <0xE2><0x96><0x81>"]
    ids, _ = backend.encode(pa.array(texts))
    library, asked = backend.decode, []
    want = [a == b for a, b in zip(library(ids), texts, strict=True)]
    monkeypatch.setattr(backend, "decode", lambda part: asked.extend(part) or library(part))
    assert backend.reads_back(ids, pa.array(texts)) == want
    # what has no ids, and what the marker makes differ
    assert len(asked) == sum(not t or "▁" in t for t in texts)
    wrong = [i[::-1].copy() for i in ids]
    assert backend.reads_back(wrong, pa.array(texts)) == [a == b for a, b in zip(library(wrong), texts, strict=True)]
    assert backend.reads_back([], pa.array([], pa.string())) == []

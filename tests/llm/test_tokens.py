import json
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import tokens
from millrace.llm.queries import tokenizer_file

SOURCE = open(tokenizer_file("word_bpe_49k.json"), encoding="utf-8").read()


@pytest.mark.parametrize("values", [[], [0], [5], [0, 0, 0], list(range(300)), [7] * 100, [0, 1 << 40, (1 << 40) + 1], [3, 900, 901, 70_000, 70_001]])
def test_elias_fano(values):
    ef = tokens.EliasFano(memoryview(tokens.ef_encode(np.array(values, dtype=np.uint64))))
    assert ef.all().tolist() == values and [ef.select(i) for i in range(len(values))] == values


def test_elias_fano_is_small():
    draw = np.sort(np.random.default_rng(1).integers(0, 1 << 20, 20_000))
    data = tokens.ef_encode(draw)
    assert len(data) * 8 < 20_000 * (2 + np.log2((1 << 20) / 20_000) + 1)
    ef = tokens.EliasFano(memoryview(data))
    assert [ef.select(i) for i in range(0, 20_000, 371)] == draw[::371].tolist()


def test_files_read_back(spark, tmp_path):
    from tokenizers import Tokenizer

    draw = random.Random(4)
    words = ["the", "Don't", "naïve", "éa", "<|endoftext|>", "日本", "x" * 300, "a.b,c", "12", "ΑΣ", " ", "\x00"]
    texts = [" ".join(draw.choice(words) for _ in range(draw.randrange(30))) for _ in range(300)] + [None, "", " \n", "  lead\ttrail  ", "long " * 60_000]
    rows = [(i * 7 - 900, t, 1) for i, t in enumerate(texts)] + [(5, "b", 0), (5, "a", 0), (None, "n", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start int")
    path = str(tmp_path / "segments")
    tokens.write(docs, path, SOURCE, 2, segment=500)
    got = sorted(tokens.read(spark, path).collect(), key=lambda r: r["start"])
    library = Tokenizer.from_str(SOURCE)
    at = 0
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    for r, (doc_id, text, _) in zip(got, ordered, strict=True):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert spark.read.parquet(path).count() > 20


def test_empty_table(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert tokens.write_and_read(empty, SOURCE, 2).count() == 0


def test_large_ids_take_four_bytes():
    data = tokens.pack([1, None][:1], np.array([2]), np.array([70_000, 3]), 0, 4)
    assert tokens.Segment(data).document(0)[1].tolist() == [70_000, 3]
    assert tokens.Segment(tokens.pack([-(1 << 62), (1 << 62)], np.array([0, 1]), np.array([9]), 0, 2)).doc_ids() == [-(1 << 62), 1 << 62]
    with pytest.raises(ValueError):
        tokens.Segment(b"x" * 100)


def random_words(seed, n=5000):
    draw = random.Random(seed)
    return ["".join(draw.choice("aeinstrTHE.,!?'éÀßÿ×1\u0301") for _ in range(draw.randrange(1, 12))) for _ in range(n)]


def test_words_taken_apart_give_the_librarys_ids():
    encoder = tokens.Encoder(SOURCE, most=50)
    assert encoder.apart
    words = random_words(8)
    for lot in range(0, 5000, 40):
        ids, ends = encoder.encode(pa.array(words[lot:lot + 40]))
        got = np.split(ids, ends[:-1])
        assert [g.tolist() for g in got] == [e.ids for e in encoder.tokenizer.encode_batch(words[lot:lot + 40], add_special_tokens=False)]
    ids, ends = encoder.encode(pa.array(["", " ", "a b", ""]))
    assert ends.tolist() == [0, 0, 2, 2]


def test_other_tokenizers_get_whole_texts(spark, tmp_path):
    """One that keeps white space, and one that differs in a setting."""
    other = open(tokenizer_file("byte_bpe_50k.json"), encoding="utf-8").read()
    assert not tokens.takes_apart(other) and tokens.takes_apart(SOURCE)
    for change in ('"invert":false', '"use_regex":true'):
        name = change.split(":")[0]
        altered = json.loads(SOURCE)
        for step in altered["pre_tokenizer"]["pretokenizers"]:
            if name.strip('"') in step:
                step[name.strip('"')] = json.loads(change.split(":")[1])
        assert not tokens.takes_apart(json.dumps(altered))
    texts = ["two  spaces\n\n and  lines ", "", None, "x" * 3000, *[" ".join(random_words(3, 30)) for _ in range(20)]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    from tokenizers import Tokenizer

    library = Tokenizer.from_str(other)
    got = {r["doc_id"]: r for r in tokens.write_and_read(docs, other, 2).collect()}
    for i, text in enumerate(texts):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        assert (got[i]["n_tokens"], got[i]["ids_crc32"]) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))


def test_one_id_in_a_third_of_the_rows_is_dealt_to_several_tasks(spark, tmp_path):
    """Half of them even the same row; offsets still tile the whole."""
    rows = [(7, f"text number {i}") for i in range(1000)] + [(7, "the same row")] * 1000 + [(i + 100, f"other {i}") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    path = str(tmp_path / "segments")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tokens.write(docs, path, SOURCE, 2, segment=200)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    per_task = [r["sum(n_docs)"] for r in spark.read.parquet(path).groupBy("task").sum("n_docs").collect()]
    assert len(per_task) == 4 and max(per_task) < 2100
    got = sorted(tokens.read(spark, path).collect(), key=lambda r: r["start"])
    assert len(got) == 6000 and all(a["start"] + a["n_tokens"] == b["start"] and a["doc_id"] <= b["doc_id"] for a, b in zip(got, got[1:], strict=False))


def test_word_table_keeps_what_comes_again():
    """Thinned or cleared, it gives the same ids, within its bound."""
    from millrace.llm.words import WordTable

    calls = []

    def encode(words):
        calls.extend(words)
        return [[len(w), *map(ord, w)] for w in words], [w.startswith("m") for w in words]

    table, draw = WordTable(encode, np.int32, most=60), random.Random(1)
    for turn in range(200):
        words = ["often", "many", "", *{f"{draw.choice('mn')}{draw.randrange(4000)}" for _ in range(20)}]
        ids, ends, marked = table.gather(pa.array([words, [], words[:2]]))
        want = [i for w in words for i in (len(w), *map(ord, w))]
        assert ids.tolist() == want + [5, *map(ord, "often"), 4, *map(ord, "many")] and ends.tolist() == [len(want), len(want), len(ids)]
        assert marked.tolist() == [True, False, True] and len(table.place) <= 60 + 23
    assert calls.count("often") < 5

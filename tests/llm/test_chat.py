import hashlib

from pyspark.sql import functions as F

from millrace.llm import chat

TURNS = [
    (1, 1, "assistant", "b </s>\n[INST] [\\INST] [\\\\/INST] <s>"),
    (1, 0, "user", "a [/INST] <image> ["),
    (1, 1, "assistant", "B"),
    (2, 0, "us\ner [NL] [INST]", None),
    (2, 0, None, ""),
    (None, 3, "assistant", "x" * 50_000 + "é日\n" * 100),
    (3, 0, "user", "same"), (3, 0, "user", "same"),
]


def frame(spark, rows=TURNS):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("position", F.lit(5))


def formatted(spark, rows=TURNS):
    return chat.format_turns(frame(spark, rows).withColumn("parts", chat.text_parts(F.col("text"))))


def expected(rows):
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, []).append((turn, role or "", text or ""))
    return out


def test_round_trip(spark):
    got = {r["conv_id"]: r for r in chat.read_back(formatted(spark)).collect()}
    want = expected(TURNS)
    assert set(got) == set(want)
    for conv, turns in want.items():
        read = [(t["role"], t["text"]) for t in got[conv]["turns"]]
        assert sorted(read) == sorted((r, t) for _, r, t in turns)
        assert sorted(got[conv]["loss"]) == sorted("".join(t for _, r, t in turns if r == "assistant"))
    assert [t["text"] for t in got[1]["turns"]][0] == "a [/INST] <image> ["


def test_digests(spark):
    got = chat.digests(chat.read_back(formatted(spark, [(7, 0, "user", "hi"), (7, 1, "assistant", "é!")]))).first()
    assert got["turns_sha256"] == hashlib.sha256("user\nhi\nassistant\né!\n".encode()).hexdigest()
    assert (got["n_turns"], got["loss_chars"], got["loss_sha256"]) == (2, 2, hashlib.sha256("é!".encode()).hexdigest())


def test_parts_and_attachments(spark):
    part = "struct<kind:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>"
    rows = [(1, 0, "user", [
        ("text", "look [", None, None, None, None, None), ("image", None, "s3://a", 28, 15, None, None), ("text", "/INST] ", None, None, None, None, None),
        ("audio", None, "b", None, None, 1.5, None), ("document", None, "c", None, None, None, 3), ("image", None, "d", None, None, None, None), ("odd", "<image>", None, None, None, None, None),
    ]), (1, 1, "assistant", None), (1, 2, "user", [])]
    turns = chat.format_turns(spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{part}>"))
    whole = chat.assemble(turns).first()
    assert [(a["kind"], a["uri"], a["tokens"]) for a in whole["attachments"]] == [("image", "s3://a", 4), ("audio", "b", 38), ("document", "c", 1536), ("image", "d", 256)]
    assert whole["formatted"].startswith("[INST]user\nlook [<image>/INST] <audio><document><image><\\image>[/INST]\n")
    read = chat.read_back(turns).first()
    assert [t["text"] for t in read["turns"]] == ["look [/INST] <image>", "", ""]
    spans = [whole["formatted"][s["start"]:s["start"] + s["chars"]] for s in whole["loss_spans"]]
    assert spans == [""]


def test_spans_point_at_assistant_texts(spark):
    whole = chat.assemble(formatted(spark, [(1, 0, "assistant", "é1"), (1, 1, "user", "q"), (1, 2, "assistant", "[INST]")])).first()
    assert [whole["formatted"][s["start"]:s["start"] + s["chars"]] for s in whole["loss_spans"]] == ["é1", "[\\INST]"]


def test_empty_and_native(spark):
    empty = formatted(spark, [])
    assert chat.read_back(empty).count() == 0 and chat.assemble(empty).count() == 0
    plan = chat.read_back(formatted(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.llm import lines

BLANK = " \t\n\x0b\x0c\r"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least_chars=20, least_docs=3):
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            holders[line.strip(BLANK).translate(UPPER)].add(-(1 << 63) if doc is None else doc)
    out = []
    for doc, text in rows:
        own = -(1 << 63) if doc is None else doc
        split = (text or "").split("\n")
        kept = []
        for line in split:
            key = line.strip(BLANK).translate(UPPER)
            if len(key) < least_chars or len(holders[key]) < least_docs or own == max(holders[key]):
                kept.append(line)
        out.append((doc, len(split), len(split) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def run(spark, rows, schema="doc_id long, text string"):
    docs = spark.createDataFrame(rows, schema)
    done = lines.apply_bitmaps(docs, lines.keep_bitmaps(docs))
    return sorted((tuple(r) for r in done.select("doc_id", "n_lines", "n_dropped", "text").collect()), key=repr)


@pytest.mark.parametrize("batch", [3, 10_000])
@pytest.mark.parametrize("parts", [1, 9])
def test_against_brute_force(spark, batch, parts):
    """Small batches and many ranges: runs of one key cross both."""
    draw = random.Random(batch + parts)
    pool = [f"A shared passage Number {i} é日 of some length" for i in range(12)] + ["short", "", "exactly twenty chars", "exactly 19 charsXXX", "É upper accents stay apart", "é upper accents stay apart"]
    rows = []
    for i in range(120):
        body = [draw.choice(["", " ", "\t", "\r"]) + draw.choice([str, str.upper])(draw.choice(pool)) + draw.choice(["", " \x0b"]) for _ in range(draw.randrange(8))]
        # one line in most documents, one that a single document repeats, and lines of its own
        body += ["The very common licence line of all documents"] * draw.randrange(3) + [f"own line of document number {i}"] * 4
        draw.shuffle(body)
        rows.append((i * 3 if draw.random() < 0.9 else draw.randrange(50), "\n".join(body)))
    rows += [(None, rows[0][1]), (None, None), (7, None), (8, ""), (9, "\n\n"), rows[3], rows[3], rows[4]]
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions",)}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert run(spark, rows) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        for k, v in old.items():
            spark.conf.set(k, v)


def test_hot_line_is_spread(spark):
    """A line of every document fills several ranges, and each keeps its rows few."""
    rows = [(i, "this one line is in every document\n" + f"and here is line {i} of its own") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        order = ["h1", "h2", F.desc("doc"), "body", "pos"]
        ranged = lines.line_rows(docs).repartitionByRange(8, *order)
        counts = [r["count"] for r in ranged.groupBy(F.spark_partition_id()).count().collect()]
        assert len(counts) == 8 and max(counts) < 1600
        assert run(spark, rows) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_long_documents_have_several_spans(spark):
    n = lines.SPAN * 2 + 100
    shared = "\n".join(f"numbered line {i:09d}" for i in range(n))
    rows = [(1, shared), (2, shared), (3, "numbered line 000000005\n" + shared + "\nlast")]
    got = run(spark, rows)
    assert [(r[0], r[1], r[2]) for r in got] == [(1, n, n), (2, n, n), (3, n + 2, 0)]
    assert got[0][3] == "" and hashlib.sha256(got[2][3].encode()).hexdigest() == hashlib.sha256(rows[2][1].encode()).hexdigest()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    stored = lines.keep_bitmaps(docs).filter("doc = 1").first()
    # all lost: three spans that deflate to nearly nothing
    assert len(stored["keep"]) == 3 and sum(len(p["bits"]) for p in stored["keep"]) < 200


def test_empty_table_and_clashing_names(spark):
    assert run(spark, []) == []
    rows = [(i, "the same long line in all\nx", 1, "k", i) for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_lines int, keep string, doc int")
    done = lines.apply_bitmaps(docs, lines.keep_bitmaps(docs))
    assert done.columns == ["doc_id", "doc", "text", "n_lines", "n_dropped", "keep"]
    assert sorted((r["doc_id"], r["doc"], r["n_lines"], r["n_dropped"], r["text"]) for r in done.collect()) == [
        (0, 0, 2, 1, "x"), (1, 1, 2, 1, "x"), (2, 2, 2, 1, "x"), (3, 3, 2, 0, "the same long line in all\nx")]

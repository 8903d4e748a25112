import random
import re

import xxhash
from pyspark.sql import functions as F

from millrace.llm import simhash
from millrace.llm.components import connected


def brute(text, width=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + width]) for i in range(len(words) - width + 1)] or [" ".join(words)]
    votes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in votes) > len(votes))


def groups(prints):
    """Least id reachable over fingerprints that differ in at most three bits."""
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_fingerprint_matches_brute_force(monkeypatch):
    draw = random.Random(2)
    texts = [None, "", " \t\n", "One", "A b", "a B\x0bc", "é\xa0Ä x y z", "w " * 500, " ".join(str(draw.randrange(50)) for _ in range(300))]
    assert [simhash.fingerprint(t) for t in texts] == [brute(t) for t in texts]
    monkeypatch.setattr(simhash, "_BLOCK", 16)
    assert [simhash.fingerprint(t) for t in texts] == [brute(t) for t in texts]


def test_components_match_brute_force(spark):
    draw = random.Random(5)
    near = [draw.getrandbits(64) for _ in range(12)]
    prints = {0: 0}
    for i in range(1, 260):
        p = near[i % 12] if i % 3 else draw.getrandbits(64)
        for _ in range(draw.randrange(0, 5)):
            p ^= 1 << draw.randrange(64)
        prints[i] = p
    rows = [(i, p - (1 << 64) if p >> 63 else p) for i, p in prints.items()]
    want = groups(prints)
    df = spark.createDataFrame(rows, "doc_id long, fp long")
    for few in (64, 1):  # by pairs, and by meeting points
        got = df.join(simhash.components(df, few), "fp").collect()
        assert {r["doc_id"]: r["component_id"] for r in got} == want


def test_dense_ball_has_no_pairs(spark):
    draw = random.Random(9)
    centre = draw.getrandbits(62)
    balls = sorted({centre ^ (1 << a) ^ (1 << b) for a in range(62) for b in range(a)})[:600]
    df = spark.createDataFrame([(p,) for p in balls], "fp long")
    found = simhash.links(df, few=8)
    assert all((r["a"] ^ r["b"]).bit_count() <= 3 for r in found.collect())
    roots = connected(found, "a", "b").select("root").distinct().count()
    prints = dict(enumerate(balls))
    assert roots == len(set(groups(prints).values()))


def test_documents(spark):
    words = [f"w{i}" for i in range(200)]
    text = " ".join(words)
    rows = [(3, text, 1), (1, text.upper(), 2), (7, None, 3), (6, " ", 4), (9, "other words stand here", 5), (9, "other words stand here", 6), (None, text, 7), (None, "alone and nameless it is", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int").withColumn("_row", F.lit("x"))
    got = sorted(((r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()), key=repr)
    assert got == sorted([(3, 1), (1, 1), (7, 6), (6, 6), (9, 9), (9, 9), (None, 1), (None, None)], key=repr)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 6, 9]
    assert simhash.keep_one(docs.limit(0)).count() == 0 and simhash.near_duplicates(docs.limit(0)).count() == 0


def test_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (5, 5)], "a long, b long")
    got = {r["node"]: r["root"] for r in connected(links, "a", "b").collect()}
    assert got == {**{i: 0 for i in range(301)}, 1000: 1000, 1001: 1000}


def test_one_segment_in_a_third_of_all_fingerprints(spark):
    """Its bucket is counted before its members meet; the links are those of brute force."""
    draw = random.Random(11)
    prints = {i: (7 << 32 | draw.getrandbits(32)) if i % 3 == 0 else draw.getrandbits(62) for i in range(900)}
    for i in range(0, 300, 3):
        prints[1000 + i] = prints[i] ^ (1 << draw.randrange(32)) ^ (1 << draw.randrange(60))
    df = spark.createDataFrame(list(prints.items()), "doc_id long, fp long")
    for few in (64, 4):
        got = df.join(simhash.components(df, few), "fp").collect()
        assert {r["doc_id"]: r["component_id"] for r in got} == groups(prints)

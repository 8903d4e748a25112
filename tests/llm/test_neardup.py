import random

import pytest

import corpus_pipeline
from millrace.llm import neardup, simhash


def brute(text):
    words = (text or "").lower().split()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def jaccard(a, b):
    a, b = brute(a), brute(b)
    return len(a & b) / len(a | b)


def changed(draw, words, alike):
    """A copy with words replaced one by one while it stays at least so alike."""
    out = list(words)
    while True:
        new = list(out)
        new[draw.randrange(len(new))] = f"x{draw.randrange(10**6)}"
        if jaccard(" ".join(words), " ".join(new)) < alike:
            return " ".join(out)
        out = new


def groups(texts):
    """Least id reachable over texts that are 0.8 or more alike."""
    ids = sorted(texts)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and jaccard(texts[a], texts[b]) >= 0.8:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {find(i) for i in ids}


@pytest.mark.parametrize("alike", [0.8, 0.9, 0.95])
def test_stage_drops_near_copies_and_keeps_the_rest(spark, alike):
    draw = random.Random(alike)
    texts = {}
    for i in range(60):
        words = [f"w{draw.randrange(3000)}" for _ in range(draw.randrange(120, 400))]
        texts[i] = " ".join(words)
        texts[1000 + i] = changed(draw, words, alike)
        texts[2000 + i] = changed(draw, words, 0.5)  # alike, but not enough
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    kept = {r["doc_id"] for r in dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, "").collect()}
    want = groups(texts)
    assert kept == want and len(want) < 130


def test_dense_groups_are_linked_in_cells(spark):
    draw = random.Random(4)
    words = [f"w{draw.randrange(3000)}" for _ in range(300)]
    texts = {i: changed(draw, words, 0.93) for i in range(150)}
    texts |= {500 + i: changed(draw, words, 0.4) for i in range(5)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r["doc_id"] for r in neardup.keep_one(docs, few=4, cell=3).collect()} == groups(texts)


def test_defined_results(spark):
    text = " ".join(f"w{i}" for i in range(200))
    rows = [(3, text), (1, text.upper()), (7, None), (6, " "), (9, "other words stand here"), (9, "other words stand here"), (8, "other words stand"), (None, text), (None, "alone and nameless it is")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 6, 8, 9]
    assert neardup.keep_one(docs.limit(0)).count() == 0


def template_group(seed, pairs, own, shared, n_words=1200):
    """Pairs of texts made from one template: `own` words changed in each, `shared` ones in both of a pair."""
    draw = random.Random(seed)
    template = [f"t{i}" for i in range(n_words)]
    texts = {}
    for p in range(pairs):
        places = [5 * k for k in draw.sample(range(n_words // 5 - 1), shared + 2 * own)]
        base = list(template)
        for at in places[:shared]:
            base[at] = f"p{p}x{at}"
        for m in range(2):
            words = list(base)
            for at in places[shared + m * own:shared + (m + 1) * own]:
                words[at] = f"p{p}m{m}x{at}"
            texts[2 * p + m] = " ".join(words)
    return texts


@pytest.mark.parametrize("own,shared", [(13, 1), (12, 2), (6, 8)])
def test_pairs_in_a_template_group_are_found(spark, own, shared):
    """All texts are nearly 0.8 alike, so every bucket is dense and only pairs of it count."""
    texts = template_group(own, 100, own, shared)
    assert jaccard(texts[0], texts[1]) >= 0.8 and 0.75 < jaccard(texts[0], texts[2]) < 0.81
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    kept = {r["doc_id"] for r in neardup.keep_one(docs, block=64).collect()}
    assert kept == groups(texts)


def test_links_between_blocks():
    import numpy as np

    draw = random.Random(9)
    sets, roots = [], []
    for g in range(12):
        base = draw.sample(range(10**6), 100)
        for _ in range(draw.randrange(1, 5)):
            sets.append(np.unique(np.array(base[draw.randrange(8):] + draw.sample(range(10**6), draw.randrange(9)), dtype="<u8")))
            roots.append(g * 10 + draw.randrange(2))
    fps, roots = np.arange(len(sets)) + 1000, np.array(roots)
    for side in (np.zeros(len(sets), int), np.array([draw.randrange(2) for _ in sets])):
        found = neardup.cross_links(fps, roots, side, sets)
        near = {(i, j) for i in range(len(sets)) for j in range(len(sets)) if i < j and roots[i] != roots[j] and (side.max() == 0 or side[i] != side[j]) and neardup.alike(sets[i], sets[j])}
        assert {tuple(sorted((a - 1000, b - 1000))) for a, b in found} <= near

        def parts(pairs):
            root = list(range(len(sets)))
            for _ in sets:
                for a, b in pairs:
                    root[a] = root[b] = min(root[a], root[b])
            return root

        assert parts([(a - 1000, b - 1000) for a, b in found]) == parts(sorted(near))


def test_fingerprints_propose_pairs_and_the_similarity_decides(spark, monkeypatch):
    draw, texts = random.Random(3), {}
    for i in range(40):
        words = [f"w{draw.randrange(3000)}" for _ in range(400)]
        texts[i] = " ".join(words)
        texts[100 + i] = " ".join([*words[:200], "x", *words[201:]])
    # words told apart by case only, and no words at all
    texts |= {300: "a b c d e", 301: "A B c d E", 302: "", 303: None}
    prints = {i: neardup.signature(t)[3] for i, t in texts.items()}
    assert prints[0] == simhash.fingerprint(texts[0], neardup.WIDTH) and prints[302] == 0
    nodes = spark.createDataFrame([(i, neardup._signed([p])[0].item()) for i, p in prints.items()], "fp long, print long")
    got = {(r["a"], r["b"]) for r in neardup.near_prints(nodes).collect()}
    near = {(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3}
    assert got == near and {(300, 301), (302, 303)} < near and len(near) > 3

    # the stage takes them: without any band it still joins what they propose and the similarity confirms
    monkeypatch.setattr(neardup, "proposed", lambda nodes, few, cell: nodes.limit(0).selectExpr("fp a", "fp b", "0L n"))
    docs = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string")
    kept = {r["doc_id"] for r in dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, "").collect()}
    gone = {b for a, b in near if jaccard(texts[a], texts[b]) >= 0.8}
    assert kept == set(texts) - gone and len(gone) > 3

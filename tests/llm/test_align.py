import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import align
from millrace.llm.queries import model_file, tokenizer_file

A_JSON = open(tokenizer_file("byte_bpe_50k.json"), encoding="utf-8").read()
B_MODEL = model_file("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pair():
    return align.Pair(A_JSON, B_MODEL)


def gpt_bytes():
    """The byte of each letter of the byte-level alphabet, from its definition."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in shown}
    hidden = [b for b in range(256) if b not in shown]
    return letters | {chr(256 + i): b for i, b in enumerate(hidden)}


def brute(texts):
    """Per text: A and B ids with their bytes by whole-text encoding, groups by merging, links by comparing ranges."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_str(A_JSON)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_proto=B_MODEL)
    letters, out, counts = gpt_bytes(), [], Counter()
    for text in texts:
        if not text:
            out.append(([], [], [], []))
            continue
        found = a.encode(" " + text, add_special_tokens=False)
        x = [(i, bytes(letters[c] for c in t)) for i, t in zip(found.ids, found.tokens, strict=True)]
        y = []
        for i in b.encode(text):
            piece = b.id_to_piece(i)
            y.append((i, bytes([int(piece[1:-1], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
        want = (" " + text).encode()
        if b"".join(t for _, t in x) != want or b"".join(t for _, t in y) != want:
            out.append(([], [], [], []))
            continue
        ends = [np.cumsum([len(t) for _, t in s]).tolist() for s in (x, y)]
        common = sorted(set(ends[0]) & set(ends[1]))
        groups, ia, ib = [], 0, 0
        for end in common:
            ga, gb = [], []
            while ia < len(x) and ends[0][ia] <= end:
                ga.append(x[ia][0])
                ia += 1
            while ib < len(y) and ends[1][ib] <= end:
                gb.append(y[ib][0])
                ib += 1
            groups.append((ga, gb))
        starts = [[0, *e[:-1]] for e in ends]
        linked, j0 = [], 0
        for i, (s, e) in enumerate(zip(starts[0], ends[0], strict=True)):
            while ends[1][j0] <= s:
                j0 += 1
            j = j0
            while j < len(y) and starts[1][j] < e:
                linked.append((x[i][0], y[j][0]))
                j += 1
        counts.update(linked)
        out.append(([i for i, _ in x], [i for i, _ in y], groups, linked))
    most = {}
    for (_, q), n in counts.items():
        most[q] = max(most.get(q, 0), n)
    rows = []
    for x, y, groups, linked in out:
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        rows.append((len(x), len(y), len(groups), len(linked), sum(counts[p] == most[p[1]] for p in linked), sum(counts[p] for p in linked),
                     hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return rows


def odd_texts():
    draw = random.Random(7)
    bits = ["the", "unbelievable", "naïve", "日本語", "don't", "<|endoftext|>", "</s>", "<s>", "x" * 40, "\n", "\t", "a.b,c", "1234567", "🙂🏽", "é", " ", "  ", "\r\n", " ",
            "　", "\x0b", "\x1c", "\x85", "ﬁ", "İ", "▁", "I'll", "'s", "\x00", "<0x41>", "zażółć"]
    texts = [draw.choice(["", " ", "\n"]).join(draw.choice(bits) for _ in range(draw.randrange(1, 25))) for _ in range(1500)]
    texts += [" ".join(draw.choice(bits[:9]) for _ in range(30)) for _ in range(200)]
    return [*texts, None, "", " ", "  ", "a", " a", "a ", "a\n b", "a\n \nb", "a \n b", "a\n ", "漢" * 3000, "ab" * 5000, "long " * 40_000, "the cat", "the cat"]


def test_against_brute_force(spark):
    texts = odd_texts()
    docs = spark.createDataFrame([(i if i % 9 else None, t, 5, "g") for i, t in enumerate(texts)], "doc_id long, text string, n_a int, groups string").repartition(5)
    got = align.aligned(docs, A_JSON, B_MODEL).collect()
    want = brute(texts)
    assert sorted((r["doc_id"] or 0, *r[1:]) for r in got) == sorted(((i if i % 9 else 0), *w) for i, w in enumerate(want))
    assert got[0].asDict().keys() == {"doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"}


def test_batches_do_not_change_results(pair):
    texts = [t or "" for t in odd_texts()]
    together = align.align(pair, pa.array(texts))
    for at in range(0, len(texts), 97):
        apart = align.align(pair, pa.array(texts[at:at + 97]))
        for field in ("n_a", "n_b", "n_groups", "n_links"):
            assert getattr(apart, field).tolist() == getattr(together, field)[at:at + 97].tolist()
        assert apart.groups == together.groups[at:at + 97]


@pytest.mark.parametrize("seed", range(20))
def test_dividing_finds_all_common_ends(seed):
    """Against a plain intersection, with many, few and no common ends."""
    draw = random.Random(seed)
    a_end, b_end, a_last, b_last, at = [], [], [], [], 0
    for _ in range(draw.randrange(1, 30)):
        size = draw.randrange(1, 400)
        inner = range(1, size)
        x = sorted(draw.sample(inner, int(len(inner) * draw.random() * draw.choice([0.05, 1]))))
        y = sorted(draw.sample(inner, int(len(inner) * draw.random() * draw.choice([0.05, 1]))))
        a_end += [at + e for e in [*x, size]]
        b_end += [at + e for e in [*y, size]]
        at += size
        a_last.append(len(a_end) - 1)
        b_last.append(len(b_end) - 1)
    a_end, b_end = np.array(a_end), np.array(b_end)
    a_cut, b_cut = np.zeros(len(a_end), bool), np.zeros(len(b_end), bool)
    a_cut[a_last] = b_cut[b_last] = True
    align.common_ends(a_end, b_end, a_cut, b_cut)
    both = set(a_end.tolist()) & set(b_end.tolist())
    assert set(a_end[a_cut].tolist()) == both == set(b_end[b_cut].tolist())


def test_interval_without_common_ends_is_one_group():
    n = 50_000
    a_end, b_end = np.arange(2, 2 * n + 2, 2), np.concatenate([np.arange(1, 2 * n, 2), [2 * n]])
    a_cut, b_cut = np.zeros(n, bool), np.zeros(len(b_end), bool)
    a_cut[-1] = b_cut[-1] = True
    align.common_ends(a_end, b_end, a_cut, b_cut)
    assert a_cut.sum() == b_cut.sum() == 1
    a, b = align.links(a_end, b_end)
    assert len(a) == len(a_end) + len(b_end) - 1 and (np.diff(a) >= 0).all() and (np.diff(b) >= 0).all()


def test_empty_table(spark):
    assert align.aligned(spark.createDataFrame([], "doc_id int, text string"), A_JSON, B_MODEL).count() == 0

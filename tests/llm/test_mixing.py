import random
import re

import pytest

from pyspark.sql import functions as F

from millrace.llm import mixing

SCHEMA = "doc_id long, text string, source string"


def corpus(seed=1):
    draw = random.Random(seed)
    rows = [(i, " ".join(["w"] * draw.randrange(0, 40)) + " \t\n", f"s{i % 3}" if i % 10 else None) for i in range(600)]
    return rows + [(i, "one\x0btwo\x0cthree é", "big") for i in range(1000, 1400)] + [(5, None, "s1"), (5, None, "s1"), (None, "a b", "tiny")]


def test_targets_and_taken(spark):
    rows = corpus()
    found = mixing.mix(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == len(rows)
    size = {}
    for _, text, source in rows:
        size[source] = size.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    names = sorted([s for s in size if s is not None]) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    budget, capped = 1.5 * sum(size.values()), set()
    while True:
        rate = (budget - sum(2 * size[s] for s in capped)) / sum(weight[s] for s in names if s not in capped)
        more = {s for s in names if s not in capped and rate * weight[s] > 2 * size[s]}
        if not more:
            break
        capped |= more
    for s in names:
        own = [r for r in found if r["source"] == s]
        want = min(2 * size[s], rate * weight[s])
        assert all(r["source_size"] == size[s] and r["target"] == pytest.approx(want) for r in own)
        assert abs(sum(r["taken"] for r in own) - want) <= max(r["size"] for r in own) / 2
        assert all(r["taken"] == r["times"] * r["size"] and 0 <= r["times"] <= 2 for r in own)
        times = {r["times"] for r in own if r["size"]}
        assert max(times) - min(times) <= 1


def test_reruns_agree_and_rows_repeat(spark):
    docs = spark.createDataFrame(corpus(2), SCHEMA)
    first = mixing.mix(docs)
    again = mixing.mix(docs.repartition(7))
    key = lambda df: sorted(df.select("doc_id", "source", "times").collect(), key=repr)
    assert key(first) == key(again)
    taken = sum(r["times"] for r in first.collect())
    assert abs(mixing.repeat_rows(docs, first).count() - taken) <= 3


def test_quality_weight_prefers_prose(spark):
    rows = [(i, "plain words here and there" if i % 2 else "#### $$$$ |||| ==== ****", "s") for i in range(2000)] + [(i, "x " * 200, "t") for i in range(3000, 3300)]
    found = mixing.mix(spark.createDataFrame(rows, SCHEMA), weights=(1, 9), share=0.5).filter("source = 's'").collect()
    good = sum(r["times"] for r in found if r["doc_id"] % 2)
    assert good > 1.5 * sum(r["times"] for r in found if r["doc_id"] % 2 == 0)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.mix(empty).count() == 0 and mixing.repeat_rows(empty, mixing.mix(empty)).count() == 0
    wordless = spark.createDataFrame([(1, "", "a"), (2, None, None)], SCHEMA)
    assert [r["taken"] for r in mixing.mix(wordless).collect()] == [0, 0]


def test_edge_range_that_holds_most_of_a_source(spark):
    """Texts of symbols weigh least, so most keys lie in the last range: it is ordered all the same."""
    rows = [(i, "#### $$$$ |||| word", "s") for i in range(900)] + [(i, "x " * 400, "t") for i in range(2000, 2100)] + [(i, "# | $", None) for i in range(3000, 3050)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = mixing.mix(docs, weights=(1, 40, 1), share=0.5).collect()
    key = {r["doc_id"]: r["k"] for r in docs.select("doc_id", mixing.exponential_key(F.col("doc_id"), mixing.quality_weight(F.col("text")), "mix").alias("k")).collect()}
    for source in ("s", "t", None):
        own = sorted((r for r in found if r["source"] == source), key=lambda r: key[r["doc_id"]])
        sofar = 0
        for r in own:
            rest = r["target"] - r["epochs"] * r["source_size"]
            assert r["times"] == r["epochs"] + (2 * sofar + r["size"] <= 2 * rest)
            sofar += r["size"]
    assert sum(r["times"] for r in found if r["source"] == "s") not in (0, 900)

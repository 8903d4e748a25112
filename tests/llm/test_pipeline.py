import os

import pytest
import sentencepiece
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from millrace.llm.queries import model_file
from testbed.compare import check, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
NAMES = [n for n in entry.queries() if n.startswith("op")]


@pytest.mark.parametrize("name", NAMES)
def test_registered_query(spark, name):
    assert check(spark, duck(SF), SF, name, entry.queries()[name], entry.oracle_sql().get(name)) is None


def test_all_operators_and_the_pipeline_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in NAMES) == list(range(1, 14)) and "pipeline" in entry.queries()


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    extra = [(90_001, None, "en", None, 0), (90_002, "", "en", "src0", 0), (None, "Call +1 (375) 555-4393 or mail me@example.com, it is fine.", "en", "src1", 57)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema)).unionByName(docs.filter("doc_id = 3"))
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        empty = stage(spark, docs.limit(0), SF)
        assert empty.count() == 0, name
        before, docs = docs, corpus_pipeline.materialize(stage(spark, docs, SF), name)
        if k < 4:
            assert docs.columns == columns, name
        n, m = before.count(), docs.count()
        assert {"quality": m < n, "near_duplicates": m < n, "personal_data": m == n, "source_mix": m > n, "tokens": m == n}[name]
        if name == "near_duplicates":
            # one row of an id, and no text twice
            assert docs.groupBy("doc_id").count().filter("count > 1 and doc_id is not null").isEmpty()
            assert docs.groupBy("text").count().filter("count > 1").isEmpty()
        if name == "personal_data":
            assert docs.filter(F.col("text").rlike(r"[a-z]@mail[0-9]|\+1 \(")).isEmpty()
            left = before.filter(~F.col("text").rlike(r"[0-9]")).exceptAll(docs)
            assert left.isEmpty()
        if name == "source_mix":
            times = docs.groupBy("doc_id", "text").count().agg(F.max("count")).first()[0]
            assert times <= 2
            last = {r["doc_id"]: r["text"] for r in docs.collect()}
    reference = sentencepiece.SentencePieceProcessor(model_proto=model_file("piece_bpe_32k.model"))
    for r in docs.limit(40).collect():
        assert r["ids"] == reference.encode(last[r["doc_id"]] or "") and r["parity"] and r["round_trip"]

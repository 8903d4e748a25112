import hashlib
import re

import pytest
from pyspark.sql import functions as F

from millrace.llm import pii
from millrace.llm.queries import op9_personal_data

TEXTS = [
    "a@b.c-x_y@d.e q", "1.2.3.4.5.6.7.8", "999.1.1.1.5.5.5 300.1.2.3 010.0.0.255", "4111 1111 1111 1111", "4111-1111-1111-1111 4111  1111",
    "+1 (375) 555-4393.", "", None, "x" * 20_000, "1" * 20_000, "1 " * 5_000, "+1" + " " * 5_000, "é@x.y ü+4915112345678 日本 +1 2",
    "0000000000000000 4222222222222", "1-" * 40 + "5 12345678901234567890 1234567890123", "a.b@c.d" * 50, "a@b@c.de +1 2+3 456 789 0123", "+12345678 +123456789",
    "5 4111111111111111", "4111 1111 1111 1112", "a.b.@c..d e@f.g.", "1.2.3", "+49 (0) 30 1234567-8 9", "Mail jo@example.com or 10.0.0.1",
]


def base(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        check = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits)))
        if 13 <= len(digits) <= 19 and check % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", *m.span()))
    return out


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")


def test_strict_spans_match_brute_force(docs):
    cands = pii.candidates(F.coalesce("text", F.lit("")))
    got = {r["doc_id"]: r["s"] for r in docs.select("doc_id", pii.spans_text(pii.strict_spans(cands)).alias("s")).collect()}
    for i, text in enumerate(TEXTS):
        assert got[i] == joined(base(text or "")), text[:60]


def test_loose_forms_are_learned_and_added(spark):
    rows = [f"call me, phone +1 (37{i % 10}) 555-439{i % 10} please" for i in range(60)] + [f"tel: 415-555-26{i:02d} now" for i in range(60)]
    rows += ["order id415-555-2671x", "mail jo.doe (at) mail (dot) com"] + [f"write to mail a{i}@mail.com soon" for i in range(50)]
    found = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id long, text string").select("doc_id", "text", pii.candidates(F.col("text")).alias("cands"))
    model = pii.fit(found)
    got = {r["doc_id"]: (r["b"], r["a"]) for r in found.select("doc_id", pii.spans_text(pii.strict_spans(F.col("cands"))).alias("b"), pii.spans_text(pii.all_spans(F.col("cands"), model)).alias("a")).collect()}
    assert all(set(b.split(",")) <= set(a.split(",")) or not b for b, a in got.values())
    assert got[60] == ("", "phone:5:17")
    assert got[120] == ("", "")
    assert model.reliability["phone"][0] > 0.9


def test_redaction(docs):
    clean = pii.redact_documents(docs.withColumn("n_chars", F.lit(0)).withColumn("_row", F.lit(1)).withColumn("cands", F.lit(2)))
    assert clean.columns == ["doc_id", "text", "n_chars", "_row", "cands"]
    got = {r["doc_id"]: r for r in clean.collect()}
    assert got[0]["text"] == "<EMAIL><EMAIL> q" and got[5]["text"] == "<PHONE>." and (got[7]["text"], got[7]["n_chars"]) == (None, 0)
    assert got[23]["text"] == "Mail <EMAIL> or <IP>" and got[23]["n_chars"] == 20
    for i, text in enumerate(TEXTS):
        if not base(text or ""):
            assert got[i]["text"] == text


def test_empty_table_and_native(spark, docs):
    assert pii.redact_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    plan = pii.redact_documents(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_query_counts_each_kind(docs, spark, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in op9_personal_data(spark, str(tmp_path)).collect()}
    for i, text in enumerate(TEXTS):
        spans = base(text or "")
        assert [got[i][f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in spans) for k in pii.KINDS]
        assert got[i]["base_sha256"] == hashlib.sha256(joined(spans).encode()).hexdigest()
    # several spans of one kind, and kinds out of their places
    assert [got[16][f"n_{k}"] for k in pii.KINDS] == [1, 0, 0, 1] and [got[23][f"n_{k}"] for k in pii.KINDS] == [1, 1, 0, 0]

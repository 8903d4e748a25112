"""The RAW inputs made of the given tables: how they are planned, on rows of their own."""

from datetime import datetime

import pytest

from millrace.session import small_or_not
from testbed import adapter
from testbed.queries import QUERIES


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    """Two orders of three lines each; one line has no supplier, one supplier no nation."""
    root = str(tmp_path_factory.mktemp("tables"))
    day = datetime(1997, 1, 10)
    items = [(o, 10 + n, s, n, 17.0, 100.5, 0.05, 0.02, "R", "F", datetime(1997, 2, n))
             for o, n, s in ((1, 1, 5), (1, 2, 6), (1, 3, None), (2, 1, 5), (2, 2, 7), (2, 3, 8))]
    for name, rows, schema in (
        ("nation", [(3, "CANADA", 1)], "n_nationkey int, n_name string, n_regionkey int"),
        ("supplier", [(5, "S5", 3, 1.0), (6, "S6", 3, 1.0), (7, "S7", 3, 1.0), (8, "S8", None, 1.0)],
         "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"),
        ("orders", [(1, 9, "F", 1.0, day, "1-URGENT"), (2, 9, "O", 1.0, datetime(1997, 3, 1), "5-LOW")],
         "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
        ("lineitem", items, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
                            "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
    ):
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")
    return root


def plans(df):
    q = df._jdf.queryExecution()
    return q.optimizedPlan().toString(), q.executedPlan().toString()


def test_a_filter_does_not_make_documents_anew(spark, sf):
    out = QUERIES["range_stats"](spark, sf)
    logical, _ = plans(out)
    # once per mention of a filtered field before, inside the join's condition
    assert logical.count("parseJson") == 1
    assert out.first()["n_rows"] == 2


def test_documents_are_not_shuffled_by_supplier(spark, sf):
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = adapter.raw_encounters(spark, sf)
        _, physical = plans(docs)
        assert "hashpartitioning(l_orderkey" in physical and "hashpartitioning(l_suppkey" not in physical
        assert docs.count() == 4
        # a side of more rows than the bound is joined as Spark plans it
        side = spark.range(4).withColumnRenamed("id", "l_suppkey")
        assert "BroadcastHashJoin" not in plans(spark.range(9).withColumnRenamed("id", "l_suppkey").join(small_or_not(side, "side", 3), "l_suppkey"))[1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)

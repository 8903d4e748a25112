"""The given tables seen as the model's RAW inputs.

A line item is an encounter document (its order gives patient and time, its supplier the provider and
facility), an order is a re-sent patient record. No rows are gathered per key, so a key of any weight
is fine. Repeated (order, line number) pairs are the repeated encounters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import small_or_not

STATES = ["NY", "NJ", "CT", "MA", "PA", "CA", "WA", "OR", "TX", "IL", "FL"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def spread(df: DataFrame, *cols: str) -> DataFrame:
    """Use all cores when the scan has fewer splits than there are cores (small files)."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *cols) if df.rdd.getNumPartitions() < cores else df


def state_of(key: Column) -> Column:
    return F.element_at(F.array(*[F.lit(s) for s in STATES]), (key % len(STATES) + 1).cast("int"))


def patient_id(key: str) -> Column:
    return F.concat(F.lit("PAT-"), F.lpad(F.col(key).cast("string"), 12, "0"))


def _contact(key: Column, balance: Column) -> tuple[Column, Column]:
    """ssn and phone text: mostly ten digits, some NULL, empty or too short."""
    nine = ((key * 7919) % 900000000 + 100000000).cast("string")
    ten = ((key * 104729) % 9000000000 + 1000000000).cast("string")
    ssn = (
        F.when(balance < -500, F.lit(None))
        .when(balance < 0, F.lit(""))
        .when(balance < 300, F.lit("12"))
        .otherwise(F.concat(F.substring(nine, 1, 3), F.lit("-"), F.substring(nine, 4, 2), F.lit("-"), F.substring(nine, 6, 4)))
    )
    phone = (
        F.when(balance > 9700, F.lit(None))
        .when(balance > 9300, F.lit(""))
        .when(balance > 9000, F.lit("555"))
        .otherwise(F.concat(F.lit("("), F.substring(ten, 1, 3), F.lit(") "), F.substring(ten, 4, 3), F.lit("-"), F.substring(ten, 7, 4)))
    )
    return ssn, phone


def raw_patients(spark: SparkSession, sf: str) -> DataFrame:
    """One row per customer without load time, and one per order at the order's time."""
    customer = table(spark, sf, "customer")
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    base = customer.select(
        "*", F.lit("customer.csv").alias("_source_file"), F.lit(None).cast("timestamp_ntz").alias("_load_ts"),
        F.col("c_nationkey").alias("_place"), F.lit(True).alias("_has_city"), F.lit(True).alias("_has_birth"),
    )
    moved = F.when(F.col("o_orderstatus") == "P", F.month("o_orderdate")).otherwise(0)
    again = customer.join(orders, customer.c_custkey == orders.o_custkey).select(
        *customer.columns,
        F.concat(F.lit("order-"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0"), F.lit(".csv")).alias("_source_file"),
        F.col("o_orderdate").alias("_load_ts"),
        ((F.col("c_nationkey") + moved) % 25).alias("_place"),
        (F.col("o_orderpriority") != "4-NOT SPECIFIED").alias("_has_city"),
        ((F.col("o_orderstatus") == "F") | (F.col("c_acctbal") < 8000)).alias("_has_birth"),
    )
    ssn, phone = _contact(F.col("c_custkey"), F.col("c_acctbal"))
    both = base.unionByName(again).join(nation, F.col("_place") == F.col("n_nationkey"))
    return both.select(
        patient_id("c_custkey").alias("patient_id"),
        F.col("c_mktsegment").alias("first_name"),
        F.col("c_name").alias("last_name"),
        F.when(F.col("_has_birth"), F.date_add(F.lit("1940-01-01").cast("date"), (F.col("c_custkey") % 20000).cast("int"))).alias("birth_date"),
        F.when(F.col("c_nationkey") % 2 == 0, "F").otherwise("M").alias("gender"),
        ssn.alias("ssn"),
        F.concat(F.col("c_custkey").cast("string"), F.lit(" Main St")).alias("address"),
        F.when(F.col("_has_city"), F.col("n_name")).alias("city"),
        state_of(F.col("_place")).alias("state"),
        F.lpad((F.col("c_custkey") % 100000).cast("string"), 5, "0").alias("zip"),
        phone.alias("phone"),
        "_source_file",
        "_load_ts",
    )


def _where(*items: tuple[Column, Column]) -> Column:
    """The array of those items whose condition holds; without lambdas, which are not compiled."""
    return F.concat(*[F.when(condition, F.array(item)).otherwise(F.array()) for condition, item in items])


def encounter_documents(spark: SparkSession, sf: str) -> DataFrame:
    """The encounter of every line item as a nested row, with its lineage columns."""
    items = spread(table(spark, sf, "lineitem"), "l_orderkey", "l_partkey")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    places = table(spark, sf, "supplier").join(
        table(spark, sf, "nation").select("n_nationkey", "n_name"), F.col("s_nationkey") == F.col("n_nationkey")
    ).select("s_suppkey", "s_name", "s_nationkey", "n_name")
    # a side beyond Spark's threshold, yet far smaller than the items, which it would have shuffled once more
    suppliers = small_or_not(places, "suppliers")
    j = items.join(orders, items.l_orderkey == orders.o_orderkey).join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))

    start = F.timestamp_add("SECOND", (F.col("l_orderkey") * 131 + F.col("l_partkey")) % 86400, F.col("o_orderdate"))
    stop = F.timestamp_add("SECOND", (F.col("l_partkey") * 37) % 13560 + 900, start)
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    measures = _where(*[
        (F.col(c) > 0, F.struct(F.lit(code).alias("code"), F.lit(text).alias("description"), F.col(c).alias("value"), F.lit(u).alias("units")))
        for code, text, c, u in (
            ("QTY", "Quantity", "l_quantity", "pcs"), ("PRICE", "Extended price", "l_extendedprice", "usd"),
            ("DISC", "Discount", "l_discount", "share"), ("TAX", "Tax", "l_tax", "share"),
        )
    ])
    finished = F.col("l_linestatus") == "F"
    observations = (
        F.when((F.col("l_linenumber") == 7) & finished, F.lit(None))
        .when((F.col("l_linenumber") == 6) & finished, F.array())
        .otherwise(measures)
    )
    line = F.col("l_linenumber").cast("string")
    conditions = _where(
        (F.col("l_returnflag") == "R", F.struct(F.concat(F.lit("C-"), line).alias("code"), F.concat(F.lit("Condition "), line).alias("description"))),
        ((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 25), F.struct(F.lit("Q-HIGH").alias("code"), F.lit("High quantity").alias("description"))),
    )
    billing = F.when(
        F.col("l_tax") > 0,
        F.struct(
            F.when(F.col("l_discount") > 0, F.concat(F.lit("Payer "), "l_returnflag", "l_linestatus")).alias("payer"),
            price.alias("total_charge"),
            (price * (1 - F.col("l_discount").cast("decimal(4,2)"))).alias("paid_amount"),
            F.when(F.col("o_orderstatus") == "F", "paid").when(F.col("o_orderstatus") == "O", "pending").otherwise("denied").alias("claim_status"),
        ),
    )
    return j.select(
        F.concat(F.lit("ENC-"), F.col("l_orderkey").cast("string"), F.lit("-"), line).alias("encounter_id"),
        patient_id("o_custkey").alias("patient_id"),
        start.alias("start"),
        stop.alias("stop"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "emergency")
        .when(F.col("o_orderpriority") == "2-HIGH", "urgentcare")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "inpatient")
        .when(F.col("o_orderpriority") == "5-LOW", "wellness")
        .otherwise("ambulatory").alias("encounter_class"),
        F.struct(
            F.concat(F.lit("Dr. "), "s_name").alias("name"),
            F.concat(F.lit("FAC-"), F.lpad(F.col("s_suppkey").cast("string"), 12, "0")).alias("facility_id"),
            F.concat("s_name", F.lit(" Clinic")).alias("facility_name"),
            F.col("n_name").alias("city"),
            state_of(F.col("s_nationkey")).alias("state"),
        ).alias("provider"),
        billing.alias("billing"),
        observations.alias("observations"),
        conditions.alias("conditions"),
        F.concat(F.lit("encounters-"), "l_returnflag", F.lit(".json")).alias("_source_file"),
        (F.col("l_partkey") * 1000000000 + F.col("l_suppkey")).alias("_file_row"),
        F.col("l_shipdate").alias("_load_ts"),
    )


DOCUMENT = ("encounter_id", "patient_id", "start", "stop", "encounter_class", "provider", "billing", "observations", "conditions")


def raw_encounters(spark: SparkSession, sf: str) -> DataFrame:
    """The RAW table: every document as Variant (via JSON text, as it would land)."""
    docs = encounter_documents(spark, sf)
    made = F.parse_json(F.to_json(F.struct(*DOCUMENT)))
    # filters on a document's fields stop at the generator; below it each field would make the document anew
    return docs.select(F.explode(F.array(made)).alias("v"), "_source_file", "_file_row", "_load_ts")

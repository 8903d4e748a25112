"""One registered query per operator, each over whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.governance import READER_ROLE, mask_tagged, policy_view, tag
from millrace.functions.keys import hash_key  # noqa: F401
from millrace.functions.masking import PHONE_PREFIX, SSN_PREFIX, apply_policy, mask_columns, mask_email, mask_phone, mask_ssn, redact, register_functions
from millrace.functions.ordering import hwm_filter
from millrace.functions.variant import vget
from millrace.operators import aggregates, layout, merge, positions, quality, scd2, tables
from millrace.operators.joins import asof_join, with_exists_flag
from millrace.plans import load, marts, reports, staging, views
from millrace.plans.state import LoadState
from millrace.session import configure, in_parallel, materialize, scratch_path, ship_package
from millrace.sources import files, landing, registry, synth, workbook
from millrace.streaming import alerts, ingest, maintain

from .adapter import encounter_documents, patient_id, raw_encounters, raw_patients, table
from .oracles import BATCHES, FACT_KEYS, RESUME_BATCH, RESUME_RUN, label

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CUT = "1998-01-01 00:00:00"


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return fn(configure(spark), sf)

    QUERIES[fn.__name__] = run
    return fn


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


# --- staging -------------------------------------------------------------------------------------


@query
def observation_stats(spark, sf):
    return aggregates.observation_stats(staging.observations_flat(raw_encounters(spark, sf)))


@query
def observations_flat(spark, sf):
    return staging.observations_flat(raw_encounters(spark, sf))


@query
def observations_staged(spark, sf):
    return staging.stage_observations(raw_encounters(spark, sf))


@query
def conditions_flat(spark, sf):
    return staging.conditions_flat(raw_encounters(spark, sf))


@query
def encounters_flat(spark, sf):
    return staging.encounters_flat(raw_encounters(spark, sf))


@query
def encounters_staged(spark, sf):
    return staging.stage_encounters(raw_encounters(spark, sf))


@query
def stg_encounters(spark, sf):
    return staging.stg_encounters(raw_encounters(spark, sf))


@query
def dt_encounters(spark, sf):
    return staging.dt_encounters(raw_encounters(spark, sf))


@query
def variant_props(spark, sf):
    v = table(spark, sf, "events").select("event_id", "event_type", F.parse_json("props").alias("v"))
    return v.select("event_id", "event_type", vget("v", "k", "bigint").alias("k"), vget("v", "no.such", strict=False).alias("missing"))


@query
def patients_dedup_masked(spark, sf):
    return staging.stage_patients(raw_patients(spark, sf))


@query
def dt_patients(spark, sf):
    return staging.dt_patients(raw_patients(spark, sf))


@query
def stg_patients(spark, sf):
    return staging.stg_patients(raw_patients(spark, sf))


@query
def sql_documents(spark, sf):
    """Paths, casts and unnesting in SQL text over the registered RAW view."""
    views.register_views(spark, raw_patients(spark, sf), raw_encounters(spark, sf))
    return spark.sql("""
        SELECT e.v:encounter_id::string AS encounter_id, e.v:provider.name::string AS provider_name,
               e.v:start::timestamp_ntz AS started_at, o.value:code::string AS obs_code, o.value:value::double AS obs_value
        FROM encounters_json e, LATERAL variant_explode(e.v:observations) o""")


@query
def sql_views(spark, sf):
    """A report in SQL text over the staging views, joining masked patients."""
    views.register_views(spark, raw_patients(spark, sf), raw_encounters(spark, sf), _log(spark, sf))
    return spark.sql("""
        SELECT p.gender, e.encounter_class, count(*) AS encounters, count_if(p.ssn_masked LIKE 'XXX-XX-%') AS with_ssn,
               count_if(mask_phone(p.phone_masked) = p.phone_masked) AS phone_stable
        FROM v_encounters_flat e LEFT JOIN v_patients_dedup p ON p.patient_id = e.patient_id
        GROUP BY p.gender, e.encounter_class""")


# --- masking and governance ----------------------------------------------------------------------


def _mask_pair(spark, sf, column, fn):
    register_functions(spark)
    return raw_patients(spark, sf).select(
        "patient_id", F.col("_source_file").alias("source_file"), fn(column).alias("masked"),
        F.expr(f"mask_{column}({column})").alias("masked_sql"),
    )


@query
def mask_ssn_(spark, sf):
    return _mask_pair(spark, sf, "ssn", mask_ssn)


@query
def mask_phone_(spark, sf):
    return _mask_pair(spark, sf, "phone", mask_phone)


for _name in ("mask_ssn", "mask_phone"):
    QUERIES[_name] = QUERIES.pop(_name + "_")


def _email() -> Column:
    seg = F.lower("c_mktsegment")
    return (
        F.when(F.col("c_acctbal") < 0, F.lit(None)).when(F.col("c_acctbal") < 300, F.lit(""))
        .when(F.col("c_mktsegment") == "BUILDING", F.col("c_name"))
        .when(F.col("c_mktsegment") == "MACHINERY", F.concat(F.lit("@"), seg, F.lit(".example")))
        .otherwise(F.concat(F.regexp_replace("c_name", "#", "."), F.lit("@"), seg, F.lit("@example.com")))
    )


def _q_mask_email(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", mask_email(_email()).alias("masked"))


_q_mask_email.__name__ = "mask_email"
query(_q_mask_email)


@query
def mask_redact(spark, sf):
    return raw_patients(spark, sf).select("patient_id", F.col("_source_file").alias("source_file"), redact("city").alias("city"))


@query
def mask_hash(spark, sf):
    tokens = raw_patients(spark, sf).select(
        apply_policy("patient_id", "hash", "pepper").alias("token"), apply_policy("ssn", "hash", "pepper").alias("ssn_token")
    )
    return tokens.groupBy("token", "ssn_token").agg(F.count(F.lit(1)).alias("n"))


def _q_mask_columns(spark, sf):
    masked = mask_columns(
        raw_patients(spark, sf),
        {"patient_id": "hash", "ssn": "ssn", "phone": "phone", "address": "redact", "not_there": "email"}, "pepper",
    )
    return masked.select("patient_id", "last_name", "ssn", "phone", "address", F.col("_source_file").alias("source_file"))


_q_mask_columns.__name__ = "mask_columns"
query(_q_mask_columns)


@query
def mask_by_role(spark, sf):
    raw = raw_patients(spark, sf).select("patient_id", "ssn", "phone", F.col("_source_file").alias("source_file"))
    policies = {"ssn": "mask_ssn", "phone": "mask_phone"}
    views = [policy_view(raw, r, policies).select(F.lit(r).alias("role"), "*") for r in (READER_ROLE, "ANALYST")]
    return views[0].unionByName(views[1])


def _q_mask_tagged(spark, sf):
    raw = raw_patients(spark, sf).select("patient_id", "address", "city", F.col("_source_file").alias("source_file"))
    tagged = tag(tag(raw, "address", "pii", "address"), "city", "pii", "city")
    views = [mask_tagged(tagged, r).select(F.lit(r).alias("role"), "*") for r in (READER_ROLE, "ANALYST")]
    return views[0].unionByName(views[1])


_q_mask_tagged.__name__ = "mask_tagged"
query(_q_mask_tagged)


# --- marks and incremental loads -----------------------------------------------------------------


def _marks(spark, sf):
    id_ = F.col("event_id").cast("string")
    mark = (
        F.when(F.col("event_type") == "error", F.concat(F.lit("E-"), id_))
        .when(F.col("event_type") == "view", F.concat(id_, F.lit(".0"))).otherwise(id_)
    )
    return table(spark, sf, "events").select("event_id", mark.alias("mark"))


@query
def hwm_since(spark, sf):
    rows = files.read_parquet_incremental(spark, f"{sf}/events.parquet", "ts", datetime(2024, 1, 10, 12))
    return rows.select("event_id", "ts", "user_id")


@query
def hwm_string_order(spark, sf):
    return hwm_filter(_marks(spark, sf), "mark", "99", text_order=True)


@query
def hwm_chunks(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return positions.hwm_chunks(rows, "o_orderdate", 500).select("o_orderkey", "chunk_id", "chunk_hwm")


@query
def hwm_chunks_text(spark, sf):
    return positions.hwm_chunks(_marks(spark, sf), "mark", 300, text_order=True).drop("mark")


@query
def pending_count(spark, sf):
    return registry.pending_counts(table(spark, sf, "events"), "ts", datetime(2024, 1, 10, 12), ["event_type"])


def _job(spark, sf, label):
    root = scratch_path(spark, label)
    return {"type": "parquet", "root": sf}, LoadState(spark, f"{root}/state"), f"{root}/raw"


@query
def incremental_load(spark, sf):
    """Everything up to a mark as load 0 (the same rows in an earlier export), the rest as load 1."""
    source, state, raw = _job(spark, sf, "incremental")
    early = f"{raw}/export/events.parquet"
    table(spark, sf, "events").filter(F.col("ts") <= ntz("2024-01-15 00:00:00")).write.parquet(early)
    t = load.TableLoad("events", "ts", "events_raw", mask={"user_id": "hash", "props": "redact"})
    load.load_table(spark, {**source, "root": f"{raw}/export"}, t, state, raw, "pepper")
    load.load_table(spark, source, t, state, raw, "pepper")
    # nothing is new the third time
    load.load_table(spark, source, t, state, raw, "pepper")
    return spark.read.parquet(f"{raw}/events_raw").withColumn("load_no", F.split("_load", "-")[1].cast("bigint")).drop("_load")


@query
def dry_run_report(spark, sf):
    source, state, raw = _job(spark, sf, "dry")
    loads = [load.TableLoad("events", "event_id"), load.TableLoad("orders", "o_orderkey")]
    results = load.load_all(spark, source, loads, state, raw, dry_run=True)
    return spark.createDataFrame(
        [(r.table, r.rows_read, r.rows_written, r.batches) for r in results],
        "name string, rows_read bigint, rows_written bigint, batches bigint",
    )


@query
def load_state_status(spark, sf):
    source, state, raw = _job(spark, sf, "status")
    load.load_all(spark, source, [load.TableLoad("events", "event_id"), load.TableLoad("orders", "o_orderkey")], state, raw)
    return state.status().select(F.col("table").alias("name"), "status", "rows", "hwm")


@query
def restart_load(spark, sf):
    source, state, raw = _job(spark, sf, "restart")
    t = load.TableLoad("events", "event_id")
    load.load_table(spark, source, t, state, raw)
    load.load_table(spark, source, t, state, raw, restart=True)
    return spark.read.parquet(f"{raw}/events").groupBy("event_id").agg(F.count(F.lit(1)).alias("copies"))


@query
def work_list(spark, sf):
    control = table(spark, sf, "customer").select(
        F.col("c_mktsegment").alias("source_group"),
        F.concat(F.lit("t"), F.col("c_custkey").cast("string")).alias("source_table"),
        F.upper("c_name").alias("target_table"),
        F.lit("id").alias("hwm_column"),
        F.when(F.col("c_acctbal") >= 1000, F.col("c_nationkey") * 100 + 100).alias("batch_size"),
        F.when(F.col("c_nationkey") < 10, F.lit('{"tax_id": "ssn"}')).alias("mask"),
        (F.col("c_acctbal") >= 0).alias("enabled"),
    )
    return load.work_list(control).withColumn("ssn_policy", F.col("mask")["tax_id"]).drop("mask")


class _Dies(LoadState):
    """A state whose driver dies behind the given number of checkpoints."""

    def __init__(self, spark, path, left):
        super().__init__(spark, path)
        self.left = left

    def advance(self, *args):
        if not self.left:
            raise InterruptedError("stopped between write and checkpoint")
        self.left -= 1
        super().advance(*args)


@query
def resumed_load(spark, sf):
    """A load that stops behind its third checkpoint, and its rerun: what each landed step holds."""
    source, state, raw = _job(spark, sf, "resumed")
    t = load.TableLoad("events", "ts", batch_size=RESUME_BATCH, commit_batches=RESUME_RUN)
    try:
        load.load_table(spark, source, t, _Dies(spark, state.path, 3), raw)
    except InterruptedError:
        pass
    rest = load.load_table(spark, source, t, state, raw)
    landed = spark.read.parquet(f"{raw}/events").withColumn("step", F.split("_load", "-")[1].cast("bigint"))
    steps = landed.groupBy("step").agg(F.count(F.lit(1)).alias("n_rows"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
                                       F.count_distinct("event_id").alias("n_events"))
    return steps.withColumn("rerun_batches", F.when(F.col("step") >= 3, F.lit(rest.batches).cast("bigint")))


@query
def configured_job(spark, sf):
    """A job by its control table, with masks, upper-case columns and a log."""
    source, state, raw = _job(spark, sf, "configured")
    control = spark.createDataFrame(
        [("nightly", "customer", "CUSTOMER_RAW", "c_custkey", 100, '{"c_name": "redact", "c_mktsegment": "hash"}', True),
         ("nightly", "orders", None, "o_orderkey", None, None, True), ("nightly", "part", None, "p_partkey", None, None, False),
         ("weekly", "supplier", None, "s_suppkey", None, None, True)],
        "source_group string, source_table string, target_table string, hwm_column string, batch_size bigint, mask string, enabled boolean",
    )
    control.coalesce(1).write.parquet(f"{raw}/control")
    load.run(spark, {"source": source, "landing": f"{raw}/in", "state": state.path, "log": f"{raw}/log", "masking": {"salt": "s"},
                     "control": {"path": f"{raw}/control", "source_group": "nightly"}}, upper=True)
    logged = spark.read.parquet(f"{raw}/log").select("target", "rows_read", "rows_written")
    loads = [("CUSTOMER_RAW", ["C_CUSTKEY", "C_NAME", "C_MKTSEGMENT"]), ("orders", ["O_ORDERKEY", "O_ORDERSTATUS"])]
    customers, orders = (spark.read.parquet(f"{raw}/in/{t}").select(F.lit(t).alias("target"), *cols) for t, cols in loads)
    return customers.unionByName(orders, allowMissingColumns=True).join(logged, "target")


@query
def snapshot_swap(spark, sf):
    """A frame that was read before a table is replaced keeps its rows; the table has the new ones."""
    path = scratch_path(spark, "swap")
    first = tables.replace_snapshot(table(spark, sf, "orders").filter("o_orderstatus = 'F'").select("o_orderkey", "o_orderstatus"), path)
    second = tables.replace_snapshot(table(spark, sf, "orders").filter("o_orderstatus <> 'F'").select("o_orderkey", "o_orderstatus"), path)
    return first.withColumn("version", F.lit("before")).unionByName(second.withColumn("version", F.lit("current")))


@query
def parallel_loads(spark, sf):
    source, state, raw = _job(spark, sf, "parallel")
    loads = [load.TableLoad("events", "event_id"), load.TableLoad("orders", "o_orderkey"), load.TableLoad("customer", "c_custkey")]
    load.load_all(spark, source, loads, state, raw, log=f"{raw}/log")
    return spark.read.parquet(f"{raw}/log").select("source", "target", "rows_read", "rows_written")


def _log(spark, sf):
    return table(spark, sf, "events").select(
        F.col("event_type").alias("target"), F.col("event_type").alias("run_id"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("loaded_by"),
        F.col("user_id").alias("rows_read"), F.floor("value").alias("rows_written"), F.col("ts").alias("loaded_at"),
    )


@query
def run_totals(spark, sf):
    return aggregates.run_totals(_log(spark, sf))


@query
def load_health(spark, sf):
    return aggregates.load_health(_log(spark, sf))


# --- files ---------------------------------------------------------------------------------------


@query
def csv_by_name(spark, sf):
    """Two layouts of one table: other column order, other case, one column missing."""
    root = scratch_path(spark, "csv")
    c = table(spark, sf, "customer").withColumn(
        "name", F.when(F.col("c_acctbal") < 0, F.lit("NULL")).when(F.col("c_acctbal") < 100, F.lit("")).otherwise(F.col("c_name"))
    ).withColumn("custkey", F.col("c_custkey"))
    positive = F.col("c_acctbal") >= 0
    c.filter(positive).select("custkey", "name", F.col("c_mktsegment").alias("segment")).write.option("header", True).csv(f"{root}/a")
    c.filter(~positive).select("name", F.col("custkey").alias("CUSTKEY"), F.lit("x").alias("extra")).write.option("header", True).csv(f"{root}/b")
    rows = files.read_csv_by_name(spark, files.list_files(spark, root, r".*/[ab]/.*[.]csv"), ["custkey", "name", "segment"])
    return rows.drop("_source_file")


@query
def csv_bad_rows(spark, sf):
    root = scratch_path(spark, "bad-csv")
    value = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("value").cast("string"))
    tables.write_csv(table(spark, sf, "events").select("event_id", value.alias("value")), root)
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("value", T.DoubleType())])
    rows = files.read_csv_by_name(spark, files.list_files(spark, root, r".*[.]csv"), schema.fieldNames()).drop("_source_file")
    good = files.typed(rows, schema, "continue").select("*", F.lit(None).cast("string").alias("failing"), F.lit("continue").alias("policy"))
    bad = files.typed(rows, schema, "return_errors").select(
        F.col("event_id").cast("bigint"), F.lit(None).cast("double").alias("value"),
        F.array_join("_errors", ",").alias("failing"), F.lit("return_errors").alias("policy"),
    )
    return good.unionByName(bad)


def _event_lines(spark, sf, root, broken: bool):
    e = table(spark, sf, "events")
    line = F.to_json(F.struct("event_id", "event_type", "value"))
    if broken:
        cut = F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string"), F.lit(', "broken'))
        line = F.when(F.col("event_type") == "error", cut).otherwise(line)
    e.repartitionByRange("event_id").sortWithinPartitions("event_id").select(line.alias("value")).write.text(root)


@query
def ndjson_bad_rows(spark, sf):
    root = scratch_path(spark, "ndjson")
    _event_lines(spark, sf, root, True)
    good = files.read_ndjson_variant(spark, root, "continue").select(
        vget("v", "event_id", "bigint").alias("event_id"), F.lit(None).cast("string").alias("line"), F.lit("continue").alias("policy")
    )
    bad = files.read_ndjson_variant(spark, root, "return_errors").select(
        F.lit(None).cast("bigint").alias("event_id"), F.col("value").alias("line"), F.lit("return_errors").alias("policy")
    )
    return good.unionByName(bad)


@query
def file_lineage(spark, sf):
    """Row numbers in files must follow the ids, which were written in order."""
    root = scratch_path(spark, "lineage")
    _event_lines(spark, sf, root, False)
    rows = files.read_ndjson_variant(spark, root, lineage=True).select(
        vget("v", "event_id", "bigint").alias("event_id"), "_source_file", "_file_row"
    )
    first = rows.groupBy("_source_file").agg(F.min("event_id").alias("first"))
    return rows.join(first, "_source_file").select(
        "event_id", (F.col("_file_row") == F.col("event_id") - F.col("first") + 1).alias("in_order")
    )


def _patient_csv(spark, sf, root, where: Column | None = None):
    rows = raw_patients(spark, sf)
    rows = rows if where is None else rows.filter(where)
    # the source file name travels in the address, to compare rows afterwards
    out = rows.withColumn("address", F.col("_source_file")).drop("_source_file", "_load_ts")
    out.write.mode("append").option("header", True).csv(root)


@query
def file_load(spark, sf):
    """Load with truncate (twice), then append once: every record twice."""
    root = scratch_path(spark, "load")
    _patient_csv(spark, sf, f"{root}/patients")
    rows = landing.patients_from_csv(spark, files.list_files(spark, root, r".*patients.*[.]csv"), ntz("2024-01-01 00:00:00"))
    for truncate in (True, True, False):
        landing.load_files(rows, f"{root}/raw", truncate)
    return spark.read.parquet(f"{root}/raw").groupBy("patient_id", "birth_date", "ssn", "address").agg(
        F.count(F.lit(1)).alias("copies")
    ).drop("address")


def _q_paged_api(spark, sf):
    """Customers served as pages of 250 rows; a page is the only group that is gathered."""
    ship_package(spark, "millrace", "testbed")
    size, root = 250, scratch_path(spark, "api")
    c = table(spark, sf, "customer")
    ranked = positions.with_rank(c, ["c_custkey"])
    pages = ranked.withColumn("page", F.floor((F.col("rank") - 1) / size).cast("bigint")).groupBy("page").agg(
        F.to_json(F.collect_list(F.struct("c_custkey", "c_name", "c_acctbal", "c_mktsegment"))).alias("value")
    )
    pages.write.partitionBy("page").text(f"{root}/customer")
    c.agg(F.concat_ws(" ", F.lit(str(size)), F.count(F.lit(1)).cast("string")).alias("value")).write.text(f"{root}/customer/meta")
    source = {
        "type": "rest", "base_url": root, "page_size": 400, "records_key": "data", "transport": "testbed.paging:send",
        "schema": "c_custkey bigint, c_name string, c_acctbal double, c_mktsegment string", "key": ["c_custkey"],
    }
    return registry.read_source(spark, source, "customer", "c_custkey")


_q_paged_api.__name__ = "paged_api"
query(_q_paged_api)


def _q_workbook(spark, sf):
    """Customers written as workbooks by the tasks, read back after mark 7 in numeric order."""
    ship_package(spark, "millrace", "testbed")
    root = scratch_path(spark, "books")
    c = table(spark, sf, "customer").select(F.col("c_custkey").cast("string"), "c_name", "c_mktsegment")

    def write(batches):
        import uuid

        import pandas as pd
        from pyarrow import fs

        store, folder = fs.FileSystem.from_uri(root if "://" in root or root.startswith("file:") else "file://" + root)
        store.create_dir(folder)
        for pdf in batches:
            name = f"{folder}/{uuid.uuid4().hex}.xlsx"
            data = workbook.workbook_bytes(list(pdf.columns), pdf.itertuples(index=False), "customer")
            with store.open_output_stream(name) as out:
                out.write(data)
            yield pd.DataFrame({"name": [name]})

    # the action counts the files; each holds at most one Arrow batch of rows
    c.mapInPandas(write, "name string").count()
    return registry.read_source(spark, {"type": "excel", "path": root}, "customer", "c_custkey", "7")


_q_workbook.__name__ = "workbook"
query(_q_workbook)


# --- merges --------------------------------------------------------------------------------------


@query
def merge_new_rows(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return merge.new_rows(o.filter("o_orderstatus = 'F'"), o, ["o_orderkey"])


def _before_after(spark, sf):
    raw = raw_patients(spark, sf)
    before = F.col("_load_ts").isNull() | (F.col("_load_ts") < ntz(CUT))
    return tuple(staging.stage_patients(raw.filter(w), keep_order=True) for w in (before, F.col("_load_ts") >= ntz(CUT)))


@query
def merge_upsert(spark, sf):
    """Later records update city and state; the first source stays, being outside the list."""
    t, s = _before_after(spark, sf)
    t = t.withColumnRenamed("_source_file", "first_source")
    cols = ["first_name", "last_name", "birth_date", "gender", "city", "state", "ssn_masked", "phone_masked", "_load_ts"]
    out = merge.upsert(t, s, ["patient_id"], cols)
    return out.select("patient_id", "first_name", "city", "state", "first_source")


@query
def update_from(spark, sf):
    t, s = _before_after(spark, sf)
    t = t.select("patient_id", "city", "state", F.lit(False).alias("stale"))
    out = merge.update_from(t, s, "patient_id", lambda a, b: F.col(a + "state") != F.col(b + "state"), {"stale": F.lit(True)})
    return out.drop("state")


@query
def delta_ingest(spark, sf):
    raw = materialize(raw_encounters(spark, sf), "raw", codec="zstd")
    late = F.col("_load_ts") >= ntz("2000-01-01 00:00:00")
    target = staging.stage_encounters(raw.filter(~late))
    keys = raw.filter(late).select(vget("v", "encounter_id").alias("encounter_id"))
    return merge.apply_delta(staging.stage_encounters(raw), keys, target, ["encounter_id"])


@query
def insert_if_absent(spark, sf):
    held = aggregates.distinct_keys(table(spark, sf, "orders"), ["o_custkey"]).select(
        F.col("o_custkey").alias("custkey"), F.lit("orders").alias("origin")
    )
    offered = table(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"), F.lit("customer").alias("origin"))
    return merge.insert_if_absent(held, offered, ["custkey"])


@query
def exists_flag(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey")
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return with_exists_flag(c, o, "c_custkey").select("c_custkey", "known")


@query
def assign_ids(spark, sf):
    return positions.assign_ids(table(spark, sf, "customer").select("c_name"), ["c_name"], "id", 101)


# --- marts ---------------------------------------------------------------------------------------


def _staged(spark, sf):
    return materialize(staging.stage_encounters(raw_encounters(spark, sf)), "encounters", codec="zstd")


def _calendar(spark, sf) -> DataFrame:
    """The calendar over the orders' span; the bounds are one row of metadata."""
    low, high = table(spark, sf, "orders").agg(
        F.min("o_orderdate").cast("date"), F.date_add(F.max("o_orderdate").cast("date"), 1)
    ).first()
    return marts.build_dim_date(spark, low.isoformat(), high.isoformat())


@query
def dim_date(spark, sf):
    return _calendar(spark, sf)


@query
def dim_location(spark, sf):
    return marts.build_dim_location(staging.stage_encounters(raw_encounters(spark, sf)))


@query
def dim_facility(spark, sf):
    enc = _staged(spark, sf)
    return marts.build_dim_facility(enc, marts.build_dim_location(enc))


@query
def dim_provider(spark, sf):
    return marts.build_dim_provider(staging.stage_encounters(raw_encounters(spark, sf)))


@query
def dim_payer(spark, sf):
    return marts.build_dim_payer(staging.stage_encounters(raw_encounters(spark, sf)))


@query
def dim_location_hashed(spark, sf):
    return marts.hashed_dim_location(staging.stg_encounters(raw_encounters(spark, sf)))


@query
def dim_facility_hashed(spark, sf):
    return marts.hashed_dim_facility(staging.stg_encounters(raw_encounters(spark, sf)))


@query
def dim_provider_hashed(spark, sf):
    return marts.hashed_dim_provider(staging.stg_encounters(raw_encounters(spark, sf)))


def _snapshots(spark, sf) -> list[DataFrame]:
    raw = materialize(raw_patients(spark, sf), "patients", codec="zstd")
    seen = [raw.filter(F.col("_load_ts") < ntz(t)) for t in BATCHES[:2]] + [raw]
    return in_parallel(spark, *[lambda r=r: materialize(staging.stage_patients(r), "snapshot", codec="zstd") for r in seen])


def _history(spark, sf) -> DataFrame:
    """Three snapshots applied in turn to a table of current and closed versions."""
    kept = scd2.History(spark, scratch_path(spark, "history"), marts.DIM_PATIENT, "patient_id", marts.TRACKED, "patient_sk")
    for snap, t in zip(_snapshots(spark, sf), BATCHES):
        dim = kept.apply(snap, ntz(t))
    return dim


def _snapshot_history(spark, sf) -> DataFrame:
    schema = marts.DIM_PATIENT.replace("patient_sk bigint", "scd_id string")
    kept = scd2.History(spark, scratch_path(spark, "snapshots"), schema, "patient_id", marts.TRACKED, "scd_id")
    for snap, t in zip(_snapshots(spark, sf), BATCHES):
        dim = kept.apply(snap, ntz(t), True, ntz(t), lambda opened: scd2.with_hashed_id(opened, "patient_id"))
    return dim


@query
def scd2_native(spark, sf):
    return _history(spark, sf)


@query
def scd2_snapshot(spark, sf):
    return _snapshot_history(spark, sf)


def _model(spark, sf) -> dict[str, DataFrame]:
    enc, patient = in_parallel(spark, lambda: _staged(spark, sf), lambda: _history(spark, sf))

    def places():
        location = materialize(marts.build_dim_location(enc), "location")
        return location, marts.build_dim_facility(enc, location)

    (location, facility), provider, payer = in_parallel(
        spark, places, lambda: marts.build_dim_provider(enc), lambda: marts.build_dim_payer(enc)
    )
    return {"encounters": enc, "location": location, "facility": facility, "provider": provider, "payer": payer, "patient": patient}


def _fact(m: dict[str, DataFrame]) -> DataFrame:
    return marts.build_fact(m["encounters"], m)


@query
def fact_native(spark, sf):
    return _fact(_model(spark, sf))


@query
def asof_sorted(spark, sf):
    """The as-of join by sorting, as it runs for keys with very many versions."""
    enc, history = in_parallel(spark, lambda: _staged(spark, sf), lambda: _history(spark, sf))
    enc = enc.select("encounter_id", "patient_id", "started_at")
    out = asof_join(enc, history, "patient_id", "started_at", payload=["patient_sk"], many_versions=True)
    return out.select("encounter_id", "patient_sk")


def _hashed_patients(spark, sf) -> DataFrame:
    return _snapshot_history(spark, sf).withColumnRenamed("scd_id", "patient_sk")


@query
def fact_current(spark, sf):
    return marts.build_fact_current(staging.stg_encounters(raw_encounters(spark, sf)), _hashed_patients(spark, sf))


def _backfilled(spark, sf) -> dict[str, DataFrame]:
    return marts.backfill(
        spark, raw_patients(spark, sf), materialize(raw_encounters(spark, sf), "raw", codec="zstd"), scratch_path(spark, "model"), ntz(BATCHES[0])
    )


@query
def backfill(spark, sf):
    return _backfilled(spark, sf)["fact_encounter"].drop("_built_at")


@query
def region_class_rollup(spark, sf):
    m = _model(spark, sf)
    return reports.region_class_rollup(_fact(m), m["facility"], m["location"])


@query
def provider_rollup(spark, sf):
    m = _model(spark, sf)
    return reports.provider_rollup(_fact(m), m["provider"])


@query
def payer_rollup(spark, sf):
    m = _model(spark, sf)
    return reports.payer_rollup(_fact(m), m["payer"])


@query
def monthly_trend(spark, sf):
    return reports.monthly_trend(_fact(_model(spark, sf)), _calendar(spark, sf))


@query
def patient_history(spark, sf):
    return reports.patient_history(_history(spark, sf))


@query
def top_charges(spark, sf):
    enc = staging.stage_encounters(raw_encounters(spark, sf)).select("encounter_id", "total_charge")
    return aggregates.top(enc, [F.desc_nulls_last("total_charge"), F.asc("encounter_id")], 100)


# --- streaming -----------------------------------------------------------------------------------


def _failures(df: DataFrame) -> DataFrame:
    state = F.when(F.col("event_type") == "error", alerts.FAILED).otherwise("SUCCEEDED")
    return df.select(F.col("event_type").alias("step"), state.alias("state"), F.col("ts").alias("scheduled_time"))


@query
def failure_alert(spark, sf):
    return alerts.failure_alert(_failures(table(spark, sf, "events")))


@query
def stream_alert(spark, sf):
    """The alert over a stream of history files; complete mode keeps every check time."""
    root = scratch_path(spark, "alerts")
    history = table(spark, sf, "events")
    history.write.parquet(f"{root}/history")
    stream = spark.readStream.schema(history.schema).parquet(f"{root}/history")

    def keep(batch: DataFrame, _id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/out")

    (alerts.failure_alert(_failures(stream)).writeStream.outputMode("complete").foreachBatch(keep)
     .option("checkpointLocation", f"{root}/ck").trigger(availableNow=True).start().awaitTermination())
    return spark.read.parquet(f"{root}/out")


@query
def stream_autoingest(spark, sf):
    """Two drops of CSV files, each loaded once; the run in between and after finds nothing."""
    root = scratch_path(spark, "ingest")
    late = F.col("_load_ts") >= ntz(CUT)

    def read(s, paths):
        return landing.patients_from_csv(s, paths, ntz("2024-01-01 00:00:00"))

    def go():
        ingest.auto_ingest(spark, f"{root}/in", "*.csv", read, f"{root}/raw", f"{root}/ck").awaitTermination()

    for where in (late, F.coalesce(~late, F.lit(True))):
        _patient_csv(spark, sf, f"{root}/in", where)
        go()
        go()
    return spark.read.parquet(f"{root}/raw").select("patient_id", "birth_date", "ssn", "city", "address")


@query
def stream_ndjson(spark, sf):
    """NDJSON files streamed into a Variant table with file and row lineage."""
    root = scratch_path(spark, "ndstream")
    docs = encounter_documents(spark, sf).drop("_source_file", "_file_row", "_load_ts")
    tables.write_ndjson(docs, f"{root}/in", "snappy")

    def read(s, paths):
        return landing.encounters_from_ndjson(s, paths, ntz("2024-01-01 00:00:00"))

    ingest.auto_ingest(spark, f"{root}/in", "*.json.snappy", read, f"{root}/raw", f"{root}/ck").awaitTermination()
    raw = spark.read.parquet(f"{root}/raw")
    return staging.encounters_flat(raw).select("encounter_id", "total_charge", "observation_count")


def _drops(df: DataFrame, path: str):
    """Land the early part, hand over, land the late part, hand over."""
    early = F.col("_load_ts").isNull() | (F.col("_load_ts") < ntz(CUT))
    for i, where in enumerate((early, F.coalesce(~early, F.lit(False)))):
        tables.write_batch(df.filter(where), str(i), path)
        yield i


@query
def stream_latest(spark, sf):
    root = scratch_path(spark, "latest")
    raw = materialize(raw_patients(spark, sf), "patients")
    cols = ["patient_id", "first_name", "last_name", "birth_date", "gender", "city", "state", "ssn", "phone", "_load_ts", "_source_file"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in raw.select(*cols).schema)
    for _ in _drops(raw, f"{root}/raw"):
        stream = ingest.raw_changes(spark, [f"{root}/raw"], maintain.RAW_PATIENT_SCHEMA).select(*cols)
        maintain.maintain_latest(
            spark, stream, f"{root}/latest", ["patient_id"], "_load_ts", ["_source_file"], f"{root}/ck", schema, buckets=16
        ).awaitTermination()
    return spark.read.schema(schema).parquet(f"{root}/latest").drop("_load_ts", "_source_file", "_bucket")


@query
def stream_projection(spark, sf):
    root = scratch_path(spark, "projection")
    for _ in _drops(raw_encounters(spark, sf), f"{root}/raw"):
        stream = ingest.raw_changes(spark, [f"{root}/raw"], maintain.RAW_ENCOUNTER_SCHEMA)
        maintain.maintain_projection(stream, staging.dt_encounters, f"{root}/dt", f"{root}/ck").awaitTermination()
    return spark.read.parquet(f"{root}/dt").drop("_batch_id")


def _dag(spark, sf) -> maintain.Warehouse:
    """Patients and encounters arrive in two drops; each is carried through to the marts."""
    root = scratch_path(spark, "dag")
    patients = materialize(raw_patients(spark, sf), "patients")
    # each drop builds its own part of the documents: written once, where the stream finds them
    docs = raw_encounters(spark, sf)
    for _ in zip(_drops(patients, f"{root}/raw/p"), _drops(docs, f"{root}/raw/e")):
        for _again in range(2):
            maintain.maintain(
                spark, [f"{root}/raw/p"], [f"{root}/raw/e"], f"{root}/model", f"{root}/ck", buckets=16, clock=lambda _i: CUT
            ).awaitTermination()
    return maintain.Warehouse(spark, f"{root}/model", 16)


@query
def stream_dag(spark, sf):
    w = _dag(spark, sf)
    fact = w.table("marts/fact_encounter")
    out = (
        fact.join(w.table("marts/dim_patient").select("patient_sk", F.col("valid_from").alias("version_from")), "patient_sk", "left")
        .join(w.table("marts/dim_provider"), "provider_sk", "left")
        .join(w.table("marts/dim_facility"), "facility_sk", "left")
        .join(w.table("marts/dim_location"), "location_sk", "left")
        .join(w.table("marts/dim_payer"), "payer_sk", "left")
    )
    return out.select("encounter_id", "date_key", "version_from", "provider_name", "facility_id", "region", "payer_name",
                      "duration_minutes", "observation_count", "total_charge")


@query
def stream_dag_observations(spark, sf):
    return _dag(spark, sf).table("staging/observations")


@query
def stream_monthly(spark, sf):
    """Monthly totals of what upkeep keeps, its calendar included, after all batches were merged."""
    w = _dag(spark, sf)
    w.compact(keep=0, least=2)
    return reports.monthly_trend(w.table("marts/fact_encounter"), w.table("marts/dim_date"))


# --- quality and layout --------------------------------------------------------------------------


@query
def dq_report(spark, sf):
    m = _model(spark, sf)
    fact = materialize(_fact(m), "fact", codec="zstd")
    raw = materialize(raw_patients(spark, sf), "patients", codec="zstd")
    landed = mask_columns(raw, {"ssn": "ssn", "phone": "phone"})
    staged = staging.stage_patients(raw)
    q, held = quality, {"fact_encounter": fact, "dim_facility": m["facility"]}
    dims = {"patient_sk": m["patient"], "facility_sk": m["facility"], "date_key": _calendar(spark, sf), "payer_sk": m["payer"], "location_sk": m["location"]}

    def known(name, c, null_ok):
        return q.check_fk(label(name, c, "known"), held[name], c, dims[c], c, null_ok)

    def masked(name, rows, suffix):
        return q.row_checks(rows, {label(name, c, "masked"): q.not_like(c + suffix, f"{prefix}%") for c, prefix in (("ssn", SSN_PREFIX), ("phone", PHONE_PREFIX))})

    return q.dq_gate([
        q.row_checks(fact, {**{label("fact_encounter", c, "present"): q.is_missing(c) for c in FACT_KEYS},
                            label("fact_encounter", "paid_amount", "within_charge"): F.col("paid_amount") > F.col("total_charge")}),
        known("fact_encounter", "patient_sk", True), known("fact_encounter", "facility_sk", False),
        known("fact_encounter", "date_key", False), known("fact_encounter", "payer_sk", True),
        q.check_unique(label("dim_patient", "is_current", "once_per_key"), m["patient"], ["patient_id"], F.col("is_current")),
        known("dim_facility", "location_sk", False), q.row_checks(m["location"], {label("dim_location", "region", "present"): q.is_missing("region")}),
        masked("patients_csv", landed, ""), masked("patients", staged, "_masked"),
    ])


@query
def model_tests(spark, sf):
    """The 20 generic tests of the hash-keyed model."""
    enc = materialize(staging.stg_encounters(raw_encounters(spark, sf)), "stg", codec="zstd")
    patients = _hashed_patients(spark, sf)
    t = {
        "hloc": marts.hashed_dim_location(enc), "hfac": marts.hashed_dim_facility(enc), "hprov": marts.hashed_dim_provider(enc),
        "snap": patients, "s3": staging.stg_patients(raw_patients(spark, sf)), "enc": enc,
        "hfact": materialize(marts.build_fact_current(enc, patients), "fact"), "dim_date": _calendar(spark, sf),
    }
    q = quality

    def rows(name, *cols, **extra):
        return q.row_checks(t[name], {**{f"{name}.{c} not_null": q.is_missing(c) for c in cols}, **extra})

    def unique(name, c):
        return q.check_unique(f"{name}.{c} unique", t[name], [c], skip_null=True)

    def related(name, c, to):
        return q.check_fk(f"{name}.{c} relationships", t[name], c, t[to], c)

    return q.dq_gate([
        rows("hloc", "location_sk", **{"hloc.region accepted_values": q.not_in("region", [*marts.REGIONS, marts.OTHER_REGION])}),
        unique("hloc", "location_sk"), rows("hfac", "facility_sk"), unique("hfac", "facility_sk"), related("hfac", "location_sk", "hloc"),
        rows("hprov", "provider_sk"), unique("hprov", "provider_sk"), rows("snap", "patient_sk"), unique("snap", "patient_sk"),
        rows("hfact", "encounter_id", "facility_sk"), related("hfact", "facility_sk", "hfac"), related("hfact", "provider_sk", "hprov"),
        related("hfact", "date_key", "dim_date"), related("hfact", "patient_sk", "snap"),
        rows("s3", "patient_id"), unique("s3", "patient_id"), rows("enc", "encounter_id", "patient_id"),
    ])


@query
def duplicate_keys(spark, sf):
    return aggregates.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def facility_conflicts(spark, sf):
    """Nations as facilities, so that every supplier gives another name."""
    enc = table(spark, sf, "lineitem").join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.concat(F.lit("N-"), F.col("s_nationkey").cast("string")).alias("facility_id"), F.col("s_name").alias("facility_name"),
        F.lit("x").alias("city"), F.lit("NY").alias("state"),
    )
    return marts.facility_conflicts(enc)


@query
def range_stats(spark, sf):
    enc = staging.stg_encounters(raw_encounters(spark, sf)).withColumn("date_key", marts.dates.date_key("started_at"))
    return aggregates.range_stats(enc, "date_key", 19970101, 19970131, "duration_minutes")


@query
def fan_out(spark, sf):
    enc = staging.stage_encounters(raw_encounters(spark, sf)).select("encounter_id", "duration_minutes")
    return layout.fan_out(enc, _calendar(spark, sf), 3, 42)


def _keyed_items(spark, sf):
    return table(spark, sf, "lineitem").withColumn("date_key", marts.dates.date_key("l_shipdate"))


@query
def layout_report(spark, sf):
    return layout.layout_report(_keyed_items(spark, sf), "date_key", 16, 19970101, 19970131)


@query
def layout_facts(spark, sf):
    """What holds of the two layouts however ranges are sampled."""
    root = scratch_path(spark, "layout_facts")
    items = _keyed_items(spark, sf)
    report = materialize(layout.layout_report(items, "date_key", 16, 19970101, 19970131, root), "layout_report")
    ranges = layout.file_ranges(spark, f"{root}/sorted", "date_key")
    before = F.lag("high").over(W.orderBy("low", "high"))
    kept = ranges.agg(F.sum("n_rows").alias("value")).select(F.lit("rows in sorted files").alias("fact"), "value")
    apart = ranges.select((F.coalesce(before, F.col("low")) <= F.col("low")).alias("ok")).agg(F.bool_and("ok").cast("bigint").alias("value"))
    random = report.filter("layout = 'random'").select((F.col("scanned") == F.col("total")).cast("bigint").alias("value"))
    pruned = report.filter("layout = 'sorted'").select((F.col("scanned") * 4 <= F.col("total")).cast("bigint").alias("value"))
    return kept.unionByName(apart.select(F.lit("sorted files share at most an end").alias("fact"), "value")).unionByName(
        random.select(F.lit("random layout scans all files").alias("fact"), "value")
    ).unionByName(pruned.select(F.lit("sorted layout scans a quarter at most").alias("fact"), "value"))


@query
def csv_incremental(spark, sf):
    """Texts with quotes and line breaks through CSV and back, read after a mark."""
    path = scratch_path(spark, "csv")
    tables.write_csv(table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), "text"), path)
    return files.read_csv_incremental(spark, path, "doc_id", "50", multi_line=True).select("doc_id", F.sha2("text", 256).alias("text_sha256"))


@query
def csv_quoted(spark, sf):
    """The same file by column name."""
    path = scratch_path(spark, "csv")
    tables.write_csv(table(spark, sf, "documents").select("text", "lang", F.col("doc_id").cast("string").alias("doc_id")), path)
    found = files.read_csv_by_name(spark, files.list_files(spark, path, r".*\.csv"), ["DOC_ID", "text", "none"], multi_line=True)
    return found.select(F.col("DOC_ID").alias("doc_id"), F.sha2("text", 256).alias("text_sha256"), "none")


def _supplier_ranges(spark, sf):
    """Each supplier's ship dates as if they were one file, so that SQL can give the same ranges."""
    return _keyed_items(spark, sf).groupBy("l_suppkey").agg(
        F.min("date_key").alias("low"), F.max("date_key").alias("high"), F.count(F.lit(1)).alias("n_rows")
    )


@query
def layout_pruning(spark, sf):
    return layout.files_scanned(_supplier_ranges(spark, sf), 19950101, 19950131)


@query
def clustering_depth(spark, sf):
    return layout.clustering_depth(_supplier_ranges(spark, sf))


def _people(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("id"))


@query
def synth_patients(spark, sf):
    return synth.synth_patients(_people(spark, sf))


@query
def synth_encounters(spark, sf):
    e = synth.synth_encounters(_people(spark, sf))
    return e.select(
        "encounter_id", "patient_id", "start", "encounter_class", F.col("provider.name").alias("provider_name"),
        F.col("provider.facility_id").alias("facility_id"), F.col("billing.payer").alias("payer"),
        F.col("billing.claim_status").alias("claim_status"), (F.col("billing.total_charge") * 100).cast("bigint").alias("charge_cents"),
        F.size("observations").cast("bigint").alias("n_observations"), F.size("conditions").cast("bigint").alias("n_conditions"),
    )

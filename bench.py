"""Timed stages and headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores. The
or consumed in full.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from millrace.operators import layout, quality, tables  # noqa: E402
from millrace.operators.aggregates import observation_stats  # noqa: E402
from millrace.plans import load, marts, reports, staging  # noqa: E402
from millrace.plans.state import LoadState  # noqa: E402
from millrace.session import clean_scratch, configure, scratch_path  # noqa: E402
from millrace.sources import landing, synth  # noqa: E402
from millrace.streaming import maintain  # noqa: E402
from testbed.adapter import encounter_documents, raw_patients  # noqa: E402
from testbed.queries import QUERIES  # noqa: E402

SF = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("bench").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", CPUS).config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    root = scratch_path(spark, "bench")
    times: dict[str, float] = {}
    t: dict[str, DataFrame] = {}

    def timed(name: str, fn) -> None:
        start = time.time()
        out = fn()
        if isinstance(out, DataFrame):
            consume(out)
        times[name] = round(time.time() - start, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr, flush=True)

    consume(spark.read.parquet(f"{SF}/orders.parquet"))  # start-up is not timed

    # the published run: 100,000 patients with their encounters
    people = synth.ids(spark, 100_000)
    timed("synth_100k_patients", lambda: (
        tables.write_csv(synth.synth_patients(people), f"{root}/synth/patients"),
        tables.write_ndjson(synth.synth_encounters(people), f"{root}/synth/encounters"),
    ) and None)

    # inputs of the stages below, as files; not timed
    raw_patients(spark, SF).withColumn("address", F.col("_source_file")).drop("_source_file").write.parquet(f"{root}/export/patients.parquet")
    tables.write_ndjson(encounter_documents(spark, SF).drop("_source_file", "_file_row", "_load_ts"), f"{root}/drop")

    entry = load.TableLoad("patients", "_load_ts", mask={"ssn": "ssn", "phone": "phone"})
    timed("load_masked", lambda: load.load_table(
        spark, {"type": "parquet", "root": f"{root}/export"}, entry, LoadState(spark, f"{root}/state"), f"{root}/raw"
    ) and None)
    timed("ndjson_to_raw", lambda: tables.append(
        landing.encounters_from_ndjson(spark, f"{root}/drop"), f"{root}/raw/encounters") and None)
    patients = spark.read.parquet(f"{root}/raw/patients").withColumn("_source_file", F.col("address"))
    encounters = spark.read.parquet(f"{root}/raw/encounters")

    def backfill() -> None:
        t.update(marts.backfill(spark, patients, encounters, f"{root}/model", F.lit("2002-01-01").cast("timestamp_ntz"),
                                ("1995-01-01", "2001-12-31")))

    timed("backfill", backfill)
    fact, q = t["fact_encounter"], quality
    timed("dq_gate", lambda: q.dq_gate([
        q.row_checks(fact, {**{f"{c} not null": q.is_missing(c) for c in ("patient_sk", "facility_sk", "provider_sk", "date_key")},
                            "paid <= charged": F.col("paid_amount") > F.col("total_charge")}),
        q.check_fk("patient", fact, "patient_sk", t["dim_patient"], "patient_sk"),
        q.check_fk("facility", fact, "facility_sk", t["dim_facility"], "facility_sk", False),
        q.check_fk("date", fact, "date_key", t["dim_date"], "date_key", False),
        q.check_fk("payer", fact, "payer_sk", t["dim_payer"], "payer_sk"),
        q.check_unique("current", t["dim_patient"], ["patient_id"], F.col("is_current")),
        q.check_fk("location", t["dim_facility"], "location_sk", t["dim_location"], "location_sk", False),
        q.row_checks(t["dim_location"], {"region set": q.is_missing("region")}),
        q.row_checks(patients, {"raw ssn": q.not_like("ssn", "XXX-XX-%"), "raw phone": q.not_like("phone", "(XXX) XXX-%")}),
        q.row_checks(t["patients"], {"ssn": q.not_like("ssn_masked", "XXX-XX-%"), "phone": q.not_like("phone_masked", "(XXX) XXX-%")}),
    ]))
    timed("observation_stats", lambda: observation_stats(staging.observations_flat(encounters)))
    timed("region_class_rollup", lambda: reports.region_class_rollup(fact, t["dim_facility"], t["dim_location"]))
    timed("payer_rollup", lambda: reports.payer_rollup(fact, t["dim_payer"]))
    timed("monthly_trend", lambda: reports.monthly_trend(fact, t["dim_date"]))

    found: dict[str, dict] = {}

    def study() -> None:
        fanned = layout.fan_out(fact.limit(1024).repartition(int(CPUS)), t["dim_date"], 2000, 42, pad=300)
        report = layout.layout_report(fanned, "date_key", 16, 19970101, 19970131)
        found.update({r["layout"]: {"scanned": r["scanned"], "files": r["total"], "depth": round(r["avg_depth"], 2)} for r in report.collect()})

    timed("layout_study", study)

    # a few new rows through RAW, staging and marts, on a model that holds all the others
    def upkeep() -> None:
        maintain.maintain(spark, [f"{root}/live/p"], [f"{root}/live/e"], f"{root}/live/model", f"{root}/live/ck", buckets=8).awaitTermination()

    late = F.pmod(F.xxhash64("_source_file", "_file_row"), F.lit(600)) == 0
    tables.write_batch(encounters.filter(~late), 0, f"{root}/live/e")
    tables.write_batch(patients.drop("_load").filter("patient_id not like '%77'"), 0, f"{root}/live/p")
    timed("upkeep_first_load", upkeep)
    tables.write_batch(encounters.filter(late), 1, f"{root}/live/e")
    tables.write_batch(patients.drop("_load").filter("patient_id like '%77'"), 1, f"{root}/live/p")
    timed("new_rows_to_fact", upkeep)

    for name in ("patients_dedup_masked", "scd2_native", "merge_upsert", "hwm_chunks", "fact_native", "asof_sorted"):
        timed(name, lambda: QUERIES[name](spark, SF))

    result = json.dumps({
        "metric": "total time of stages and headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": SF.rsplit("sf", 1)[-1], "cpus": int(CPUS), "layout": found,
        "rows": {"encounter_documents": encounters.count(), "observations": t["observations"].count(), "facts": fact.count()},
    })
    clean_scratch(spark)
    print(result)


if __name__ == "__main__":
    main()

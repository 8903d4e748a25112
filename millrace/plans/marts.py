"""STAGING to MARTS: calendar, location, facility, provider, payer, patient history, fact."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates
from ..functions.keys import hash_key
from ..operators.aggregates import distinct_keys
from ..operators.joins import asof_join, current_join, star_join
from ..operators.merge import new_rows
from ..operators.positions import assign_ids
from ..operators.scd2 import scd2_changes
from ..operators.tables import replace_snapshot
from ..session import configure, in_parallel
from . import staging

# States of each region; the calendar's bounds.
REGIONS = {
    "Northeast": ("NY", "NJ", "CT", "MA", "PA"),
    "West": ("CA", "WA", "OR"),
    "South": ("TX",),
    "Midwest": ("IL",),
}
OTHER_REGION = "Other"
CALENDAR = ("2023-01-01", "2026-12-31")

TRACKED = ("first_name", "last_name", "birth_date", "gender", "city", "state")
DIM_PATIENT = (
    "patient_sk bigint, patient_id string, first_name string, last_name string, birth_date date, gender string, "
    "city string, state string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean"
)


def region_of(state: Column | str, regions: Mapping[str, tuple[str, ...]] = REGIONS) -> Column:
    c = F.col(state) if isinstance(state, str) else state
    out: Column | None = None
    for region, states in regions.items():
        out = F.when(c.isin(*states), region) if out is None else out.when(c.isin(*states), region)
    return out.otherwise(OTHER_REGION)


def build_dim_date(spark: SparkSession, start: str = CALENDAR[0], end: str = CALENDAR[1]) -> DataFrame:
    days = spark.sql("SELECT explode(sequence(CAST(:a AS DATE), CAST(:b AS DATE))) AS full_date",
                     {"a": start, "b": end})
    return calendar_rows(days)


def calendar_rows(days: DataFrame) -> DataFrame:
    """The calendar's columns of distinct `full_date`."""
    d = F.col("full_date")
    return days.select(
        dates.date_key(d).alias("date_key"),
        "full_date",
        F.year(d).cast("bigint").alias("year"),
        F.month(d).cast("bigint").alias("month"),
        F.dayofmonth(d).cast("bigint").alias("day"),
        dates.month_name(d).alias("month_name"),
        dates.day_of_week(d).alias("day_of_week"),
    )


def calendar_years(enc: DataFrame, ts: str = "started_at") -> DataFrame:
    """Calendar rows of every year that the encounters begin in; a stray date adds its year and no more."""
    years = enc.filter(F.col(ts).isNotNull()).select(F.year(ts).alias("y")).distinct()
    days = years.select(F.explode(F.sequence(F.make_date("y", F.lit(1), F.lit(1)), F.make_date("y", F.lit(12), F.lit(31)))).alias("full_date"))
    return calendar_rows(days)


def location_rows(enc: DataFrame) -> DataFrame:
    return distinct_keys(enc, ["city", "state"]).withColumn("region", region_of("state"))


def facility_rows(enc: DataFrame, locations: DataFrame) -> DataFrame:
    """One row per facility: the smallest (name, city, state) if the source disagrees with itself.

    Reduced to the facility before the join to its location, so the fact-sized side never joins.
    """
    one = enc.groupBy("facility_id").agg(F.min(F.struct("facility_name", "city", "state")).alias("_f"))
    loc = locations.select("location_sk", F.col("city").alias("_city"), F.col("state").alias("_state"))
    return (
        one.select("facility_id", "_f.*")
        .join(loc, (F.col("city") == F.col("_city")) & (F.col("state") == F.col("_state")))
        .select("facility_id", "facility_name", "location_sk")
    )


def facility_conflicts(enc: DataFrame) -> DataFrame:
    """Facilities given with more than one name or place."""
    return (
        enc.select("facility_id", "facility_name", "city", "state").distinct()
        .groupBy("facility_id").agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")
    )


def provider_rows(enc: DataFrame) -> DataFrame:
    return distinct_keys(enc, ["provider_name"])


def payer_rows(enc: DataFrame) -> DataFrame:
    return distinct_keys(enc.filter(F.col("payer").isNotNull()), ["payer"]).withColumnRenamed("payer", "payer_name")


NATURAL = {
    "location": (["city", "state"], "location_sk"),
    "facility": (["facility_id"], "facility_sk"),
    "provider": (["provider_name"], "provider_sk"),
    "payer": (["payer_name"], "payer_sk"),
}


def numbered(rows: DataFrame, name: str, held: DataFrame | None = None) -> DataFrame:
    """The dimension rows to add, numbered on from the ones held."""
    keys, sk = NATURAL[name]
    start = 1
    if held is not None:
        rows = new_rows(held, rows, keys)
        start = (held.agg(F.max(sk)).first()[0] or 0) + 1
    return assign_ids(rows, keys, sk, start)


def build_dim_location(enc: DataFrame, held: DataFrame | None = None) -> DataFrame:
    return numbered(location_rows(enc), "location", held)


def build_dim_facility(enc: DataFrame, locations: DataFrame, held: DataFrame | None = None) -> DataFrame:
    return numbered(facility_rows(enc, locations), "facility", held)


def build_dim_provider(enc: DataFrame, held: DataFrame | None = None) -> DataFrame:
    return numbered(provider_rows(enc), "provider", held)


def build_dim_payer(enc: DataFrame, held: DataFrame | None = None) -> DataFrame:
    return numbered(payer_rows(enc), "payer", held)


# the same dimensions keyed by hash: no numbering pass, equal keys on every rebuild


def hashed_dim_location(enc: DataFrame) -> DataFrame:
    return location_rows(enc).select(hash_key("city", "state").alias("location_sk"), "city", "state", "region")


def hashed_dim_facility(enc: DataFrame) -> DataFrame:
    rows = distinct_keys(enc, ["facility_id", "facility_name", "city", "state"])
    return rows.select(
        hash_key("facility_id").alias("facility_sk"), "facility_id", "facility_name",
        hash_key("city", "state").alias("location_sk"),
    )


def hashed_dim_provider(enc: DataFrame) -> DataFrame:
    return provider_rows(enc).select(hash_key("provider_name").alias("provider_sk"), "provider_name")


def empty_dim_patient(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DIM_PATIENT)


def build_fact(enc: DataFrame, dims: Mapping[str, DataFrame], many_versions: bool | None = None) -> DataFrame:
    """Fact rows: provider, facility and payer keys, then the patient version valid at the start, so that
    what is shuffled by patient holds numbers in place of names."""
    starred = star_join(
        enc,
        {
            "provider": (dims["provider"], "provider_name", "provider_name", "provider_sk"),
            "facility": (dims["facility"], "facility_id", "facility_id", "facility_sk"),
            "payer": (dims["payer"], "payer", "payer_name", "payer_sk"),
        },
    )
    versioned = asof_join(
        starred, dims["patient"], "patient_id", "started_at", payload=["patient_sk"], many_versions=many_versions
    )
    return versioned.select(
        "encounter_id", dates.date_key("started_at").alias("date_key"), "patient_sk", "provider_sk", "facility_sk",
        "payer_sk", "encounter_class", "claim_status", "duration_minutes", "observation_count", "condition_count",
        "total_charge", "paid_amount",
    )


def build_fact_current(enc: DataFrame, dim_patient: DataFrame) -> DataFrame:
    """Hash-keyed fact: current patient version, other keys computed in place, no billing."""
    return current_join(enc, dim_patient, "patient_id", "patient_sk").select(
        "encounter_id", dates.date_key("started_at").alias("date_key"), "patient_sk",
        hash_key("provider_name").alias("provider_sk"), hash_key("facility_id").alias("facility_sk"),
        "encounter_class", "duration_minutes", "observation_count", "condition_count",
    )


DIMENSIONS = ("location", "facility", "provider", "payer", "patient")


def backfill(
    spark: SparkSession,
    raw_patients: DataFrame,
    raw_encounters: DataFrame,
    out: str,
    batch_ts: Column,
    calendar: tuple[str, str] = CALENDAR,
) -> dict[str, DataFrame]:
    """Replace STAGING by the canonical views and build MARTS from it; tables land under `out` and are
    read with `read_snapshot`, also while they are replaced."""

    def put(df: DataFrame, name: str) -> DataFrame:
        return replace_snapshot(df, f"{out}/{name}")

    configure(spark)
    t: dict[str, DataFrame] = {}
    encounters, observations = staging.stage_documents(raw_encounters)
    t["patients"], t["encounters"], t["observations"], t["dim_date"] = in_parallel(
        spark,
        lambda: put(staging.stage_patients(raw_patients), "staging/patients"),
        lambda: put(encounters, "staging/encounters"),
        lambda: put(observations, "staging/observations"),
        lambda: put(build_dim_date(spark, *calendar), "marts/dim_date"),
    )
    enc = t["encounters"]

    def places() -> tuple[DataFrame, DataFrame]:
        locations = put(build_dim_location(enc), "marts/dim_location")
        return locations, put(build_dim_facility(enc, locations), "marts/dim_facility")

    def people() -> DataFrame:
        _, fresh = scd2_changes(empty_dim_patient(spark), t["patients"], "patient_id", TRACKED, batch_ts)
        return put(assign_ids(fresh, ["patient_id"], "patient_sk"), "marts/dim_patient")

    (t["dim_location"], t["dim_facility"]), t["dim_provider"], t["dim_payer"], t["dim_patient"] = in_parallel(
        spark,
        places,
        lambda: put(build_dim_provider(enc), "marts/dim_provider"),
        lambda: put(build_dim_payer(enc), "marts/dim_payer"),
        people,
    )
    fact = build_fact(enc, {d: t[f"dim_{d}"] for d in DIMENSIONS}, many_versions=False)
    t["fact_encounter"] = put(fact.withColumn("_built_at", batch_ts), "marts/fact_encounter")
    return t

"""RAW to STAGING: latest patient rows, flattened encounters, observations and conditions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import minutes_between
from ..functions.masking import mask_phone, mask_ssn
from ..functions.variant import explode_array, json_array_size, vget
from ..operators.dedup import latest_per_key
from ..session import materialize, small_or_not

PATIENT_COLUMNS = ("patient_id", "first_name", "last_name", "birth_date", "gender", "city", "state")
MONEY = "decimal(12,2)"
# equal load times are settled by where the row came from
FILE_ORDER = ("_source_file", "_file_row")


def _latest_patients(raw: DataFrame, *kept: str) -> DataFrame:
    ties = [c for c in FILE_ORDER if c in raw.columns]
    needed = list(dict.fromkeys([*PATIENT_COLUMNS, "ssn", "phone", "_load_ts", *ties, *kept]))
    return latest_per_key(raw.select(*needed), ["patient_id"], "_load_ts", ties)


def stage_patients(raw: DataFrame, keep_order: bool = False) -> DataFrame:
    """Latest row per patient with masked ssn and phone; `keep_order` keeps what ranked it."""
    order = ["_load_ts", *[c for c in FILE_ORDER if c in raw.columns]] if keep_order else []
    return _latest_patients(raw).select(
        *PATIENT_COLUMNS, mask_ssn("ssn").alias("ssn_masked"), mask_phone("phone").alias("phone_masked"), *order
    )


def stg_patients(raw: DataFrame) -> DataFrame:
    """Latest row per patient, personal columns as stored (masked on load or on read)."""
    return _latest_patients(raw).select(
        *[F.col(c).cast("date").alias(c) if c == "birth_date" else F.col(c) for c in PATIENT_COLUMNS],
        F.col("ssn").alias("ssn_masked"),
        F.col("phone").alias("phone_masked"),
    )


dt_patients = stg_patients


def _encounter_columns() -> dict[str, Column]:
    started, stopped = vget("v", "start", "timestamp_ntz"), vget("v", "stop", "timestamp_ntz")
    return {
        "encounter_id": vget("v", "encounter_id"),
        "patient_id": vget("v", "patient_id"),
        "started_at": started,
        "stopped_at": stopped,
        "encounter_class": vget("v", "encounter_class"),
        "provider_name": vget("v", "provider.name"),
        "facility_id": vget("v", "provider.facility_id"),
        "facility_name": vget("v", "provider.facility_name"),
        "city": vget("v", "provider.city"),
        "state": vget("v", "provider.state"),
        "duration_minutes": minutes_between(started, stopped),
        "observation_count": json_array_size("v", "observations"),
        "condition_count": json_array_size("v", "conditions"),
        "payer": vget("v", "billing.payer"),
        "total_charge": vget("v", "billing.total_charge", MONEY),
        "paid_amount": vget("v", "billing.paid_amount", MONEY),
        "claim_status": vget("v", "billing.claim_status"),
    }


BILLING = ("payer", "total_charge", "paid_amount", "claim_status")


def encounters_flat(raw: DataFrame, *carried: str) -> DataFrame:
    """Every document as one typed row (a repeated encounter stays repeated)."""
    return raw.select(*[e.alias(n) for n, e in _encounter_columns().items()], *carried)


def stage_encounters(raw: DataFrame) -> DataFrame:
    """Flattened encounters, the latest load of each; documents without an id are all kept. Flattening first keeps the shuffle narrow."""
    ties = [c for c in FILE_ORDER if c in raw.columns]
    flat = encounters_flat(raw, "_load_ts", *ties)
    return latest_per_key(flat, ["encounter_id"], "_load_ts", ties, null_is_key=False).drop("_load_ts", *ties)


def stg_encounters(raw: DataFrame) -> DataFrame:
    """The 13 columns without billing."""
    return raw.select(*[e.alias(n) for n, e in _encounter_columns().items() if n not in BILLING])


def dt_encounters(raw: DataFrame) -> DataFrame:
    """The narrow 8-column projection."""
    wanted = ("encounter_id", "patient_id", "started_at", "encounter_class", "provider_name", "state", "payer", "total_charge")
    columns = _encounter_columns()
    return raw.select(*[columns[n].alias(n) for n in wanted])


def observations_flat(raw: DataFrame) -> DataFrame:
    """One row per observation of every document."""
    return explode_array(raw.select("v"), "v", "observations", "_o").select(
        vget("v", "encounter_id").alias("encounter_id"),
        vget("_o", "code").alias("obs_code"),
        vget("_o", "description").alias("obs_description"),
        vget("_o", "value", "double").alias("obs_value"),
        vget("_o", "units").alias("obs_units"),
    )


stg_observations = observations_flat


def stage_observations(raw: DataFrame) -> DataFrame:
    """Observations of the latest load of each encounter; only that sub-document is shuffled."""
    ties = [c for c in FILE_ORDER if c in raw.columns]
    docs = _observation_arrays(raw, "_load_ts", *ties)
    return _observation_rows(latest_per_key(docs, ["encounter_id"], "_load_ts", ties, null_is_key=False))


def _observation_arrays(raw: DataFrame, *carried: str) -> DataFrame:
    return raw.select(
        vget("v", "encounter_id").alias("encounter_id"),
        # one variant: in an array every element would carry the names of all fields
        F.try_variant_get("v", "$.observations", "variant").alias("_os"), *carried,
    )


def _observation_rows(docs: DataFrame) -> DataFrame:
    return docs.select("encounter_id", F.explode(F.try_variant_get("_os", "$", "array<variant>")).alias("_o")).select(
        "encounter_id",
        vget("_o", "code").alias("obs_code"),
        vget("_o", "description").alias("obs_description"),
        vget("_o", "value", "double").alias("obs_value"),
        vget("_o", "units").alias("obs_units"),
    )


def stage_documents(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(`stage_encounters`, `stage_observations`) from one ranking of the documents.

    What is ranked is narrow: id, load time, file and row of encounters that were loaded more than once.
    The documents that a later load replaces are then left out of the flattened rows, which are not
    shuffled while those are few, and never whole. Documents that cannot be told apart (no file and row,
    or one of them repeated) are ranked whole.
    """
    place = ["_load_ts", *FILE_ORDER]
    if any(c not in raw.columns for c in place):
        return stage_encounters(raw), stage_observations(raw)
    named = raw.select(vget("v", "encounter_id").alias("_id"), F.struct(*place).alias("_at"))
    # as `latest_per_key` ranks: greatest first, NULL last; one row per key and task is shuffled
    held = named.filter(F.col("_id").isNotNull()).groupBy("_id").agg(F.max("_at").alias("_last"), F.count(F.lit(1)).alias("_n"))
    again = named.join(held.filter("_n > 1").select("_id", "_last"), "_id")
    ranked = materialize(again.groupBy("_id", "_at", (F.col("_at") == F.col("_last")).alias("_wins")).agg(F.count(F.lit(1)).alias("_n")), "loaded_again")
    if not ranked.filter("_wins and _n > 1").isEmpty():
        return stage_encounters(raw), stage_observations(raw)
    lost = small_or_not(ranked.filter("not _wins").select(F.col("_id").alias("_lost_id"), F.col("_at").alias("_lost_at")), "replaced")
    same = (F.col("encounter_id") == F.col("_lost_id")) & F.struct(*place).eqNullSafe(F.col("_lost_at"))

    def standing(rows: DataFrame) -> DataFrame:
        return rows.join(lost, same, "left_anti").drop(*place)

    return standing(encounters_flat(raw, *place)), _observation_rows(standing(_observation_arrays(raw, *place)))


def conditions_flat(raw: DataFrame) -> DataFrame:
    """One row per condition; documents with an empty array give none."""
    return explode_array(raw.select("v"), "v", "conditions", "_c").select(
        vget("v", "patient_id").alias("patient_id"),
        vget("_c", "code").alias("condition_code"),
        vget("_c", "description").alias("condition_description"),
    )


stage_conditions = conditions_flat

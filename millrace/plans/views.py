"""The model as temporary views, for people who write SQL."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..functions.masking import register_functions
from ..operators.aggregates import load_health
from . import staging

# Names of the views.
VIEWS = {
    "v_patients_dedup": ("patients", staging.stage_patients),
    "v_encounters_flat": ("encounters", staging.encounters_flat),
    "v_observations_flat": ("encounters", staging.observations_flat),
    "dt_patients": ("patients", staging.dt_patients),
    "dt_encounters": ("encounters", staging.dt_encounters),
}


def register_views(spark: SparkSession, raw_patients: DataFrame, raw_encounters: DataFrame,
                   load_log: DataFrame | None = None) -> None:
    """RAW tables, the staging views over them, the mask functions and the load-health view."""
    raw = {"patients": raw_patients, "encounters": raw_encounters}
    raw_patients.createOrReplaceTempView("patients_csv")
    raw_encounters.createOrReplaceTempView("encounters_json")
    register_functions(spark)
    for name, (source, build) in VIEWS.items():
        build(raw[source]).createOrReplaceTempView(name)
    if load_log is not None:
        load_log.createOrReplaceTempView("load_log")
        load_health(load_log).createOrReplaceTempView("vw_pipeline_health")


def register_model(tables: Mapping[str, DataFrame]) -> None:
    """Tables of `backfill` or of the maintained model under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)

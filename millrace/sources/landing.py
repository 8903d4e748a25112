"""Bulk file loads into RAW tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.tables import append, overwrite
from .files import read_csv_by_name, read_ndjson_variant, typed, with_load_time

# Columns of the two RAW tables.
PATIENT_SCHEMA = T.StructType(
    [
        T.StructField("patient_id", T.StringType()),
        T.StructField("first_name", T.StringType()),
        T.StructField("last_name", T.StringType()),
        T.StructField("birth_date", T.DateType()),
        T.StructField("gender", T.StringType()),
        T.StructField("ssn", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("zip", T.StringType()),
        T.StructField("phone", T.StringType()),
    ]
)
RAW_PATIENTS = "patients_csv"
RAW_ENCOUNTERS = "encounters_json"


def patients_from_csv(spark: SparkSession, paths: Sequence[str], load_ts: Column | None = None,
                      on_error: str = "continue", schema: T.StructType = PATIENT_SCHEMA) -> DataFrame:
    rows = read_csv_by_name(spark, paths, schema.fieldNames())
    out = typed(rows, schema, on_error)
    return out if on_error == "return_errors" else with_load_time(out, load_ts)


def encounters_from_ndjson(spark: SparkSession, paths: Sequence[str] | str, load_ts: Column | None = None,
                           on_error: str = "continue") -> DataFrame:
    out = read_ndjson_variant(spark, paths, on_error, lineage=True)
    return out if on_error == "return_errors" else with_load_time(out, load_ts)


def load_files(rows: DataFrame, path: str, truncate: bool = False) -> int:
    """Append the rows, or replace the table by them; returns the rows the table then gained."""
    if not truncate:
        return append(rows, path)
    overwrite(rows, path)
    return rows.sparkSession.read.parquet(path).count()

"""Aggregations of the landed model; all of them combine inside the map tasks first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def observation_stats(observations: DataFrame) -> DataFrame:
    """Per code: one description, number of observations and average value."""
    return observations.groupBy("obs_code").agg(
        F.min("obs_description").alias("description"),
        F.count(F.lit(1)).alias("n_observations"),
        F.round(F.avg("obs_value"), 2).alias("avg_value"),
    )


def range_stats(df: DataFrame, key: str, low, high, measure: str) -> DataFrame:
    """Count and average of a measure where key is between low and high (both included)."""
    return df.filter(F.col(key).between(low, high)).agg(
        F.count(F.lit(1)).alias("n_rows"), F.avg(measure).alias("avg_value")
    )


def distinct_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()


def duplicate_keys(df: DataFrame, keys: Sequence[str], where: Column | None = None) -> DataFrame:
    """Keys held by more than one row, with the number of rows."""
    rows = df if where is None else df.filter(where)
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def load_health(log: DataFrame) -> DataFrame:
    """Per target: loads, rows written, time and user of the last load."""
    return log.groupBy("target").agg(
        F.count(F.lit(1)).alias("loads"),
        F.sum("rows_written").alias("total_rows_written"),
        F.max("loaded_at").alias("last_loaded_at"),
        F.max_by("loaded_by", "loaded_at").alias("last_loaded_by"),
    )


def run_totals(log: DataFrame, run_id: str | None = None) -> DataFrame:
    """Rows read and written per run."""
    rows = log if run_id is None else log.filter(F.col("run_id") == run_id)
    return rows.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("n_tables"),
        F.sum("rows_read").alias("rows_read"),
        F.sum("rows_written").alias("rows_written"),
    )


def top(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first n rows of an order, kept per task before they meet."""
    return df.orderBy(*order).limit(n)

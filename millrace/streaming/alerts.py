"""Sliding failure alert over the run history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The state looked for and the alert text.
FAILED = "FAILED"
MESSAGE = "Task failure detected in the last 10 minutes"


def failure_alert(history: DataFrame, lookback: str = "10 minutes", every: str = "5 minutes",
                  ts: str = "scheduled_time") -> DataFrame:
    """One alert per check time whose look-back holds a failure; batch or streaming.

    Only failures enter the windows, and they combine per task before they are shuffled.
    """
    failures = history.filter(F.col("state") == FAILED)
    if history.isStreaming:
        # watermarks need a timestamp with zone
        failures = failures.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, lookback)
    windows = failures.groupBy(F.window(ts, lookback, every).alias("w")).agg(F.count(F.lit(1)).alias("failures"))
    return windows.select(
        F.col("w.end").cast("timestamp_ntz").alias("alerted_at"), F.lit(MESSAGE).alias("message"), "failures"
    )

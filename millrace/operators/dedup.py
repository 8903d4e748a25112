"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame, keys: Sequence[str], ts: str, ties: Sequence[str] = (), null_is_key: bool = True
) -> DataFrame:
    """Newest row of each key, NULL times last, `ties` (descending) breaking equal times.

    The `= 1` filter on row_number lets Spark keep one row per key and map task before the
    shuffle (WindowGroupLimit), so a key holding most rows never gathers in one task. Without
    `null_is_key` rows that lack part of the key are all kept.
    """
    order = [F.col(c).desc_nulls_last() for c in (ts, *ties)]
    if null_is_key:
        ranked = df.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
        return ranked.filter(F.col("_rank") == 1).drop("_rank")
    lacking = F.lit(False)
    for key in keys:
        lacking = lacking | F.col(key).isNull()
    alone = df.withColumn("_alone", F.when(lacking, F.monotonically_increasing_id()))
    ranked = alone.withColumn("_rank", F.row_number().over(W.partitionBy(*keys, "_alone").orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank", "_alone")

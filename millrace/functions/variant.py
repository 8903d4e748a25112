"""Access to semi-structured documents held as Variant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def vget(v: Column | str, path: str, type_: str = "string", strict: bool = True) -> Column:
    """Value at `path` as `type_`: missing gives NULL, a bad cast raises unless `strict=False`."""
    get = F.variant_get if strict else F.try_variant_get
    return get(v, "$." + path, type_)


def json_array_size(v: Column | str, path: str) -> Column:
    """Element count; NULL where the path is absent or not an array."""
    return F.array_size(F.try_variant_get(v, "$." + path, "array<variant>")).cast("bigint")


def explode_array(df: DataFrame, v: str, path: str, alias: str) -> DataFrame:
    """One row per array element; documents without elements give no row."""
    return df.withColumn(alias, F.explode(F.try_variant_get(v, "$." + path, "array<variant>")))

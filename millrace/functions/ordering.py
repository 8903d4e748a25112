"""Numeric-aware order of high-water marks kept as text, and the strict `> since` filter."""

from __future__ import annotations

from datetime import date, datetime
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A number as text. Spark's own cast also takes '10d' and hex floats, which are text here.
NUMERIC_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def hwm_key(c: Column | str) -> Column:
    """Sortable key: numbers first and by value, then other text by string order.

    Numbers compare as decimals with ten places (64-bit ids keep every digit); doubles order what lies
    beyond the decimals' range and, among equal decimals, further places.
    """
    text = (F.col(c) if isinstance(c, str) else c).cast("string")
    trimmed = F.when(text.rlike(NUMERIC_TEXT), F.trim(text))
    number, exact = trimmed.try_cast("double"), trimmed.try_cast("decimal(38,10)")
    return F.struct(
        number.isNull().alias("is_text"),
        F.when(exact.isNull(), F.signum(number)).otherwise(0.0).alias("beyond"),
        exact.alias("exact"),
        number.alias("number"),
        F.when(number.isNull(), text).alias("text"),
    )


def hwm_gt(c: Column | str, since: Any) -> Column:
    """Strictly after `since` in the order of `hwm_key`; NULL marks never qualify."""
    text = (F.col(c) if isinstance(c, str) else c).cast("string")
    return text.isNotNull() & (hwm_key(text) > hwm_key(F.lit(str(since))))


def hwm_filter(df: DataFrame, hwm: str, since: Any, text_order: bool = False) -> DataFrame:
    """Rows after `since`; no filter when there is no mark yet.

    Typed columns compare natively, so the predicate reaches Parquet and JDBC scans. `text_order`
    picks the numeric-aware order for text columns of files without types.
    """
    if hwm not in df.columns:
        raise ValueError(f"hwm column {hwm!r} not in {df.columns}")
    return df if since is None else df.filter(hwm_after(df, hwm, since, text_order))


def hwm_after(df: DataFrame, hwm: str, since: Any, text_order: bool = False) -> Column:
    """The condition behind `hwm_filter`, for counting."""
    if text_order:
        return hwm_gt(hwm, since)
    return F.col(hwm) > _mark(df, hwm, since)


def hwm_upto(df: DataFrame, hwm: str, mark: Any, text_order: bool = False) -> Column:
    """Marks at or before `mark`; NULL marks are not."""
    if text_order:
        return F.col(hwm).isNotNull() & (hwm_key(hwm) <= hwm_key(F.lit(str(mark))))
    return F.col(hwm) <= _mark(df, hwm, mark)


def _mark(df: DataFrame, hwm: str, since: Any) -> Column:
    # dates and times go in as text: a time literal would pass through the session's zone
    text = since.isoformat(sep=" ") if isinstance(since, datetime) else since.isoformat() if isinstance(since, date) else since
    return F.lit(text).cast(df.schema[hwm].dataType)


def order_value(df: DataFrame, hwm: str, text_order: bool = False) -> Column:
    """The expression a column's marks sort by."""
    is_text = isinstance(df.schema[hwm].dataType, T.StringType)
    return hwm_key(hwm) if text_order and is_text else F.col(hwm)

"""Masking on read: by the reader's role and by column tag (kept in the field metadata)."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .masking import PHONE_PREFIX, SSN_PREFIX, keep_last4

# The role that sees clear text, the tag name, and the tag mask.
READER_ROLE = "PII_READER"
PII_TAG = "pii"
TAG_MASK = "***MASKED***"

READ_POLICIES: dict[str, Callable[[Column], Column]] = {
    # unlike the load masks, '' has no digits and so becomes the placeholder
    "mask_ssn": lambda c: keep_last4(c, SSN_PREFIX),
    "mask_phone": lambda c: keep_last4(c, PHONE_PREFIX),
}


def policy_view(df: DataFrame, role: str, policies: Mapping[str, str]) -> DataFrame:
    """The table as `role` may see it; the role is resolved while planning, not per row."""
    unknown = set(policies.values()) - set(READ_POLICIES)
    if unknown:
        raise ValueError(f"unknown read policy {sorted(unknown)}")
    if role == READER_ROLE:
        return df
    return df.select(
        *[READ_POLICIES[policies[c]](F.col(c)).alias(c) if c in policies else F.col(c) for c in df.columns]
    )


def tag(df: DataFrame, column: str, name: str, value: str) -> DataFrame:
    """Attach a tag to a column; it travels with the schema through select and Parquet."""
    kept = dict(df.schema[column].metadata or {})
    tags = dict(kept.get("tags", {}))
    tags[name] = value
    kept["tags"] = tags
    return df.withColumn(column, F.col(column).alias(column, metadata=kept))


def tagged_columns(df: DataFrame, name: str = PII_TAG) -> list[str]:
    return [f.name for f in df.schema.fields if name in (f.metadata or {}).get("tags", {})]


def mask_tagged(df: DataFrame, role: str, name: str = PII_TAG) -> DataFrame:
    """Every tagged column reads as the tag mask unless the role may see it."""
    if role == READER_ROLE:
        return df
    hidden = {
        c: F.when(F.col(c).isNotNull(), F.lit(TAG_MASK)).alias(c, metadata=dict(df.schema[c].metadata))
        for c in tagged_columns(df, name)
    }
    return df.select(*[hidden.get(c, F.col(c)) for c in df.columns])

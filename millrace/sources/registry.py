"""Choose a reader by the configured source type."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ordering import hwm_after, hwm_filter
from . import files, jdbc
from .identifiers import check_identifier
from .paged_api import read_paged_api
from .workbook import read_workbook


def _database(kind: str) -> Callable[..., DataFrame]:
    def read(spark, source, table, hwm, since):
        return jdbc.read_jdbc(
            spark, jdbc.jdbc_options(kind, source), table, hwm, since,
            source.get("partition_column"), int(source.get("num_partitions", 8)), source.get("cuts", ()),
        )

    return read


def _table_path(source: Mapping[str, Any], table: str, suffix: str) -> str:
    if source.get("path"):
        return source["path"]
    return f"{source['root'].rstrip('/')}/{table}{suffix}"


def _parquet(spark, source, table, hwm, since):
    return files.read_parquet_incremental(spark, _table_path(source, table, ".parquet"), hwm, since)


def _csv(spark, source, table, hwm, since):
    return files.read_csv_incremental(spark, _table_path(source, table, ".csv"), hwm, since)


def _rest(spark, source, table, hwm, since):
    return read_paged_api(spark, source, table, hwm, since)


def _excel(spark, source, table, hwm, since):
    df = read_workbook(spark, source["path"], table, source.get("columns"))
    return hwm_filter(df, hwm, since, text_order=True) if df.columns else df


READERS: dict[str, Callable[..., DataFrame]] = {
    **{kind: _database(kind) for kind in jdbc.URLS},
    "jdbc": _database("jdbc"),
    "rest": _rest,
    "excel": _excel,
    "parquet": _parquet,
    "csv": _csv,
}
# file formats without types order their text marks by number where they can
TEXT_ORDER = {"csv", "excel"}
# sources whose reading is not cut by a filter
READ_ONCE = {"rest", "excel"}


def read_source(spark: SparkSession, source: Mapping[str, Any], table: str, hwm: str, since: Any = None) -> DataFrame:
    """Rows of `table` whose mark is after `since`, as a lazy DataFrame."""
    kind = source.get("type", "sqlserver")
    if kind not in READERS:
        raise ValueError(f"unknown source type {kind!r}; known: {sorted(READERS)}")
    check_identifier("table", table)
    check_identifier("hwm_column", hwm)
    return READERS[kind](spark, source, table, hwm, since)


def pending_count(df: DataFrame, hwm: str, since: Any = None, text_order: bool = False) -> int:
    """How many rows a load would read."""
    return hwm_filter(df, hwm, since, text_order).count()


def pending_counts(df: DataFrame, hwm: str, since: Any, by: list[str], text_order: bool = False) -> DataFrame:
    """Pending and total rows per group in one pass."""
    after = F.count(F.lit(1)) if since is None else F.count_if(
        hwm_after(df, hwm, since, text_order)
    )
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("total_rows"), after.alias("pending_rows"))

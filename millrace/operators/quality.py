"""Data-quality checks: each gives rows (check, violations); a gate fails on any violation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .aggregates import duplicate_keys


def row_checks(df: DataFrame, violations: Mapping[str, Column]) -> DataFrame:
    """Any number of per-row checks in one pass over the table."""
    names = list(violations)
    counts = df.agg(*[F.count_if(violations[n]).alias(f"_{i}") for i, n in enumerate(names)])
    entries = [F.struct(F.lit(n).alias("check"), F.col(f"_{i}").alias("violations")) for i, n in enumerate(names)]
    return counts.select(F.inline(F.array(*entries)))


def is_missing(col: str) -> Column:
    return F.col(col).isNull()


def not_like(col: str, pattern: str) -> Column:
    """Non-NULL values that do not match the pattern."""
    return F.col(col).isNotNull() & ~F.col(col).like(pattern)


def not_in(col: str, accepted: Sequence[str]) -> Column:
    return F.col(col).isNotNull() & ~F.col(col).isin(*accepted)


def check_fk(name: str, df: DataFrame, col: str, dim: DataFrame, dim_col: str, null_ok: bool = True) -> DataFrame:
    """Rows whose foreign key has no partner. Keys are counted before the join, so a key that
    holds most rows is a single row by then."""
    counts = df.groupBy(F.col(col).alias("_fk")).agg(F.count(F.lit(1)).alias("_n"))
    if null_ok:
        counts = counts.filter(F.col("_fk").isNotNull())
    known = dim.select(F.col(dim_col).alias("_pk"))
    orphans = counts.join(known, F.col("_fk") == F.col("_pk"), "left_anti")
    return orphans.agg(
        F.lit(name).alias("check"), F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("violations")
    )


def check_unique(name: str, df: DataFrame, keys: Sequence[str], where: Column | None = None,
                 skip_null: bool = False) -> DataFrame:
    """Number of keys held by more than one row."""
    if skip_null:
        present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        where = present if where is None else where & present
    return duplicate_keys(df, keys, where).agg(
        F.lit(name).alias("check"), F.count(F.lit(1)).alias("violations")
    )


def dq_gate(parts: Sequence[DataFrame]) -> DataFrame:
    """All checks as one report (check, violations, status)."""
    report = reduce(DataFrame.unionByName, parts)
    return report.withColumn("status", F.when(F.col("violations") == 0, "PASS").otherwise("FAIL"))


class QualityError(AssertionError):
    pass


def enforce(report: DataFrame) -> None:
    """Raise when a check has violations."""
    failed = report.filter("status = 'FAIL'").collect()
    if failed:
        raise QualityError("; ".join(f"{r['check']}: {r['violations']}" for r in failed))

"""Global positions without a single-task window: prefix sums in two distributed passes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.ordering import order_value
from ..session import materialize


def running_total(df: DataFrame, order: Sequence[str], totals: Mapping[str, Column]) -> DataFrame:
    """Inclusive running sums of `totals` over the global order of `order`.

    `order` must identify a row (or near enough that no value repeats without bound): range
    partitions then balance. Pass one writes the ranges with their number; the per-range sums
    (one row per task) give each range its offset; pass two adds up inside each range.
    """
    added = [c for c in totals]
    ranged = df.select("*", *[e.alias(f"_w_{n}") for n, e in totals.items()])
    # without a number AQE may join small neighbouring ranges, which keeps their order
    ranged = ranged.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    stored = materialize(ranged, "ranges")

    offsets = _offsets(stored, {c: F.sum(f"_w_{c}") for c in added})
    inside = W.partitionBy("_range").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    return (
        stored.select("*", *[F.sum(f"_w_{c}").over(inside).alias(f"_t_{c}") for c in added])
        .join(F.broadcast(offsets), "_range")
        .select(*df.columns, *[(F.col(f"_t_{c}") + F.col(f"_o_{c}")).cast("bigint").alias(c) for c in added])
    )


def _offsets(stored: DataFrame, sums: Mapping[str, Column]) -> DataFrame:
    """What lies before each range: one row per range, bounded by the number of shuffle partitions,
    so one ordered window over it and its broadcast are small."""
    per_range = stored.groupBy("_range").agg(*[e.alias(f"_s_{c}") for c, e in sums.items()])
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    return per_range.select(
        "_range", *[F.coalesce(F.sum(f"_s_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in sums]
    )


def with_rank(df: DataFrame, order: Sequence[str], name: str = "rank") -> DataFrame:
    """1-based global row number over unique `order` columns.

    As `running_total` of ones, but the place inside a sorted range is already known when the range
    is written, so the second pass only adds the offset and does not shuffle.
    """
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    stored = materialize(ranged.select("*", F.spark_partition_id().alias("_range"), place.alias("_place")), "ranks")
    offsets = _offsets(stored, {"n": F.count(F.lit(1))})
    rank = (F.col("_o_n") + F.col("_place") + 1).cast("bigint").alias(name)
    return stored.join(F.broadcast(offsets), "_range").select(*df.columns, rank)


def assign_ids(df: DataFrame, keys: Sequence[str], id_name: str, start: int = 1) -> DataFrame:
    """Number rows from `start` in the order of their unique keys."""
    ranked = with_rank(df, keys, "_rank")
    return ranked.select((F.col("_rank") + (start - 1)).alias(id_name), *df.columns)


def hwm_chunks(df: DataFrame, hwm: str, n: int, text_order: bool = False) -> DataFrame:
    """`chunk_id` and `chunk_hwm` per row: batches of about `n` rows in mark order.

    Rows with an equal mark stay in one chunk (that of the first of them), so a checkpoint taken
    after a chunk never hides half of a tie. Only the counts per distinct mark are ordered; rows
    are counted before the shuffle, and one mark holding most rows is one row here.
    """
    ranked, marks = _ranked_marks(df, hwm, text_order)
    lookup = _chunk(ranked, "_last", n, "_order")
    if text_order:
        lookup = marks.select("_mark", "_order").join(lookup, "_order").drop("_order")
    else:
        lookup = lookup.withColumnRenamed("_order", "_mark")
    return df.join(lookup, F.col(hwm) == F.col("_mark")).drop("_mark")


def hwm_cuts(df: DataFrame, hwm: str, n: int, per: int, most: int, text_order: bool = False) -> DataFrame:
    """(`group`, `mark`, `rows`, `batches`): the batches of `hwm_chunks` in runs of `per`, or of as many as
    bring the number of groups down to about `most`; `mark` is a group's last one. Only marks are read."""
    ranked, _ = _ranked_marks(df.select(hwm), hwm, text_order)
    ranked = materialize(ranked.withColumn("_chunk", F.floor((F.col("_upto") - F.col("_n")) / F.lit(n))), "marks")
    last = ranked.agg(F.max("_chunk")).first()[0] or 0
    run = max(per, -(-(last + 1) // most))
    groups = ranked.groupBy(F.floor(F.col("_chunk") / run).cast("bigint").alias("group"))
    return groups.agg(F.max_by("_last", "_upto").alias("mark"), F.sum("_n").alias("rows"), F.count_distinct("_chunk").alias("batches"))


def _ranked_marks(df: DataFrame, hwm: str, text_order: bool) -> tuple[DataFrame, DataFrame]:
    """Distinct marks with their rows `_n` and the rows up to them `_upto`, and every spelling of a mark."""
    marks = df.filter(F.col(hwm).isNotNull()).groupBy(F.col(hwm).alias("_mark")).agg(F.count(F.lit(1)).alias("_n"))
    if text_order:
        # '10' and '10.0' are one mark: tie on the number, keep both spellings
        marks = marks.withColumn("_order", order_value(marks, "_mark", True))
        groups = marks.groupBy("_order").agg(F.sum("_n").alias("_n"), F.max("_mark").alias("_last"))
        return running_total(groups, ["_order"], {"_upto": F.col("_n")}), marks
    ranked = running_total(marks, ["_mark"], {"_upto": F.col("_n")})
    return ranked.withColumnRenamed("_mark", "_order").withColumn("_last", F.col("_order")), marks


def _chunk(ranked: DataFrame, last: str, n: int, key: str) -> DataFrame:
    with_id = ranked.withColumn("chunk_id", F.floor((F.col("_upto") - F.col("_n")) / F.lit(n)).cast("bigint"))
    ends = with_id.groupBy("chunk_id").agg(F.max_by(last, "_upto").alias("chunk_hwm"))
    return with_id.select(key, "chunk_id").join(ends, "chunk_id")

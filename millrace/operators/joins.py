"""Join shapes of the dimensional model.

No side is hinted: Catalyst broadcasts a side whose size it knows to be under the threshold, AQE
does so at run time, and beyond that a sort-merge join with skew splitting takes over.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, ship_package


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Key equality where NULL matches NULL; still planned as an equi-join."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[k])
    return cond


def missing(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of `left` without a partner (NULL keys have none)."""
    return left.join(right.select(*keys), list(keys), "left_anti")


def restrict(df: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys occur in `wanted`."""
    return df.join(wanted.select(*keys), list(keys), "left_semi")


def with_exists_flag(df: DataFrame, other: DataFrame, key: str, flag: str = "known") -> DataFrame:
    """Whether the key occurs in `other`, as a column."""
    seen = other.filter(F.col(key).isNotNull()).select(F.col(key).alias("_seen")).distinct()
    joined = df.join(seen, df[key] == F.col("_seen"), "left")
    return joined.withColumn(flag, F.col("_seen").isNotNull()).drop("_seen")


def star_join(fact: DataFrame, dims: Mapping[str, tuple[DataFrame, str, str, str]]) -> DataFrame:
    """Left-join dimensions: name -> (dimension, fact column, natural key, surrogate key)."""
    out = fact
    for name, (dim, fact_col, natural, surrogate) in dims.items():
        looked_up = dim.select(F.col(natural).alias(f"_nk_{name}"), F.col(surrogate))
        out = out.join(looked_up, F.col(fact_col) == F.col(f"_nk_{name}"), "left").drop(f"_nk_{name}")
    return out


def current_join(fact: DataFrame, dim: DataFrame, key: str, surrogate: str) -> DataFrame:
    """Left join to the current versions only."""
    current = dim.filter("is_current").select(key, surrogate)
    return fact.join(current, key, "left")


def rank_lookup(df: DataFrame, ranked: DataFrame, rank: str, by: str) -> DataFrame:
    """Rows of `ranked` picked by a drawn rank."""
    return df.join(ranked.withColumnRenamed(by, "_by"), F.col(rank) == F.col("_by")).drop("_by", rank)


def asof_join(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    ts: str,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    payload: Sequence[str] = (),
    many_versions: bool | None = None,
    version_limit: int = 1000,
) -> DataFrame:
    """Left join to the version valid at `ts`: from inclusive, to exclusive, open end NULL.

    With few versions per key this is an equi-join with a range residual. A key with very many
    versions would make that residual quadratic, so beyond `version_limit` (counted on the
    dimension when `many_versions` is not given) `asof_join_sorted` is used. Versions of a key must not
    overlap; then both give the same. An empty version (from = to) is valid at no time in either form.
    """
    if many_versions is None:
        top = dim.groupBy(key).count().agg(F.max("count")).first()[0] or 0
        many_versions = top > version_limit
    if many_versions:
        return asof_join_sorted(fact, dim, key, ts, valid_from, valid_to, payload)
    versions = dim.select(
        F.col(key).alias("_key"), F.col(valid_from).alias("_from"), F.col(valid_to).alias("_to"), *payload
    )
    cond = (
        (F.col(key) == F.col("_key"))
        & (F.col(ts) >= F.col("_from"))
        & ((F.col(ts) < F.col("_to")) | F.col("_to").isNull())
    )
    return fact.join(versions, cond, "left").drop("_key", "_from", "_to")


def asof_join_sorted(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    ts: str,
    valid_from: str,
    valid_to: str,
    payload: Sequence[str],
) -> DataFrame:
    """The same join by sorting facts and versions together: linear for any number of versions.

    Both sides are range-partitioned by (key, time, side, row hash), so one hot key spreads over
    many ranges; that is the only shuffle. Each task carries the last version of a key forward through
    its sorted range (`_carry`, whole Arrow batches at a time) and writes facts with their versions. Only
    the last version of each range, one row per task, is then handed on to the facts at the head of
    later ranges. Column types are those that Arrow carries.
    """
    ship_package(fact.sparkSession, "millrace")
    row = F.struct(*[F.col(f"`{c}`") for c in fact.columns])
    version = F.struct(F.col(valid_from).alias("_from"), F.col(valid_to).alias("_to"), *payload)
    facts = fact.select(
        F.col(key).alias("_key"), F.col(ts).alias("_ts"), F.lit(1).alias("_side"), row.alias("_row"),
        F.xxhash64(*[F.col(f"`{c}`") for c in fact.columns]).alias("_spread"),
    )
    ends_later = F.col(valid_to).isNull() | (F.col(valid_from) < F.col(valid_to))
    versions = dim.filter(F.col(key).isNotNull() & ends_later).select(
        F.col(key).alias("_key"), F.col(valid_from).alias("_ts"), F.lit(0).alias("_side"),
        version.alias("_version"), F.lit(0).cast("bigint").alias("_spread"), F.col(valid_to).alias("_end"),
    )
    # of versions that start together the one that ends last comes last
    order = ["_key", "_ts", "_side", F.col("_end").asc_nulls_last(), "_spread"]
    both = facts.unionByName(versions, allowMissingColumns=True)
    ranged = both.repartitionByRange(*order).sortWithinPartitions(*order).select("_key", "_side", "_version", "_row")
    kinds = {f.name: f.dataType for f in ranged.schema.fields}
    carried = T.StructType([
        T.StructField("_range", T.IntegerType()), T.StructField("_tail", T.BooleanType()), T.StructField("_open", T.BooleanType()),
        *[T.StructField(c, kinds[c]) for c in ("_key", "_version", "_row")],
    ])
    stored = materialize(ranged.mapInArrow(_carry, carried), "asof")

    # one row per range: its last version and that version's key; then the last one before each range
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    tail = F.when(F.col("_version").isNotNull(), F.struct("_key", "_version"))
    handed = stored.filter("_tail").select("_range", F.last(tail, ignorenulls=True).over(before).alias("_carry"))
    found = stored.filter("not _tail").join(F.broadcast(handed), "_range", "left").withColumn(
        "_v", F.coalesce("_version", F.when(F.col("_open") & (F.col("_carry._key") == F.col("_key")), F.col("_carry._version")))
    )
    valid = (F.col("_row")[ts] < F.col("_v._to")) | F.col("_v._to").isNull()
    return found.select(
        *[F.col("_row")[c].alias(c) for c in fact.columns],
        *[F.when(valid, F.col("_v")[c]).alias(c) for c in payload],
    )


def _carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Facts of a range with the last version of their key, `_open` where the range holds none before
    them and an earlier range may; behind them one `_tail` row with the range's last version."""
    from pyspark import TaskContext

    number, head, last_key, last = TaskContext.get().partitionId(), None, None, None

    def rows(n: int, tail: bool, open_: pa.Array, *columns: pa.Array) -> pa.RecordBatch:
        fixed = [pa.array(np.full(n, number, dtype=np.int32)), pa.array(np.full(n, tail))]
        return pa.RecordBatch.from_arrays([*fixed, open_, *columns], ["_range", "_tail", "_open", "_key", "_version", "_row"])

    kind = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        keys, version, row = (batch.column(i) for i in (0, 2, 3))
        kind = (keys.type, version.type, row.type)
        head = keys[0] if head is None else head
        begins = np.ones(n, dtype=bool)
        # a NULL key has no versions: each of its rows stands alone
        begins[1:] = pc.fill_null(pc.not_equal(keys[1:], keys[:-1]), True).to_numpy(zero_copy_only=False)
        at = np.arange(n)
        start = np.maximum.accumulate(np.where(begins, at, 0))
        is_version = batch.column(1).to_numpy(zero_copy_only=False) == 0
        seen = np.maximum.accumulate(np.where(is_version, at, -1))
        # 0 is the version carried over from the batch before, if its key goes on here
        goes_on = last is not None and keys[0].is_valid and keys[0].equals(last_key)
        source = np.where(seen >= start, seen + 1, np.where((start == 0) & goes_on, 0, -1))
        pool = pa.concat_arrays([pa.nulls(1, version.type) if last is None else last, version])
        facts = np.flatnonzero(~is_version)
        if len(facts):
            chosen = source[facts]
            taken = pool.take(pa.array(np.maximum(chosen, 0), mask=chosen < 0))
            of_head = pc.fill_null(pc.equal(keys, head), False).to_numpy(zero_copy_only=False) if head.is_valid else np.zeros(n, dtype=bool)
            index = pa.array(facts)
            yield rows(len(facts), False, pa.array((chosen < 0) & of_head[facts]), keys.take(index), taken, row.take(index))
        if seen[-1] >= 0:
            last, last_key = version.slice(int(seen[-1]), 1), keys[int(seen[-1])]
    if kind is not None:
        key = pa.nulls(1, kind[0]) if last is None else pa.array([last_key.as_py()], kind[0])
        yield rows(1, True, pa.array([False]), key, pa.nulls(1, kind[1]) if last is None else last, pa.nulls(1, kind[2]))

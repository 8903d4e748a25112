"""Slowly changing dimension with history: expire and insert in one pass at one batch time."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import hadoop_path, materialize, path_exists
from .merge import changed
from .positions import assign_ids
from .tables import next_number, read_snapshot, replace_snapshot, snapshot_number, write_batch

# The open start of a key's first version, and the stand-in for a missing birth date.
FIRST_FROM = "1900-01-01 00:00:00"
MISSING_DATE = "1900-01-01"


def scd2_steps(
    current: DataFrame,
    snapshot: DataFrame,
    key: str,
    tracked: Sequence[str],
    now: Column,
    null_safe: bool = False,
    first_from: Column | None = None,
    dates: Sequence[str] = ("birth_date",),
    history: DataFrame | None = None,
) -> DataFrame:
    """What one snapshot makes of the current versions, by one full outer join of the two.

    Rows of `current`'s columns with `_step`: `kept` and `closed` ones carry their surrogate key, `opened`
    ones have none yet. A key opens at `first_from` when it was never known, else at `now`. Each key has one
    current version and one snapshot row at most. Closed versions are not read, unless `history` gives some
    whose keys may have no current version; then only the keys that return are looked up among them.
    """
    first_from = F.lit(FIRST_FROM).cast("timestamp_ntz") if first_from is None else first_from
    null_as = {c: F.lit(MISSING_DATE).cast("date") for c in dates}
    snap = snapshot.select(*[F.col(c).alias(f"_s_{c}") for c in (key, *tracked)], F.lit(True).alias("_in_s"))
    held = current.select(*current.columns, F.lit(True).alias("_in_c"))
    joined = held.join(snap, F.col(key) == F.col(f"_s_{key}"), "full")
    in_c, in_s = F.col("_in_c").isNotNull(), F.col("_in_s").isNotNull()
    if history is None:
        known = in_c
    else:
        returning = joined.filter(~in_c).select(F.col(f"_s_{key}").alias(key))
        before = history.join(returning, key, "left_semi").select(F.col(key).alias("_h_key")).distinct()
        joined = joined.join(before, F.when(~in_c, F.col(f"_s_{key}")) == F.col("_h_key"), "left")
        known = in_c | F.col("_h_key").isNotNull()

    differs = changed("", "_s_", tracked, null_safe, null_as)
    hit = in_c & in_s & differs
    kind = current.schema
    ended = {"valid_to": now, "is_current": F.lit(False)}
    opened = {
        key: F.col(f"_s_{key}"), **{c: F.col(f"_s_{c}") for c in tracked},
        "valid_from": F.when(known, now).otherwise(first_from), "is_current": F.lit(True),
    }

    def version(values: dict[str, Column], step: Column) -> Column:
        return F.struct(*[values.get(c, F.lit(None)).cast(kind[c].dataType).alias(c) for c in current.columns], step.alias("_step"))

    as_it_was = {c: F.when(hit, ended[c]).otherwise(F.col(c)) if c in ended else F.col(c) for c in current.columns}
    both = F.array_compact(F.array(
        F.when(in_c, version(as_it_was, F.when(hit, "closed").otherwise("kept"))),
        F.when(in_s & (~in_c | differs), version(opened, F.lit("opened"))),
    ))
    return joined.select(F.inline(both))


def scd2_changes(
    dim: DataFrame,
    snapshot: DataFrame,
    key: str,
    tracked: Sequence[str],
    now: Column,
    null_safe: bool = False,
    first_from: Column | None = None,
    dates: Sequence[str] = ("birth_date",),
) -> tuple[DataFrame, DataFrame]:
    """(the dimension with changed current versions closed, the new versions without a key).

    A snapshot row opens a version when its key has no current version left: unknown keys open at
    `first_from`, known ones at `now`. With `null_safe` false a change from or to NULL goes
    unnoticed except for the date columns; true is the stricter snapshot comparison. Closed versions
    pass through without a shuffle.
    """
    is_open = F.coalesce(F.col("is_current"), F.lit(False))
    history = dim.filter(~is_open)
    steps = materialize(scd2_steps(dim.filter(is_open), snapshot, key, tracked, now, null_safe, first_from, dates, history), "steps")
    rewritten = history.unionByName(steps.filter("_step <> 'opened'").select(*dim.columns))
    return rewritten, steps.filter("_step = 'opened'").select(key, *tracked, "valid_from", "valid_to", "is_current")


class History:
    """A dimension kept as two tables, so that a snapshot costs what is current and not what is past.

    `current` is replaced as a whole behind its pointer, `closed` gets one partition per snapshot that
    closes versions and is never read by `apply`. A partition carries the number of the content it belongs
    to, and readers take those up to the content they resolve: both change in the same step. What a
    cut-off attempt left behind is removed by the next.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str, tracked: Sequence[str], sk: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.key, self.tracked, self.sk = key, tracked, sk

    def current(self) -> DataFrame:
        if not snapshot_number(self.spark, f"{self.path}/current"):
            return self.spark.createDataFrame([], self.schema)
        return read_snapshot(self.spark, f"{self.path}/current")

    def table(self) -> DataFrame:
        number = snapshot_number(self.spark, f"{self.path}/current")
        current = self.current()
        if not path_exists(self.spark, f"{self.path}/closed"):
            return current
        closed = self.spark.read.schema(f"{self.schema}, _content bigint").parquet(f"{self.path}/closed")
        return current.unionByName(closed.filter(F.col("_content") <= number).select(*current.columns))

    def apply(self, snapshot: DataFrame, now: Column, null_safe: bool = False, first_from: Column | None = None,
              surrogate: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
        """The dimension after one snapshot. `surrogate(opened)` numbers new versions; by default
        from the highest key on, in key order (new versions are current, so current rows hold the highest)."""
        current = self.current()
        steps = materialize(scd2_steps(current, snapshot, self.key, self.tracked, now, null_safe, first_from), "steps")
        opened = steps.filter("_step = 'opened'").drop("_step", self.sk)
        if surrogate is None:
            numbered = assign_ids(opened, [self.key], self.sk, (current.agg(F.max(self.sk)).first()[0] or 0) + 1)
        else:
            numbered = surrogate(opened)
        stands = snapshot_number(self.spark, f"{self.path}/current")
        number = next_number(self.spark, f"{self.path}/current")
        self._forget_beyond(stands)
        write_batch(steps.filter("_step = 'closed'").drop("_step"), str(number), f"{self.path}/closed", "_content")
        kept = steps.filter("_step = 'kept'").select(*current.columns)
        replace_snapshot(kept.unionByName(numbered.select(*current.columns)), f"{self.path}/current", number=number)
        return self.table()

    def _forget_beyond(self, number: int) -> None:
        fs, p = hadoop_path(self.spark, f"{self.path}/closed")
        for found in fs.listStatus(p) if fs.exists(p) else []:
            name = found.getPath().getName()
            if name.startswith("_content=") and int(name.split("=")[1]) > number:
                fs.delete(found.getPath(), True)


def scd2_apply(dim, snapshot, key, tracked, now, sk, next_id=None, null_safe=False, first_from=None) -> DataFrame:
    """The dimension after one snapshot, new versions numbered after the highest key.

    `next_id` saves the look-up of the highest key when the caller knows it. The snapshot needs one
    row per key.
    """
    closed, fresh = scd2_changes(dim, snapshot, key, tracked, now, null_safe, first_from)
    if next_id is None:
        next_id = (dim.agg(F.max(sk)).first()[0] or 0) + 1
    numbered = assign_ids(fresh, [key], sk, next_id)
    return closed.unionByName(numbered.select(*dim.columns))


def snapshot_apply(dim, snapshot, key, tracked, now, first_from=None) -> DataFrame:
    """Snapshot flavour: NULL-safe comparison, versions open at `now`, key = md5(key|valid_from)."""
    closed, fresh = scd2_changes(dim, snapshot, key, tracked, now, True, now if first_from is None else first_from)
    return closed.unionByName(with_hashed_id(fresh, key).select(*dim.columns))


def with_hashed_id(fresh: DataFrame, key: str, name: str = "scd_id") -> DataFrame:
    opened_at = F.date_format("valid_from", "yyyy-MM-dd HH:mm:ss")
    return fresh.withColumn(name, F.md5(F.concat(F.col(key), F.lit("|"), opened_at)))

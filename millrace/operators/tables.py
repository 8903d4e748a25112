"""Writing tables: append, replacement, snapshots behind a pointer, replay-safe batches, sorted layouts, merged buckets."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import hadoop_path, materialize, path_exists, read_text, replace_text


def upper_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def append(df: DataFrame, path: str) -> int:
    """Append and return the number of rows, counted by the write itself."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(path)
    return int(seen.get.get("n") or 0)


def _swap(spark: SparkSession, fresh: str, path: str) -> None:
    """Put a finished folder in the place of another. The old one steps aside first and goes last, so a
    crash in between leaves it beside the table, where `_recover` finds it."""
    fs, new = hadoop_path(spark, fresh)
    _, old = hadoop_path(spark, path)
    _, aside = hadoop_path(spark, path.rstrip("/") + "__before")
    if fs.exists(old):
        fs.delete(aside, True)
        if not fs.rename(old, aside):
            raise OSError(f"could not move {path} aside")
    if not fs.rename(new, old):
        fs.rename(aside, old)
        raise OSError(f"could not move {fresh} to {path}")
    fs.delete(aside, True)
    spark.catalog.refreshByPath(path)


def _recover(spark: SparkSession, path: str) -> None:
    """Undo a swap that was cut off between its two renames."""
    fs, old = hadoop_path(spark, path)
    _, aside = hadoop_path(spark, path.rstrip("/") + "__before")
    if not fs.exists(old) and fs.exists(aside):
        fs.rename(aside, old)


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a plain folder that the rows may themselves be read from: write beside it, then swap.

    Readers of a plain path may meet the moment between two renames; `replace_snapshot` has none.
    """
    _recover(df.sparkSession, path)
    fresh = path.rstrip("/") + "__next"
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(fresh)
    _swap(df.sparkSession, fresh, path)


_POINTER, _VERSION = "_current", "_v-"


def replace_snapshot(df: DataFrame, path: str, partition_by: Sequence[str] = (), keep: int = 2, number: int | None = None) -> DataFrame:
    """Replace a table as one step and return the new content.

    Each content is a folder of its own under `path`; one small file names the current one and is
    swapped in by a rename when the folder is complete. Readers (`read_snapshot`) resolve it once, so
    they see the old or the new table and never none, and a writer that dies leaves the old one. The
    last `keep` contents stay for readers that still use them; older ones and cut-off ones are removed.
    """
    spark, root = df.sparkSession, path.rstrip("/")
    found = _versions(spark, root)
    # two writers at once have folders of their own; the later swap wins
    name = f"{_VERSION}{number or next_number(spark, root):012d}-{uuid.uuid4().hex[:8]}"
    df.write.partitionBy(*partition_by).parquet(f"{root}/{name}")
    kept = [name, *_pointed(spark, root)][:keep]
    replace_text(spark, f"{root}/{_POINTER}", "\n".join(kept))
    fs, _ = hadoop_path(spark, root)
    for old in found:
        if _number(old) < min(map(_number, kept)):
            fs.delete(hadoop_path(spark, f"{root}/{old}")[1], True)
    return read_snapshot(spark, root)


def next_number(spark: SparkSession, path: str) -> int:
    """The number of the content that would be written next."""
    found = _versions(spark, path.rstrip("/"))
    return _number(found[-1]) + 1 if found else 1


def snapshot_number(spark: SparkSession, path: str) -> int:
    """The number of the current content; 0 where there is none."""
    names = _pointed(spark, path.rstrip("/"))
    return _number(names[0]) if names else 0


def _number(name: str) -> int:
    return int(name.split("-")[1])


def _versions(spark: SparkSession, root: str) -> list[str]:
    """Folders of contents, also of those that were cut off, in the order they were begun."""
    fs, p = hadoop_path(spark, root)
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(n for n in names if n.startswith(_VERSION))


def _pointed(spark: SparkSession, root: str) -> list[str]:
    """The contents that stood, the current one first."""
    return (read_text(spark, f"{root}/{_POINTER}") or "").split()


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The current content of a table written by `replace_snapshot`; a frame read before a
    replacement keeps reading what it resolved."""
    root = path.rstrip("/")
    names = _pointed(spark, root)
    if not names:
        raise FileNotFoundError(f"{root} has no current content")
    return spark.read.parquet(f"{root}/{names[0]}")


def write_batch(df: DataFrame, batch: str, path: str, name: str = "_batch_id") -> None:
    """Land a batch in its own partition; a replay of the batch replaces it."""
    (
        df.withColumn(name, F.lit(str(batch)))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(name)
        .parquet(path)
    )


def spread_hot_keys(df: DataFrame, key: str, n_parts: int, name: str = "_spread") -> DataFrame:
    """A second sort column that is 0 except for keys too big for one of `n_parts` equal parts.

    Those keys (at most `n_parts` of them) get a row hash, so they fill several parts while all
    other keys stay whole. The counting pass reads the key column only.
    """
    counts = materialize(df.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_n")), "key_counts")
    total = counts.agg(F.sum("_n")).first()[0] or 0
    hot = [r["_k"] for r in counts.filter(F.col("_n") * n_parts > total).collect()]
    held = [k for k in hot if k is not None]
    is_hot = F.col(key).isin(held) if held else F.lit(False)
    if len(held) < len(hot):
        is_hot = is_hot | F.col(key).isNull()
    return df.withColumn(name, F.when(is_hot, F.xxhash64(*df.columns)).otherwise(F.lit(0)).cast("bigint"))


def write_sorted(df: DataFrame, keys: Sequence[str], n_files: int, path: str) -> None:
    """Files that cover disjoint ranges of the first key, so range filters skip most of them.

    Files end where the key changes unless one key outgrows a file; further keys only order rows
    inside a file.
    """
    spread = spread_hot_keys(df, keys[0], n_files)
    ranged = spread.repartitionByRange(n_files, keys[0], "_spread")
    ranged.sortWithinPartitions(*keys).drop("_spread").write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """With doubled quotes, as the CSV readers expect; texts with line breaks need their `multi_line`."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_ndjson(df: DataFrame, path: str, compression: str | None = None) -> None:
    """A compressed file is read by one task: for outputs of many files."""
    df.write.mode("overwrite").json(path, compression=compression)


def log_transfer(spark: SparkSession, path: str, rows: DataFrame, entry: str) -> bool:
    """Add transfer-log rows as the entry's own partition, with a `log_id` that follows from its name.

    Writers share no folder while they write: each stages in one of its own and moves one partition in,
    so any number of them may log at once, and an entry logged again replaces itself. A failing log
    never fails the load; what is returned is whether the entry stands in the table.
    """
    try:
        write_batch(rows.withColumn("log_id", F.xxhash64(F.lit(entry)).bitwiseAND((1 << 63) - 1)), entry, path, "_entry")
        return not spark.read.parquet(path).filter(F.col("_entry") == entry).isEmpty()
    except Exception as exc:  # noqa: BLE001 - best effort by design
        spark.sparkContext._jvm.org.slf4j.LoggerFactory.getLogger("millrace").warn(f"transfer log: {exc}")
        return False


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def write_buckets(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    """A table partitioned by key hash, the unit that merges rewrite."""
    with_bucket = df.withColumn("_bucket", bucket_of(keys, buckets))
    # rebalance gathers a bucket into few files, yet splits one that is far larger than the rest
    with_bucket.hint("rebalance", "_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(path)
    _keep_count(df.sparkSession, path, buckets)


def _count_file(path: str) -> str:
    return f"{path.rstrip('/')}/_bucket_count"


def bucket_count(spark: SparkSession, path: str) -> int | None:
    """The number of buckets a table was written with; None where nothing was kept."""
    text = read_text(spark, _count_file(path))
    return None if text is None else int(text)


def _keep_count(spark: SparkSession, path: str, buckets: int) -> None:
    replace_text(spark, _count_file(path), str(buckets))


def rebucket(spark: SparkSession, path: str, keys: Sequence[str], buckets: int) -> None:
    """Write a bucketed table anew with another number of buckets."""
    _recover(spark, path)
    fresh = path.rstrip("/") + "__rebucket"
    write_buckets(spark.read.parquet(path).drop("_bucket"), fresh, keys, buckets)
    _swap(spark, fresh, path)


def _pending(path: str, batch: str) -> str:
    return f"{path.rstrip('/')}__pending/{batch}"


def pending_exists(spark: SparkSession, path: str, batch: str) -> bool:
    """Whether a batch's merge was cut off after its new content was complete."""
    return path_exists(spark, _pending(path, batch) + "/_SUCCESS")


def merge_buckets(
    spark: SparkSession,
    path: str,
    delta: DataFrame,
    keys: Sequence[str],
    buckets: int,
    merge: Callable[[DataFrame, DataFrame], DataFrame],
    batch: str,
    schema: str | None = None,
) -> None:
    """Rewrite only the key-hash buckets a delta touches.

    `merge(slice, delta)` gives the new content of the touched buckets. It is written beside the
    table first; if the driver dies during the swap, the same batch finishes from that copy. The number
    of buckets is kept with the table, as another one would put a key in a second place.
    """
    kept = bucket_count(spark, path)
    if kept is None:
        _keep_count(spark, path, buckets)
    elif kept != buckets:
        raise ValueError(f"{path} has {kept} buckets, not {buckets}; use rebucket to change that")
    pending = _pending(path, batch)
    if not pending_exists(spark, path, batch):
        delta = delta.withColumn("_bucket", bucket_of(keys, buckets))
        # at most `buckets` numbers
        touched = [r[0] for r in delta.select("_bucket").distinct().collect()]
        if not touched:
            return
        # a given schema lets the table start out empty
        reader = spark.read if schema is None else spark.read.schema(schema)
        held = reader.parquet(path).filter(F.col("_bucket").isin(touched))
        merged = merge(held.drop("_bucket"), delta.drop("_bucket"))
        write_buckets(merged, pending, keys, buckets)
    (
        (spark.read if schema is None else spark.read.schema(schema)).parquet(pending)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("_bucket")
        .parquet(path)
    )
    fs, p = hadoop_path(spark, pending)
    fs.delete(p, True)
    spark.catalog.refreshByPath(path)

"""Session settings and the shared folder that intermediate tables are written to."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import Any

from py4j.java_gateway import is_instance_of
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key even where the split costs one more shuffle further on
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # a Python worker holds a batch several times over: its rows, what it makes of them, and both on the wire
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}


def configure(spark: SparkSession) -> SparkSession:
    """Turn on the adaptive settings the operators count on; sizes stay the user's. The number that file
    splits are cut for is held, as it would else follow executors that come and go between two passes."""
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    for key, value in _SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's checkpoint directory.

    Only a local master with no such setting gets a temporary folder; on a cluster a missing
    setting is an error, because a machine-local folder would lose data with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder, grouped by application for later cleaning."""
    return f"{_scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


_SCOPE = "millrace.scratch.scope"


def _scratch_root(spark: SparkSession) -> str:
    context = spark.sparkContext
    scope = context.getLocalProperty(_SCOPE)
    return f"{shared_dir(spark)}/millrace/{context.applicationId}" + (f"/{scope}" if scope else "")


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove at the end what was materialized inside, also by `in_parallel` threads. For steps whose
    results are written out before they end, such as a micro-batch or a load."""
    context = spark.sparkContext
    before = context.getLocalProperty(_SCOPE)
    context.setLocalProperty(_SCOPE, f"{before}/{uuid.uuid4().hex[:12]}" if before else f"step-{uuid.uuid4().hex[:12]}")
    root = _scratch_root(spark)
    try:
        yield
    finally:
        context.setLocalProperty(_SCOPE, before)
        fs, p = hadoop_path(spark, root)
        fs.delete(p, True)


def clean_scratch(spark: SparkSession) -> None:
    """Remove this application's intermediate tables; call it when its DataFrames are done with."""
    fs, p = hadoop_path(spark, f"{shared_dir(spark)}/millrace/{spark.sparkContext.applicationId}")
    fs.delete(p, True)


def materialize(df: DataFrame, label: str, partition_by: list[str] | None = None, codec: str | None = None) -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage and fixes row order.

    Used where a second pass must see exactly the rows of the first one (prefix sums, ids). A `codec` other
    than the session's is for tables so large that their bytes count.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if codec:
        writer = writer.option("compression", codec)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_or_not(df: DataFrame, label: str, rows: int = 500_000) -> DataFrame:
    """A side to broadcast if it is small: written, counted, and hinted only up to `rows` rows.

    Without the hint the join is planned as usual, so a side that outgrows the bound still works.
    """
    stored = materialize(df, label)
    return F.broadcast(stored) if stored.count() <= rows else stored


def in_parallel(spark: SparkSession, *jobs: Callable[[], Any]) -> list[Any]:
    """Run independent driver steps at once, so small jobs share the executors."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        waiting = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
        return [w.result() for w in waiting]


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path object) for any URI Spark can write to."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_path(spark, path)
    return fs.exists(p)


def read_text(spark: SparkSession, path: str) -> str | None:
    """Content of a small file; None where there is none."""
    fs, p = hadoop_path(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file beside the old one and swap it in by one rename: readers see the old or the new."""
    fs, final = hadoop_path(spark, path)
    _, fresh = hadoop_path(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    checked = is_instance_of(gateway, fs, "org.apache.hadoop.fs.ChecksumFileSystem")
    # a checksum beside the file would be swapped in a step of its own
    plain = fs.getRawFileSystem() if checked else fs
    plain.mkdirs(final.getParent())
    stream = plain.create(fresh, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    if checked:
        plain.delete(fs.getChecksumFile(final), False)
        if not plain.rename(fresh, final):
            raise OSError(f"could not replace {path}")
        return
    over = gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    over[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(fresh), fs.makeQualified(final), over)


def local_uri(path: str) -> str:
    """Absolute form of a plain local path; URIs pass through."""
    return path if "://" in path or path.startswith("file:") else os.path.abspath(path)


def ship_package(spark: SparkSession, *packages: str) -> None:
    """Give the Python workers these packages' code (no data); only for operators that run Python."""
    shipped = spark.sparkContext.__dict__.setdefault("_millrace_shipped", set())
    if packages in shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="millrace-"), f"{'_'.join(packages)}_code.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for package in packages:
            for folder, _, names in os.walk(os.path.join(root, package)):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        archive.write(full, os.path.relpath(full, root))
    spark.sparkContext.addPyFile(target)
    shipped.add(packages)

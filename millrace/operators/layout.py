"""How well a table's files serve range filters: files to scan, overlap depth, comparison."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import draw
from ..session import scratch_path
from .joins import rank_lookup
from .positions import running_total, with_rank
from .tables import write_sorted


def file_ranges(spark: SparkSession, path: str, key: str) -> DataFrame:
    """Smallest and largest key of every file; reads the key column only."""
    return spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(key).alias("low"), F.max(key).alias("high"), F.count(F.lit(1)).alias("n_rows")
    )


def files_scanned(ranges: DataFrame, low, high) -> DataFrame:
    """Files whose key range meets the filter, and all files."""
    return ranges.agg(
        F.count_if((F.col("high") >= F.lit(low)) & (F.col("low") <= F.lit(high))).alias("scanned"),
        F.count(F.lit(1)).alias("total"),
    )


def clustering_depth(ranges: DataFrame) -> DataFrame:
    """Average number of files (itself included) a file's key range overlaps.

    A range overlaps those that start no later than its end, less those that end before its start;
    both counts are running totals over the sorted ends, so no pair of files is formed.
    """
    points = ranges.select(F.col("low").alias("at"), F.lit(1).alias("starts"), F.lit(0).alias("ends")).unionByName(
        ranges.select(F.col("high").alias("at"), F.lit(0).alias("starts"), F.lit(1).alias("ends"))
    )
    at = points.filter(F.col("at").isNotNull()).groupBy("at").agg(
        F.sum("starts").alias("starts"), F.sum("ends").alias("ends")
    )
    totals = running_total(at, ["at"], {"started": F.col("starts"), "ended": F.col("ends")})
    # sum over files: by end, what has started; by start, what ended strictly before
    return totals.agg(
        (
            (F.sum(F.col("ends") * F.col("started")) - F.sum(F.col("starts") * (F.col("ended") - F.col("ends"))))
            / F.sum("starts")
        ).alias("avg_depth"),
        F.sum("starts").alias("n_files"),
    )


def fan_out(fact: DataFrame, dim_date: DataFrame, n: int, seed: int, pad: int = 0) -> DataFrame:
    """Every fact row `n` times, each copy moved to a drawn date of the calendar.

    The copies are an exploded sequence rather than a cross join; `pad` adds incompressible text.
    """
    days = dim_date.count()
    ranked = with_rank(dim_date.select("date_key"), ["date_key"], "rn")
    copies = fact.drop("date_key").withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    drawn = copies.withColumn("rk", draw(F.col("n"), 1, seed, days) + 1)
    out = rank_lookup(drawn, ranked, "rk", "rn").withColumn(
        "encounter_id", F.concat("encounter_id", F.lit("-"), F.col("n").cast("string"))
    ).drop("n")
    return out.withColumn("pad", F.randstr(F.lit(pad), F.lit(seed))) if pad else out


def layout_report(df: DataFrame, key: str, n_files: int, low, high, path: str | None = None) -> DataFrame:
    """Random against sorted layout of the same rows: files scanned, files, average depth."""
    spark = df.sparkSession
    root = path or scratch_path(spark, "layout")
    # spread by a hash of the row: a key-free order, repeatable, and even for hot keys
    (
        df.repartition(n_files, F.xxhash64(*df.columns))
        .write.mode("overwrite").parquet(f"{root}/random")
    )
    # the sorted copy is made from the first one, so costly inputs are computed once
    write_sorted(spark.read.schema(df.schema).parquet(f"{root}/random"), [key], n_files, f"{root}/sorted")
    parts = []
    for name in ("random", "sorted"):
        ranges = file_ranges(spark, f"{root}/{name}", key)
        scanned = files_scanned(ranges, low, high)
        parts += [
            scanned.select(F.lit(name).alias("layout"), "scanned", "total"),
            clustering_depth(ranges).select(F.lit(name).alias("layout"), "avg_depth"),
        ]
    report = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return report.groupBy("layout").agg(*[F.max(c).alias(c) for c in ("scanned", "total", "avg_depth")])

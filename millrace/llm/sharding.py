"""Extendible hashing: shards are hash prefixes, and only buckets over the byte limit take another bit.

The directory is a trie over hash bits. Bytes are first added up per fine prefix (a shuffle of
counts, not of rows); a shard is the shortest prefix whose bytes fit while its parent's do not.
Prefixes still too large at that depth go through another round over their rows alone. Rows that no
bit can part (one key repeated) are paged by running sums, which are distributed prefix sums, so a
key may hold any share of the rows. Built-in functions only.

Defined results: null size counts 0, null key hashes as the empty text; a row over the limit is a
shard of its own (page below 0, numbered); an empty table has no shards;
columns named like the added ones are replaced. Every shard but such a row keeps the limit.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.positions import running_total
from ..session import materialize, small_or_not

BITS = 60
MARGIN = 4
TIE = ["_h", "_tie", "_copy"]


def hash_bits(key: Column) -> Column:
    """The first 60 bits of md5 over the key's text."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, BITS // 4), 16, 10).cast("bigint")


def _shift(value: str, bits: Column) -> Column:
    return F.call_function("shiftrightunsigned", F.col(value), bits.cast("int"))


def _prefix(depth: int) -> Column:
    return F.shiftrightunsigned("_h", BITS - depth)


def _bits(value: Column, depth: Column) -> Column:
    """`depth` bits of `value` as text; the root is the empty text."""
    return F.when(depth == 0, F.lit("")).otherwise(F.lpad(F.bin(value), depth, "0"))


def assign(df: DataFrame, key: str, size: Column, limit: int) -> DataFrame:
    """`df` with `shard` (prefix bits), `depth`, `page`, `row_bytes`, `shard_bytes`.

    A shard is (`shard`, `page`); page 0 is a bucket of the directory.
    """
    hashed = df.select(
        F.struct("*").alias("_row"), hash_bits(F.col(key)).alias("_h"), F.coalesce(size, F.lit(0)).cast("bigint").alias("_b")
    )
    # the directory is made from hashes and sizes; whole rows are read once, to be dealt out
    sizes = materialize(hashed.select("_h", "_b"), "sizes")
    fits = F.col("_b") <= limit
    total, n_alone = sizes.agg(F.sum(F.when(fits, F.col("_b"))), F.count_if(~fits)).first()
    depth = min(BITS, max(0, math.ceil(math.log2(max(1, (total or 0) / limit)))) + MARGIN)

    base, dealt, found_at = 0, hashed, []
    left = sizes.filter(fits)
    while True:
        cells = materialize(left.groupBy(_prefix(depth).alias("_p")).agg(F.sum("_b").alias("_s")), "cells")
        levels = _levels(cells, base, depth)
        n = len(found_at)
        found = small_or_not(_leaves(levels, base, depth, limit), "directory").select(F.col("_p").alias(f"_p{n}"), F.struct("_d", "_t").alias(f"_leaf{n}"))
        dealt = dealt.join(found, _prefix(depth) == F.col(f"_p{n}"), "left").drop(f"_p{n}")
        found_at.append(f"_leaf{n}")
        over = levels.filter((F.col("_d") == depth) & (F.col("_t") > limit)).select(F.col("_q").alias("_p"))
        over = materialize(over, "oversized")
        paged = not over.isEmpty()
        if not paged or depth == BITS:
            break
        left = left.withColumn("_p", _prefix(depth)).join(over, "_p", "left_semi").drop("_p")
        base, depth = depth, min(BITS, depth + 2 * MARGIN)

    leaf = F.coalesce(*found_at)
    dealt = dealt.select("_row", "_h", "_b", leaf.alias("_leaf"))
    d = F.col("_leaf._d")
    whole = dealt.filter(fits & F.col("_leaf").isNotNull()).select(
        "_row", _bits(_shift("_h", F.lit(BITS) - d), d).alias("shard"), d.alias("depth"), F.lit(0).cast("bigint").alias("page"),
        F.col("_b").alias("row_bytes"), F.col("_leaf._t").alias("shard_bytes"),
    )
    if n_alone:
        # numbered over all of them, so that two of one key are two shards
        apart = running_total(_tied(hashed.filter(~fits)), TIE, {"_nth": F.lit(1)})
        whole = whole.unionByName(apart.select("_row", _bits(F.col("_h"), F.lit(BITS)).alias("shard"), F.lit(BITS).alias("depth"), (-F.col("_nth")).cast("bigint").alias("page"), F.col("_b").alias("row_bytes"), F.col("_b").alias("shard_bytes")))
    if paged:
        whole = whole.unionByName(_pages(dealt.filter(fits & F.col("_leaf").isNull()).drop("_leaf"), limit))
    added = ("shard", "depth", "page", "row_bytes", "shard_bytes")
    return whole.select(*[F.col("_row")[c].alias(c) for c in df.columns if c.lower() not in added], *added)


def _tied(rows: DataFrame) -> DataFrame:
    """Rows with the columns of `TIE`, by which ranges part also equal rows of one key. They are written
    first, so that a row keeps its number when a task is repeated."""
    return materialize(rows, "tied").withColumn("_tie", F.xxhash64(F.to_json("_row"))).withColumn("_copy", F.monotonically_increasing_id())


def _levels(cells: DataFrame, base: int, depth: int) -> DataFrame:
    """Bytes of every prefix `_q` of length `_d` from `base` to `depth`."""
    steps = cells.select("_p", "_s", F.explode(F.sequence(F.lit(base), F.lit(depth))).alias("_d"))
    at = _shift("_p", F.lit(depth) - F.col("_d"))
    return materialize(steps.groupBy("_d", at.alias("_q")).agg(F.sum("_s").alias("_t")), "levels")


def _leaves(levels: DataFrame, base: int, depth: int, limit: int) -> DataFrame:
    """Per fine prefix `_p` below a shard the depth `_d` and bytes `_t` of that shard: the prefixes that fit while
    the one above does not."""
    split = levels.filter((F.col("_t") > limit) & (F.col("_d") < depth)).select(
        (F.col("_d") + 1).alias("_d"), F.explode(F.array(2 * F.col("_q"), 2 * F.col("_q") + 1)).alias("_q"), F.lit(None).cast("bigint").alias("_t"), F.lit(True).alias("_up")
    )
    known = levels.select("_d", "_q", "_t", (F.col("_d") == base).alias("_up")).unionByName(split)
    leaves = known.groupBy("_d", "_q").agg(F.max("_t").alias("_t"), F.max("_up").alias("_up")).filter((F.col("_t") <= limit) & F.col("_up"))
    width = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.lit(depth) - F.col("_d"))
    return leaves.select(F.explode(F.sequence(F.col("_q") * width, (F.col("_q") + 1) * width - 1)).alias("_p"), "_d", "_t")


def _pages(rows: DataFrame, limit: int) -> DataFrame:
    """Rows of one hash in pages: large rows alone, the others by running sums over half the limit."""
    half = limit // 2
    tied = _tied(rows)
    small = running_total(tied.filter(F.col("_b") <= half), TIE, {"_upto": F.col("_b")})
    # a page starts at multiples of half the limit and its last row adds at most another half
    paged = small.withColumn("_page", 2 * F.floor((F.col("_upto") - F.col("_b")) / F.lit(max(1, half))) + 2)
    big = running_total(tied.filter(F.col("_b") > half), TIE, {"_upto": F.lit(1)}).withColumn("_page", 2 * F.col("_upto") + 1)
    both = materialize(paged.unionByName(big), "pages")
    sums = both.groupBy("_h", "_page").agg(F.sum("_b").alias("_t"))
    return both.join(sums, ["_h", "_page"]).select(
        "_row", _bits(F.col("_h"), F.lit(BITS)).alias("shard"), F.lit(BITS).alias("depth"), F.col("_page").cast("bigint").alias("page"),
        F.col("_b").alias("row_bytes"), F.col("_t").alias("shard_bytes"),
    )


def write_shards(assigned: DataFrame, path: str) -> None:
    """One folder per shard; a shard fits its limit, so one task writes it."""
    assigned.repartition("shard", "page").write.mode("overwrite").partitionBy("shard", "page").parquet(path)


def read_shards(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of all shards below `path`; `schema` is that of what was written."""
    stored = spark.read.schema(schema).parquet(path)
    # the root's empty name is no folder name
    return stored.select(*[F.coalesce("shard", F.lit("")).alias("shard") if c == "shard" else c for c in schema.names])

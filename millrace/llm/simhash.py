"""SimHash near-duplicates by deletion-variant signatures.

A 64-bit fingerprint is cut into two segments of 32 bits. Of two fingerprints that differ in at
most three bits one segment differs in at most one, so they either share a whole segment or a
segment with the same one bit wildcarded. Fingerprints (distinct ones, with their smallest id) are
indexed under the 2 whole segments and 64 one-wildcard variants; an equality join proposes pairs and
the bit count of their difference verifies them. A variant's bucket only pairs fingerprints that
differ in its bit, so a pair of equal segments is proposed once and not 32 times. Buckets are counted
before any row is gathered in them, so a segment that a third of all fingerprints share is a number.

Buckets in which that would be too many pairs (all members but `few` on both sides) are linked
without pairs and without loss: members also emit the values of the other segment that lie within
one or two bits of theirs, and all that meet at such a value are linked to one hub of them that is
near enough (1 + 2 bits for whole segments, 1 + 1 beside the wildcard). This is linear in the bucket.

Components come from `components`. Defined results: null or wordless text has fingerprint zero; a
component is named by its smallest doc_id, null only if it has none; equal rows are all kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize, ship_package, small_or_not
from .components import connected

SHINGLE = 3
BITS = 3
FEW = 64
HALF = 0xFFFFFFFF
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BLOCK = 1 << 22


def _blocks(data: bytes, width: int) -> Iterator[list[bytes]]:
    """Words in runs of about 4 MB that overlap by `width` - 1 words."""
    at, carried = 0, []
    while at < len(data):
        end = at + _BLOCK
        if end < len(data):
            space = re.compile(rb"[\x20\x09-\x0D]").search(data, end)
            end = space.start() if space else len(data)
        words = carried + data[at:end].split()
        at = end
        if at < len(data) and len(words) < width:
            carried = words
            continue
        yield words
        carried = words[-(width - 1):] if width > 1 else []


def hashes(text: str | None, width: int, seed: int = 42) -> Iterator[list[int]]:
    """XXH64 of all shingles, in runs; a text of fewer words is one shingle."""
    total = 0
    digest = xxhash.xxh64_intdigest
    for words in _blocks((text or "").encode().translate(_LOWER), width):
        joined = b" ".join(words)
        if len(words) <= width:
            found = [digest(joined, seed)] if words and (len(words) == width or not total) else []
        else:
            lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
            ends = np.cumsum(lengths + 1) - 1
            found = [digest(joined[i:j], seed) for i, j in zip((ends - lengths).tolist(), ends[width - 1:].tolist(), strict=False)]
        total += len(found)
        yield found


def fingerprint(text: str | None, width: int = SHINGLE, seed: int = 42) -> int:
    """Majority of the bits of all shingles' XXH64, unsigned."""
    return majority(hashes(text, width, seed))


def majority(runs: Iterable[list[int] | np.ndarray]) -> int:
    """The bits that are set in over half of all values."""
    ones, total = np.zeros(64, dtype=np.int64), 0
    for found in runs:
        for i in range(0, len(found), 1 << 16):
            part = np.array(found[i:i + (1 << 16)], dtype="<u8")
            ones += np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
            total += len(part)
    if not total:
        return 0
    return int(np.packbits(ones * 2 > total, bitorder="little").view("<u8")[0])


def fingerprints(text: Column, width: int = SHINGLE) -> Column:
    """`fingerprint` as a signed 64-bit column."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py(), width) for t in batch), dtype=np.uint64, count=len(batch))
            yield pa.array(found.view(np.int64))

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "bigint")(text)


def hexadecimal(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def _variants(prints: DataFrame) -> DataFrame:
    """(`fp`, `place`, `value`, `bit`, `other`): whole segments at places 32 and 65, bit i wildcarded at i and 33 + i."""

    def segment(s: int) -> Column:
        value = F.shiftrightunsigned("fp", 32 * s).bitwiseAND(HALF)
        other = F.shiftrightunsigned("fp", 32 * (1 - s)).bitwiseAND(HALF)
        wild = F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: F.struct(
            (F.lit(33 * s) + i).cast("int").alias("place"),
            value.bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(1).cast("bigint"), i))).alias("value"),
            F.call_function("shiftrightunsigned", value, i).bitwiseAND(1).cast("int").alias("bit"),
        ))
        whole = F.array(F.struct(F.lit(33 * s + 32).alias("place"), value.alias("value"), F.lit(0).alias("bit")))
        return F.transform(F.concat(wild, whole), lambda x: F.struct(x["place"].alias("place"), x["value"].alias("value"), x["bit"].alias("bit"), other.alias("other")))

    both = F.concat(segment(0), segment(1))
    return prints.select("fp", F.explode(both).alias("x")).select("fp", "x.place", "x.value", "x.bit", "x.other")


def _near(value: Column, bits: int) -> Column:
    """(`at`, `far`) of all 32-bit values within one bit (far 0), or two (far 1), of `value`."""
    flips = [0] + [1 << i for i in range(32)]
    near = [(f, 0) for f in flips]
    if bits == 2:
        near += [((1 << i) | (1 << j), 1) for i in range(32) for j in range(i)]
    masks = F.array(*[F.lit(f).cast("bigint") for f, _ in near])
    return F.transform(masks, lambda m, i: F.struct(value.bitwiseXOR(m).alias("at"), (i > 32).cast("int").alias("far")))


def links(prints: DataFrame, few: int = FEW) -> DataFrame:
    """(`a`, `b`): fingerprints of distinct `fp` that differ in at most three bits; enough of these
    links to join all that are joined by any."""
    found = _variants(prints)
    counts = found.groupBy("place", "value").agg(F.count(F.lit(1)).alias("_n"), F.sum("bit").alias("_ones"))
    whole = F.col("place").isin(32, 65)
    # a whole-segment bucket pairs all its members, a variant's those of bit 0 with those of bit 1
    less = F.when(whole, F.col("_n")).otherwise(F.least("_ones", F.col("_n") - F.col("_ones")))
    shared = counts.filter((F.col("_n") > 1) & (less > 0)).select("place", "value", less.alias("_less"))
    kept = materialize(found.join(small_or_not(shared, "buckets"), ["place", "value"]), "variants")

    small = kept.filter(F.col("_less") <= few)
    left = small.select("place", "value", F.col("fp").alias("a"), F.col("bit").alias("_x"))
    right = small.select("place", "value", F.col("fp").alias("b"), F.col("bit").alias("_y"))
    ordered = F.when(whole, F.col("a") < F.col("b")).otherwise(F.col("_x") < F.col("_y"))
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= BITS
    pairs = left.join(right, ["place", "value"]).filter(ordered & close).select("a", "b")

    dense = kept.filter(F.col("_less") > few)
    near = F.when(whole, _near(F.col("other"), 2)).otherwise(_near(F.col("other"), 1))
    meet = dense.select("fp", "place", "value", F.explode(near).alias("m")).select("fp", "place", "value", "m.at", "m.far")
    # at most 529 values lie within two bits of one
    hub = F.min(F.when(F.col("far") == 0, F.col("fp"))).over(W.partitionBy("place", "value", "at"))
    stars = meet.select(F.col("fp").alias("a"), hub.alias("b")).filter(F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    return pairs.unionByName(stars.distinct())


def components(printed: DataFrame, few: int = FEW) -> DataFrame:
    """(`fp`, `component_id`) from (`doc_id`, `fp`)."""
    prints = materialize(printed.groupBy("fp").agg(F.min("doc_id").alias("_first")), "prints")
    return named_components(prints, links(prints.select("fp"), few))


def named_components(prints: DataFrame, linked: DataFrame) -> DataFrame:
    """(`fp`, `component_id`) from (`fp`, `_first`: its least doc_id) and links (`a`, `b`)."""
    roots = materialize(connected(linked, "a", "b"), "roots")
    named = roots.join(prints, roots["node"] == prints["fp"]).select("fp", "root", "_first")
    least = named.groupBy("root").agg(F.min("_first").alias("_least"))
    joined = named.join(least, "root").select("fp", "_least")
    return materialize(prints.join(joined, "fp", "left").select("fp", F.coalesce("_least", "_first").alias("component_id")), "components")


def near_duplicates(docs: DataFrame, few: int = FEW) -> DataFrame:
    """`doc_id`, `fingerprint` (hexadecimal), `component_id` per row of (`doc_id`, `text`)."""
    ship_package(docs.sparkSession, "millrace")
    printed = materialize(docs.select("doc_id", fingerprints(F.col("text")).alias("fp")), "fingerprints")
    found = components(printed, few)
    return printed.join(found, "fp").select("doc_id", hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, few: int = FEW) -> DataFrame:
    """`docs` with one row per component: that of the smallest doc_id, of its rows the least text."""
    ship_package(docs.sparkSession, "millrace")
    rows = docs.select(F.struct("*").alias("_row"), fingerprints(F.col("text")).alias("fp"))
    rows = materialize(rows, "printed")
    return least_rows(rows, components(rows.select("_row.doc_id", "fp"), few))


def least_rows(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Of (`_row`, `fp`) and (`fp`, `component_id`) the row that stands for each component."""
    first = rows.join(found, "fp").filter(F.col("_row.doc_id").eqNullSafe(F.col("component_id")))
    # only repeats of one id are left to choose from; those without any id are told apart by fingerprint
    own = W.partitionBy("component_id", F.when(F.col("component_id").isNull(), F.col("fp"))).orderBy(F.xxhash64("_row.text"), F.to_json("_row"))
    return first.withColumn("_n", F.row_number().over(own)).filter("_n = 1").select("_row.*")

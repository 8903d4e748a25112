"""Mixing sources to target weights by Efraimidis-Spirakis keys.

Targets are weights of a common budget, capped at a number of epochs of the source, the excess
shared again by weight. A source's whole epochs come first; the rest of its target is a weighted
sample without replacement: documents in order of the key -ln(u) / quality, taken until the running
sum of sizes reaches what is left (the document at the edge counts if that comes nearer).

A sorted source is cut into key ranges. Their sums (pre-aggregated before the shuffle) give the
running sum before each range, so only the one range that holds the edge needs its rows in order:
a source may hold any share of all rows, and no rows move but those of that range. They are ordered by
distributed prefix sums, so that range may hold most of a source (it does where weights are small).

u is a hash of the id and a seed: reruns and retried tasks agree. Defined results: null text has
size 0 and takes nothing; a null source is a source, last in order; repeated rows count as rows of
their own; an empty table gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.positions import running_total, with_rank
from ..session import materialize

RANGES = 4096
SPACE = r"\x20\x09-\x0D"
# marks that markup, tables and noise are made of
SYMBOLS = "#$%&*!|<>{}=^~"


def word_count(text: Column) -> Column:
    """Words without building them: each becomes one letter, white space goes."""
    marked = F.regexp_replace(text, rf"[^{SPACE}]++", "w")
    return F.length(F.translate(F.coalesce(marked, F.lit("")), " \t\n\x0b\x0c\r", "")).cast("bigint")


def quality_weight(text: Column) -> Column:
    """1 for prose, less by ten times the share of symbols, at least 0.05."""
    n = F.greatest(F.length(F.coalesce(text, F.lit(""))), F.lit(1))
    symbols = n - F.length(F.translate(F.coalesce(text, F.lit("")), SYMBOLS, ""))
    return F.greatest(F.lit(0.05), F.lit(1.0) - F.lit(10.0) * F.greatest(symbols, F.lit(0)) / n)


def exponential_key(doc_id: Column, weight: Column, seed: str) -> Column:
    """-ln(u) / weight with u in (0, 1) from 52 bits of md5."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    bits = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double")
    return -F.log((bits + 0.5) / F.lit(float(1 << 52))) / weight


def targets(sources: DataFrame, weights: Sequence[int], share: float, epochs: int) -> DataFrame:
    """`target` per row of (`source`, `source_size`): weights repeat in source order, nulls last.

    The common rate solves sum(min(cap, rate x weight)) = share x all sizes. Each step is one
    aggregate over one row per source; a source once capped stays so.
    """
    ordered = with_rank(sources.withColumn("_null", F.col("source").isNull()), ["_null", "source"], "_place").drop("_null")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("_place") - 1) % len(weights) + 1).cast("int"))
    known = materialize(ordered.withColumn("_weight", weight).withColumn("_cap", F.lit(epochs) * F.col("source_size")), "sources")
    rate = 0.0
    budget, free = known.agg(F.sum("source_size") * F.lit(share), F.sum("_weight")).first()
    closed = 0.0
    while budget and free:
        rate = (budget - closed) / free
        above = F.col("_cap") < F.lit(rate) * F.col("_weight")
        now, left = known.agg(
            F.coalesce(F.sum(F.when(above, F.col("_cap"))), F.lit(0)).cast("double"), F.coalesce(F.sum(F.when(~above, F.col("_weight"))), F.lit(0))
        ).first()
        if now == closed and left == free:
            break
        closed, free = now, left
    target = F.least(F.col("_cap").cast("double"), F.lit(float(rate)) * F.col("_weight"))
    return known.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, epochs: int = 2, seed: str = "mix",
    quality: Column | None = None, tie: Column | None = None,
) -> DataFrame:
    """`doc_id`, `source`, `size`, `source_size`, `target`, `epochs` (whole ones), `times`, `taken` per row of (`doc_id`, `text`, `source`)."""
    weight = quality_weight(F.col("text")) if quality is None else quality
    key = exponential_key(F.col("doc_id"), weight, seed)
    order = F.xxhash64("text") if tie is None else tie
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), key.alias("_key"), order.alias("_tie"))
    rows = materialize(rows.withColumn("_range", F.floor((1 - F.exp(-F.col("_key"))) * RANGES).cast("int")), "sizes")

    sums = materialize(rows.groupBy("source", "_range").agg(F.sum("size").alias("_sum")), "range_sums")
    goals = targets(sums.groupBy("source").agg(F.sum("_sum").alias("source_size")), weights, share, epochs)
    # at most RANGES rows of a source
    upto = W.partitionBy("source").orderBy("_range").rowsBetween(W.unboundedPreceding, W.currentRow)
    running = sums.withColumn("_upto", F.sum("_sum").over(upto))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("bigint")
    goals = goals.withColumn("epochs", whole).withColumn("_rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    same = running["source"].eqNullSafe(goals["source"])
    edge = goals.join(running, same, "left").groupBy(goals["source"], "source_size", "target", "epochs", "_rest").agg(
        F.min(F.when(F.col("_upto") > F.col("_rest"), F.struct("_range", (F.col("_upto") - F.col("_sum")).alias("_before")))).alias("_edge")
    )
    edge = materialize(edge.select(F.col("source").alias("_source"), "source_size", "target", "epochs", "_rest", "_edge._range", "_edge._before").withColumnRenamed("_range", "_at"), "edges")

    joined = rows.join(edge, rows["source"].eqNullSafe(edge["_source"])).drop("_source")
    outside = joined.filter(~F.col("_range").eqNullSafe(F.col("_at")))
    chosen = F.coalesce(F.col("_range") < F.col("_at"), F.col("_rest") > 0)
    inside = joined.filter(F.col("_range") == F.col("_at")).drop("_range", "_at")
    # one order through the edge ranges of all sources; each source's part starts at its least sum
    ordered = materialize(running_total(inside, ["source", "_key", "doc_id", "_tie", "size"], {"_upto": F.col("size")}), "edge_rows")
    starts = ordered.groupBy(F.col("source").alias("_source")).agg(F.min(F.col("_upto") - F.col("size")).alias("_start"))
    placed = ordered.join(starts, ordered["source"].eqNullSafe(starts["_source"]))
    sofar = F.col("_before") + F.col("_upto") - F.col("size") - F.col("_start")
    nearer = 2 * sofar + F.col("size") <= 2 * F.col("_rest")
    given = ["doc_id", "source", "size", "_key", "_tie", "source_size", "target", "epochs"]
    both = outside.select(*given, chosen.alias("_in")).unionByName(placed.select(*given, nearer.alias("_in")))
    times = (F.col("epochs") + F.col("_in").cast("bigint")).cast("bigint")
    return both.select(
        "doc_id", "source", "size", "source_size", "target", "epochs", times.alias("times"), (times * F.col("size")).alias("taken"),
        F.when(F.col("_in"), F.struct("_key", "doc_id", "_tie")).alias("_chosen"),
    )


def repeat_rows(docs: DataFrame, mixed: DataFrame, seed: str = "mix") -> DataFrame:
    """Every row of `docs` as often as the mix takes it, found by its source's last chosen key.

    Only one row per source is joined to the texts. Equal rows at the edge are all taken.
    """
    last = mixed.groupBy(F.col("source").alias("_source")).agg(F.first("epochs").alias("_epochs"), F.max("_chosen").alias("_last"))
    last = materialize(last, "cutoffs")
    row = docs.select(F.struct("*").alias("_row"))
    text, doc_id = F.col("_row.text"), F.col("_row.doc_id")
    key = exponential_key(doc_id, quality_weight(text), seed)
    keyed = row.withColumn("_own", F.struct(key.alias("_key"), doc_id.alias("doc_id"), F.xxhash64(text).alias("_tie")))
    joined = keyed.join(last, keyed["_row"]["source"].eqNullSafe(last["_source"]))
    times = F.col("_epochs") + F.coalesce((F.col("_own") <= F.col("_last")).cast("bigint"), F.lit(0))
    return joined.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), times.cast("int")))).select("_row.*")

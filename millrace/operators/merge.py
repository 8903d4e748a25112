"""MERGE shapes as DataFrame functions: what to append, and what a merged slice looks like."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import null_safe, restrict


def new_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert-only merge: the source rows to append, NULL keys matching NULL keys.

    The target's keys are first cut down to those that occur in the source. With a small source
    that is a broadcast semi-join, so the big target is scanned for its key columns only and never
    shuffled; the anti-join that follows is between two small sides.
    """
    wanted = source.select(*[F.col(k).alias(f"_s_{k}") for k in keys])
    held = target.select(*keys)
    cond = F.lit(True)
    for k in keys:
        cond = cond & held[k].eqNullSafe(wanted[f"_s_{k}"])
    taken = held.join(wanted, cond, "left_semi").distinct().select(*[F.col(k).alias(f"_t_{k}") for k in keys])
    unmatched = F.lit(True)
    for k in keys:
        unmatched = unmatched & source[k].eqNullSafe(taken[f"_t_{k}"])
    return source.join(taken, unmatched, "left_anti")


def insert_if_absent(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target with the given rows added unless their key is there."""
    return target.unionByName(new_rows(target, rows, keys), allowMissingColumns=True)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str],
    accept: Callable[[str, str], Column] | None = None,
) -> DataFrame:
    """The merged table: matched rows take `cols` from the source, unmatched rows are inserted.

    Columns outside `cols` keep the target's value on a match. `accept(target_prefix,
    source_prefix)` may hold back an update, for example one older than the stored row.
    One full outer join on the keys; the source must have one row per key.
    """
    s = source.select(*[F.col(c).alias(f"_s_{c}") for c in source.columns], F.lit(True).alias("_in_s"))
    t = target.select(*target.columns, F.lit(True).alias("_in_t"))
    cond = F.lit(True)
    for k in keys:
        cond = cond & t[k].eqNullSafe(s[f"_s_{k}"])
    joined = t.join(s, cond, "full")
    matched = F.col("_in_t").isNotNull() & F.col("_in_s").isNotNull()
    update = matched & (F.coalesce(accept("", "_s_"), F.lit(False)) if accept else F.lit(True))
    insert = F.col("_in_t").isNull()
    out = []
    for c in target.columns:
        if c not in source.columns:
            out.append(F.col(c))
        elif c in cols:
            out.append(F.when(insert | update, F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.when(insert, F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c))
    return joined.select(*out)


def update_from(
    target: DataFrame, source: DataFrame, key: str, when: Callable[[str, str], Column], assign: dict[str, Column]
) -> DataFrame:
    """UPDATE ... FROM: rows whose partner satisfies `when` get the assigned values."""
    s = source.select(*[F.col(c).alias(f"_s_{c}") for c in source.columns])
    joined = target.join(s, target[key] == s[f"_s_{key}"], "left")
    hit = F.coalesce(when("", "_s_") & F.col(f"_s_{key}").isNotNull(), F.lit(False))
    return joined.select(
        *[F.when(hit, assign[c]).otherwise(F.col(c)).alias(c) if c in assign else F.col(c) for c in target.columns]
    )


def changed(prefix_a: str, prefix_b: str, cols: Sequence[str], null_safe: bool = False,
            null_as: dict[str, Column] | None = None) -> Column:
    """Whether any tracked column differs.

    Plain comparison treats NULL against a value as no change; `null_as` names the columns that are
    compared after replacing NULL, and `null_safe` compares all of them NULL-safely.
    """
    terms = F.lit(False)
    for c in cols:
        a, b = F.col(prefix_a + c), F.col(prefix_b + c)
        if null_safe:
            terms = terms | ~a.eqNullSafe(b)
        elif null_as and c in null_as:
            terms = terms | (F.coalesce(a, null_as[c]) != F.coalesce(b, null_as[c]))
        else:
            terms = terms | F.coalesce(a != b, F.lit(False))
    return terms


def apply_delta(view: DataFrame, delta_keys: DataFrame, target: DataFrame, keys: Sequence[str],
                update: Sequence[str] = ()) -> DataFrame:
    """Re-apply a canonical view to the delta's keys and merge the result into the target.

    Without an update only keys that the target lacks can add rows. They are found first, so that keys
    alone meet the target, and the view is restricted once, to those.
    """
    if update:
        return upsert(target, restrict(view, delta_keys, keys), keys, update)
    fresh = new_rows(target, delta_keys.select(*keys), keys)
    return target.unionByName(restrict(view, fresh, keys), allowMissingColumns=True)


__all__ = ["new_rows", "insert_if_absent", "upsert", "update_from", "changed", "apply_delta", "null_safe"]

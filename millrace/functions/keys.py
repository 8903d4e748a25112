"""Surrogate keys by hash, and cheap repeatable draws."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_key(*cols: Column | str) -> Column:
    """md5 of the parts joined by a pipe; a NULL part makes the key NULL."""
    parts: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit("|"))
        parts.append((F.col(c) if isinstance(c, str) else c).cast("string"))
    return F.md5(F.concat(*parts)) if len(parts) > 1 else F.md5(parts[0])


_PRIME = 2147483647


def draw(id_: Column, stream: int, seed: int, n: int) -> Column:
    """Repeatable pseudo-random integer in [0, n) for a row id.

    Plain 64-bit arithmetic stays in generated code and gives the same value on any partitioning;
    `stream` separates the draws made for one id.
    """
    x = (id_.cast("bigint") % _PRIME + (stream * 7919 + seed * 104729 + 1)) % _PRIME
    x = (x * 48271) % _PRIME
    x = x.bitwiseXOR(F.shiftright(x, 15))
    x = (x * 69621) % _PRIME
    x = x.bitwiseXOR(F.shiftright(x, 13))
    x = (x * 39373) % _PRIME
    return x % n


def draw_sql(id_: str, stream: int, seed: int, n: int | str) -> str:
    """The same draw as SQL text, for checks on another engine."""
    x = f"((({id_}) % {_PRIME} + {stream * 7919 + seed * 104729 + 1}) % {_PRIME})"
    x = f"(({x} * 48271) % {_PRIME})"
    x = f"xor({x}, {x} >> 15)"
    x = f"(({x} * 69621) % {_PRIME})"
    x = f"xor({x}, {x} >> 13)"
    x = f"(({x} * 39373) % {_PRIME})"
    return f"({x} % {n})"

"""Seeded, partition-independent row hashes.

A row's position in a "random" order is ``md5('<seed>|<key>')`` so the
same seed and key give the same order on any cluster, partition count or
engine (DuckDB: ``md5('42|' || key)``).  Keys must be integers or
strings: doubles print differently across engines.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def seeded_md5(seed, *keys, salt: str | None = None) -> Column:
    """Hex md5 of ``seed[|salt]|k1|k2...`` (32 lower-case hex chars)."""
    parts = [F.lit(str(seed))]
    if salt:
        parts.append(F.lit(salt))
    parts += [_as_col(k).cast("string") for k in keys]
    return F.md5(F.concat_ws("|", *parts))


def hash_prefix(hex_col: Column, digits: int) -> Column:
    """First ``digits`` hex characters: a bucket that sorts like the hash."""
    return F.substring(hex_col, 1, digits)


def hash_unit(hex_col: Column) -> Column:
    """Map the first 32 bits of a hex hash to a double in [0, 1)."""
    return F.conv(F.substring(hex_col, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)

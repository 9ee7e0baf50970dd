"""Keyed, partitioning-independent randomness.

``rand(seed)`` depends on how rows are spread over partitions, so a retried or
re-partitioned job would draw different numbers. Every random choice here is a
pure function of (seed, salt, row key) instead: the first 13 hex digits of an
md5 digest, i.e. 52 bits, which a double holds exactly.

The same numbers come out of any SQL engine with ``md5`` and hex parsing,
which is what the oracle queries use.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 13 hex digits = 52 bits; 16**13 scales them into [0, 1).
HEX_DIGITS = 13
HEX_SCALE = 4503599627370496.0  # 16 ** 13


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_hex(seed, salt: str, *keys) -> Column:
    """md5 hex digest of ``seed:salt:key1:key2...`` (keys cast to string)."""
    seed_col = seed.cast("string") if isinstance(seed, Column) else F.lit(str(seed))
    salt_col = salt if isinstance(salt, Column) else F.lit(salt)
    parts = [seed_col, salt_col] + [_col(k).cast("string") for k in keys]
    return F.md5(F.concat_ws(":", *parts))


def hash_rank(seed, salt: str, *keys) -> Column:
    """52-bit integer from the digest: the sort key of a keyed shuffle."""
    return F.conv(F.substring(hash_hex(seed, salt, *keys), 1, HEX_DIGITS), 16, 10).cast("long")


def uniform(seed, salt: str, *keys) -> Column:
    """Uniform double in [0, 1) keyed by the row."""
    return hash_rank(seed, salt, *keys).cast("double") / F.lit(HEX_SCALE)


def hash_bucket(rank: Column, digits: int) -> Column:
    """Leading ``digits`` hex digits of a 52-bit rank, as an int bucket.

    Order-preserving: a smaller bucket always holds smaller ranks, which lets
    k-smallest selections count buckets first and sort only one of them.
    """
    shift = 4 * (HEX_DIGITS - digits)
    return F.shiftright(rank, shift).cast("int")


def sql_hash_rank(seed, salt: str, *key_sql: str, seed_sql: str | None = None) -> str:
    """DuckDB twin of :func:`hash_rank` for oracle SQL (``seed_sql``: a per-row seed expression)."""
    keys = ", ".join(f"CAST({k} AS VARCHAR)" for k in key_sql)
    sd = f"CAST({seed_sql} AS VARCHAR)" if seed_sql else f"'{seed}'"
    return (f"('0x' || substr(md5(concat_ws(':', {sd}, '{salt}', {keys})), 1, {HEX_DIGITS}))::BIGINT")


def sql_uniform(seed, salt: str, *key_sql: str, seed_sql: str | None = None) -> str:
    return f"({sql_hash_rank(seed, salt, *key_sql, seed_sql=seed_sql)} / {HEX_SCALE})"

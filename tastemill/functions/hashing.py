"""Hash expressions that give the same value in any partitioning (and in other SQL engines)."""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the modulus of the min-hash family in Spark ML, a prime.
MINHASH_PRIME = 2038074743


def md5_key(*cols: str | Column, seed: int | None = None) -> Column:
    """32 hex digits over the given columns, uniform; a seed gives another order."""
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in parts]
    if seed is not None:
        parts = [F.lit(str(seed)), *parts]
    return F.md5(F.concat_ws("|", *parts).cast("binary"))


def hex_int(digest: Column, digits: int) -> Column:
    """The first hex digits of a digest as a bigint."""
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("bigint")


def xxhash_bucket(col: str, buckets: int = 100) -> Column:
    """Non-negative bucket of the 64-bit hash; the hash depends on the column type."""
    return F.pmod(F.xxhash64(F.col(col)), F.lit(buckets))


def md5_bucket(col: str, buckets: int = 100) -> Column:
    """Bucket that any SQL engine with md5 reproduces."""
    return hex_int(F.md5(F.col(col).cast("string").cast("binary")), 8) % F.lit(buckets)


def minhash_coefficients(tables: int, seed: int) -> list[tuple[int, int]]:
    rng = random.Random(seed)
    return [(rng.randrange(1, MINHASH_PRIME), rng.randrange(0, MINHASH_PRIME)) for _ in range(tables)]


def minhash_value(token: Column, a: int, b: int) -> Column:
    """One hash of the family ((1 + x) a + b) mod p, never negative; x is an int32."""
    return F.pmod((token.cast("bigint") + 1) * F.lit(a).cast("bigint") + F.lit(b).cast("bigint"), F.lit(MINHASH_PRIME))


def minhash_signature(token: Column, coefficients: Sequence[tuple[int, int]]) -> list[Column]:
    """One ``min`` aggregate per table: partial aggregation keeps any set size flat."""
    return [F.min(minhash_value(token, a, b)).alias(f"h{i}") for i, (a, b) in enumerate(coefficients)]

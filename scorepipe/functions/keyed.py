"""Repeatable random choices: every draw is a hash of (seed, stable key), never of a row position.

The hash is md5, so the same choice can be reproduced in any SQL engine and does not depend on
how the data happens to be partitioned.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BUCKET_DIGITS = 3
"""Hex digits of the hash that name a bucket: at most 16^3 = 4,096 buckets."""


def hash_key(seed: int | str, key: Column) -> Column:
    """32 hex digits; its order is a random order of the keys."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def hash_bucket(hashed: Column, level: int = 1) -> Column:
    """Leading digits of the hash; each level divides a bucket by 4,096."""
    return F.substring(hashed, 1, level * BUCKET_DIGITS)


def hash_buckets(hashed: Column) -> list[Column]:
    """Ever finer buckets, coarsest first."""
    return [hash_bucket(hashed, level) for level in (1, 2, 3)]


def hash_int(hashed: Column) -> Column:
    """First 60 bits of the hash as a non-negative integer, so that a remainder by any count of rows is even."""
    return F.conv(F.substring(hashed, 1, 15), 16, 10).cast("bigint")


def unit(hashed: Column) -> Column:
    """Hash as a double in [0, 1)."""
    return hash_int(hashed).cast("double") / F.lit(2.0**60).cast("double")

"""Deterministic replacement for random seeds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_BITS = 28
HASH_SPACE = 1 << HASH_BITS


WIDE_BITS = 60


def hash_key(key: Column, seed: int, bits: int = HASH_BITS) -> Column:
    """A uniform integer in [0, 2^bits) that depends only on the key and the seed; `bits` is a multiple of four, 60 at most."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, bits // 4), 16, 10).cast("bigint")

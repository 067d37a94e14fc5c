"""Hashes that any engine with MD5 can repeat."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from quern.functions.vectors import bind


def md5_bucket(c: Column, buckets: int) -> Column:
    """MD5 of the text, read as one 128-bit integer, modulo ``buckets``.

    The digest is folded in four 32-bit digits, so intermediate values stay below
    ``buckets * 2**32``.
    """
    if not 0 < buckets <= 2**30:
        raise ValueError("buckets must be in 1..2**30")

    def fold(digest: Column) -> Column:
        digits = [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(4)]
        return reduce(lambda acc, d: (acc * F.lit(2**32) + d) % buckets, digits, F.lit(0).cast("bigint"))

    return bind(F.md5(c), fold)


def hash_text(key: Column, seed: int) -> Column:
    return F.md5(F.concat_ws(":", key.cast("string"), F.lit(str(seed))))


def unit_hash(key: Column, seed: int) -> Column:
    """A repeatable draw in [0, 1) for a key, in steps of 2**-32."""
    return F.conv(F.substring(hash_text(key, seed), 1, 8), 16, 10).cast("double") / 2.0**32

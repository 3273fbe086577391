"""Deterministic pseudo-random row order."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ORDER = "_order"
BUCKET = "_bucket"


def shuffle_key(row_id: Column, seed: int, method: str = "xxhash64") -> Column:
    """Hash of a row id that orders rows at random, but always the same way.

    ``xxhash64`` is the fast choice; ``md5`` gives an order other engines can
    reproduce.
    """
    if method == "xxhash64":
        return F.xxhash64(row_id, F.lit(seed))
    if method == "md5":
        return F.md5(F.concat(row_id.cast("string"), F.lit(str(seed))))
    raise ValueError(f"unknown method: {method}")


def leading_bucket(key: Column, method: str = "xxhash64") -> Column:
    """Leading 16 bits of ``shuffle_key``: up to 65,536 buckets in key order."""
    prefix = key_prefix(key, 1, method)
    return prefix.cast("int") if method == "xxhash64" else F.conv(prefix, 16, 10).cast("int")


#: Levels of ``key_prefix``: the whole of an xxhash64 key.
LEVELS = 4


def key_prefix(key: Column, level: int, method: str = "xxhash64") -> Column:
    """Leading 16 bits per level of ``shuffle_key``, in key order: 65,536 buckets of each bucket of the level above."""
    if method == "xxhash64":
        return F.shiftright(key, 64 - 16 * level) if level < LEVELS else key
    return F.substring(key, 1, 4 * level)

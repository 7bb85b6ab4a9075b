"""Draws that depend on the row key alone, so that a retried task repeats them."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .numeric import as_col


def key_hash(key, seed: str = "") -> Column:
    """32-bit number from the MD5 of the key text."""
    text = as_col(key).cast("string")
    if seed:
        text = F.concat(F.lit(f"{seed}:"), text)
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def key_uniform(key, seed: str = "") -> Column:
    """Number in [0, 1) drawn from the key."""
    return key_hash(key, seed) / F.lit(4294967296.0)


def hash_fold(key, k: int, seed: str = "") -> Column:
    return (key_hash(key, seed) % F.lit(k)).cast("int")

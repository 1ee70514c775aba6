"""Seeded hashes of keys: the same row gets the same value on any partitioning and any engine."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .expressions import column


def seeded_hash(seed: int | str, key: str) -> Column:
    """32 hex digits, uniform over the keys."""
    return F.md5(F.concat(F.lit(f"{seed}:"), column(key).cast("string")))


def hash_below(share: float) -> str:
    """Hash prefix under which ``share`` of all keys fall (``0.3`` gives ``4ccccccd``)."""
    return format(round(share * 16**8), "08x") if share < 1 else "g"


def random_code(seed: int | str, key: str, length: int = 10) -> Column:
    return F.substring(seeded_hash(seed, key), 1, length)

"""Reproducible pseudo-randomness from row content.

``rand()`` depends on partitioning; these helpers depend only on a seed and
the row's key, so the same rows are picked on any cluster size, and the same
value is computed by any SQL engine with ``md5``:

    hash_key(seed, k) = first 15 hex digits of md5(seed || '|' || k) as bigint
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def hash_key(seed: int | str, *cols: Column | str) -> Column:
    """Non-negative 60-bit integer, uniform, from md5 of ``seed|k1|k2...``."""
    parts = [F.lit(str(seed))] + [_c(c).cast("string") for c in cols]
    digest = F.md5(F.concat_ws("|", *parts))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def hash_bucket(seed: int | str, n: int, *cols: Column | str) -> Column:
    """Bucket 0..n-1 of the row, reproducible."""
    return F.pmod(hash_key(seed, *cols), F.lit(n))


def hash_pick(seed: int | str, choices: Sequence[str], *cols: Column | str) -> Column:
    """One of ``choices``, uniformly by the row's key (seeded ``rand()*k``)."""
    arr = F.array(*[F.lit(v) for v in choices])
    return F.get(arr, hash_bucket(seed, len(choices), *cols).cast("int"))

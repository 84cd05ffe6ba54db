"""Seeded keys for sampling and shuffling.

The key of a row depends on its id and the seed only, never on partitioning, task
order or retries, so a sample is the same on 8 threads and on 1000 executors and
a lost executor recomputes the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sample_key(key: Column | str, seed: int) -> Column:
    """32 hex digits, uniform and fixed by (seed, key); ids that differ give different keys.

    A NULL id counts as empty text, so it has a key as well.
    """
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))


def sample_fraction(key: Column | str, seed: int) -> Column:
    """Uniform number in [0, 1) from the first eight digits of :func:`sample_key`."""
    head = F.conv(F.substring(sample_key(key, seed), 1, 8), 16, 10).cast("double")
    return head / F.lit(float(1 << 32))

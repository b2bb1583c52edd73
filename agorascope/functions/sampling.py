"""Row choices that depend on the row's key only.

Unlike ``df.sample`` and ``randomSplit`` these give the same rows whatever the partitioning,
so recomputed tasks agree and two models can be compared on identical test rows.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SPACE = 2**32


def key_fraction(key: Column, seed: int) -> Column:
    """A uniform number in [0, 1) fixed by key and seed (first 32 bits of MD5)."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / SPACE


def in_sample(key: Column, fraction: float, seed: int) -> Column:
    return key_fraction(key, seed) < fraction

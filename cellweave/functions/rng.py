"""Random numbers as columns: a hash of who draws, which draw, and a seed. Plans and retries see the same draws."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def uniform(seed: int, *who: Column | str) -> Column:
    """In (0, 1), from 32 bits of md5: other engines can draw the same."""
    cols = [F.col(w) if isinstance(w, str) else w for w in who]
    digest = F.md5(F.concat_ws("|", *[c.cast("string") for c in cols], F.lit(str(seed))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") + 0.5) / float(2**32)


def fast_uniform(seed: int, *who: Column | str) -> Column:
    """In (0, 1), from xxhash64: several times faster, Spark's own."""
    return (F.shiftrightunsigned(F.xxhash64(*who, F.lit(seed)), 11) + 0.5) / float(2**53)


def normal_pair(u: Column, v: Column) -> tuple[Column, Column]:
    """Two standard normal draws from two uniform ones."""
    r = F.sqrt(F.log(u) * -2.0)
    angle = v * (2 * math.pi)
    return r * F.cos(angle), r * F.sin(angle)

"""Portable seeded hash.

``hash_int(seed, parts...)`` is the first 8 hex digits of
``md5(concat_ws('|', seed, parts...))`` read as an unsigned integer
(0 .. 2^32-1). The same value can be computed in any SQL engine with md5,
which is what makes seeded shuffles and samples checkable by an oracle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _as_col(x) -> Column:
    if isinstance(x, Column):
        return x.cast("string")
    return F.lit(str(x))


def hash_int(seed, *parts) -> Column:
    text = F.concat_ws("|", _as_col(seed), *[_as_col(p) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def hash_mod(modulus: int, seed, *parts) -> Column:
    return F.pmod(hash_int(seed, *parts), F.lit(modulus).cast("bigint"))

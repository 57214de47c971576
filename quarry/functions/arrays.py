"""Array expressions built from Spark higher-order functions (no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def array_dot(x: Column, w: Column) -> Column:
    """Sum of element-wise products of two equally long numeric arrays."""
    return F.aggregate(F.zip_with(x, w, lambda a, b: a * b), F.lit(0.0).cast("double"),
                       lambda acc, v: acc + v)


def array_log_softmax(z: Column) -> Column:
    """``z - max(z) - ln(sum(exp(z - max(z))))`` element-wise."""
    zmax = F.array_max(z)
    lse = F.log(F.aggregate(z, F.lit(0.0).cast("double"),
                            lambda acc, v: acc + F.exp(v - zmax)))
    return F.transform(z, lambda v: v - zmax - lse)


def argmax_index(z: Column) -> Column:
    """0-based index of the largest element; the first one wins ties."""
    return (F.array_position(z, F.array_max(z)) - 1).cast("int")

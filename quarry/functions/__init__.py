"""Column-level helpers (JVM-side expressions only)."""

from quarry.functions.hashing import hash_int, hash_mod
from quarry.functions.arrays import (
    argmax_index,
    array_dot,
    array_log_softmax,
)

__all__ = [
    "hash_int",
    "hash_mod",
    "argmax_index",
    "array_dot",
    "array_log_softmax",
]

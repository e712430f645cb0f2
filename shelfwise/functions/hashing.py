"""Seeded 32-bit hash in plain long arithmetic: multiply, fold the high half into the low one, multiply.

Multiplication modulo 2^32 (Knuth's constant) takes the constant less 2^32, which leaves the residue as it is
and keeps every product below 2^63, so nothing overflows in ANSI mode. Any SQL engine computes the same
number, independent of partitioning (the SQL text splits the constant in 16-bit halves instead). The fold
between the two rounds breaks the linearity in the key, so hashes of different seeds are unrelated.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Knuth's multiplicative constant, split in 16-bit halves.
KNUTH = 2654435761
_HI, _LO = KNUTH >> 16, KNUTH & 0xFFFF
U32 = 1 << 32
_SEED_STEP = 40503


def _round(k: Column) -> Column:
    """k * KNUTH modulo 2^32 for 0 <= k < 2^32; ``k`` stands once, as every use of a column repeats its expression."""
    return F.pmod(k * F.lit(KNUTH - U32), F.lit(U32))


def hash_u32(key, seed: int = 0) -> Column:
    k = F.pmod((F.col(key) if isinstance(key, str) else key) + F.lit(seed * _SEED_STEP), F.lit(U32))
    a = _round(k)
    return _round(F.pmod(a + F.shiftright(a, 16) * F.lit(2 * seed + 1), F.lit(U32)))


def hash_pair_u32(a, b, seed: int = 0) -> Column:
    """Hash of a two-column key: hash(hash(a) + b)."""
    return hash_u32(hash_u32(a, seed) + (F.col(b) if isinstance(b, str) else b), seed)


def hash_sql(expr: str, seed: int = 0) -> str:
    """The same hash as SQL text (for oracles)."""
    def one(k: str) -> str:
        return f"(({k}) * {_LO} + ((({k}) * {_HI}) % 65536) * 65536) % {U32}"

    a = one(f"((({expr}) + {seed * _SEED_STEP}) % {U32} + {U32}) % {U32}")
    return one(f"(({a}) + (({a}) // 65536) * {2 * seed + 1}) % {U32}")

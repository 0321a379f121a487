"""Randomness as column expressions: the same draw for the same seed and key, on any partitioning and in any engine.

A uniform is the first 32 bits of md5("seed:key") over 2**32, moved to the middle of its step, so it is never 0 or 1.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STEPS = float(1 << 32)


def hash32(seed: int | str, *key: Column) -> Column:
    """An integer from 0 to 2**32 - 1."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), *(k.cast("string") for k in key)).cast("binary")), 1, 8), 16, 10).cast("bigint")


def uniform(seed: int | str, *key: Column) -> Column:
    """Uniform on (0, 1)."""
    return (hash32(seed, *key).cast("double") + 0.5) / F.lit(STEPS)


def laplace(scale: Column | float, seed: int | str, *key: Column) -> Column:
    """Laplace noise by the inverse distribution function; 0 where the scale is not positive."""
    u, b = uniform(seed, *key) - 0.5, scale if isinstance(scale, Column) else F.lit(float(scale))
    return F.when(b > 0, -b * F.signum(u) * F.ln(1 - 2 * F.abs(u))).otherwise(F.lit(0.0))


def normal(seed: int | str, *key: Column) -> Column:
    """Standard normal by Box and Muller from two uniforms."""
    return F.sqrt(-2 * F.ln(uniform(f"{seed}a", *key))) * F.cos(2 * F.pi() * uniform(f"{seed}b", *key))


def hash_order(seed: int | str, *key: Column) -> list[Column]:
    """An ordering that shuffles rows repeatably; the keys themselves settle equal hashes."""
    return [hash32(seed, *key), *key]

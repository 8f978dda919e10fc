"""Reproducible draws.

Every random choice is a pure function of the seed, a tag naming the choice
and stable row keys, hashed with MD5.  Spark and other SQL engines compute the
same digest, so retries, repartitioning and an external SQL check all see the
same values.  Digits of the hex digest are read as fractions in [0, 1).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


def digest(seed: int, tag: str, *keys) -> Column:
    """Hex MD5 of ``seed|tag|key1|key2...`` (keys rendered as strings)."""
    parts = [F.lit(str(seed)), F.lit(tag)] + [_c(k).cast("string") for k in keys]
    return F.md5(F.concat_ws("|", *parts))


def hex_fraction(hex_digest, start: int, length: int) -> Column:
    """Hex digits ``start..start+length-1`` (1-based) as a fraction in [0, 1)."""
    if length > 13:
        raise ValueError("at most 13 hex digits fit a double exactly")
    num = F.conv(F.substring(_c(hex_digest), start, length), 16, 10).cast("double")
    return num / F.lit(float(16**length))


def uniform(seed: int, tag: str, *keys) -> Column:
    """Uniform double in [0, 1) with 52 bits from one digest."""
    return hex_fraction(digest(seed, tag, *keys), 1, 13)


def uniform_index(u, n) -> Column:
    """``floor(u * n)`` as bigint: uniform integer in ``0..n-1``."""
    return F.floor(_c(u) * _c(n)).cast("bigint")


# The counter mixer below works on 32-bit halves held in bigints, so that no product
# overflows and other SQL engines can follow it.
MASK32 = 0xFFFFFFFF
MIX_MULTIPLIER = 0x45D9F3B  # odd, below 2^27: products stay inside bigint
WEYL_STEP = 0x9E3779B9
TWO_POW_32 = 4294967296.0


def key64(seed: int, tag: str, *keys) -> Column:
    """Two independent 32-bit halves (bigints ``a`` and ``b``) of one digest."""
    d = digest(seed, tag, *keys)
    half = lambda start: F.conv(F.substring(d, start, 8), 16, 10).cast("bigint")
    return F.struct(half(1).alias("a"), half(9).alias("b"))


def counter32(start, counter) -> Column:
    """``(start + counter * WEYL_STEP) mod 2^32``: distinct inputs per counter."""
    return (_c(start) + _c(counter).cast("bigint") * F.lit(WEYL_STEP)).bitwiseAND(F.lit(MASK32))


def mix_round(x) -> Column:
    x = _c(x)
    return (F.shiftright(x, 16).bitwiseXOR(x) * F.lit(MIX_MULTIPLIER)).bitwiseAND(F.lit(MASK32))


def mix_final(x) -> Column:
    x = _c(x)
    return F.shiftright(x, 16).bitwiseXOR(x)


def mix32(counter, half) -> Column:
    """Integer mixer: two multiply-xorshift rounds with the key's second half xor-ed in
    between, and a final xorshift.  Two streams of draws coincide only if their
    counters meet and their second halves are equal.

    All steps are plain bigint column arithmetic (code-generated; common
    subexpressions are evaluated once).
    """
    return mix_final(mix_round(mix_round(counter).bitwiseXOR(_c(half))))


def unit32(h) -> Column:
    """32-bit value as a fraction in [0, 1)."""
    return _c(h).cast("double") / F.lit(TWO_POW_32)

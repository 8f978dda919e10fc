"""A keyed bijection of 0..n-1 as column arithmetic: an order without a sort.

A number is written as ``left * b + right`` with ``left < a`` and ``right < b``; rounds of
a Feistel network add a keyed mix of one half to the other, which can be undone, so numbers
of 0..a*b-1 change places.  ``a`` is chosen near the root of n so that a*b exceeds n by as
little as possible.  Numbers that land on one of the ``a * b - n`` places beyond n walk on
(the network is applied again) until they are below n.  A walk meets every place at most
once, so ``a * b - n + 1`` steps always end it and the whole is a permutation of 0..n-1.

Every round is plain bigint arithmetic, which other SQL engines can follow; here it runs on
Arrow batches, all numbers of a batch in step.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .hashing import MASK32, MIX_MULTIPLIER, WEYL_STEP

ROUNDS = 6
#: Halves tried for ``a``, from the root of n on, and the largest multiple of the root.
SEARCH = 1 << 20
WIDEST = 4


@dataclass(frozen=True)
class Domain:
    """``a * b >= n``, the numbers that the network permutes."""

    n: int
    a: int
    b: int

    @property
    def walks(self) -> int:
        return self.a * self.b - self.n + 1


def domain(n: int) -> Domain:
    """Halves with the least excess over n, of these the smallest ``a``."""
    if n < 1:
        return Domain(0, 1, 1)
    low = math.isqrt(n - 1) + 1
    high = min(WIDEST * low, low + SEARCH, max(low, (n + 1) // 2))
    a = np.arange(low, high + 1, dtype=np.int64)
    best = int(a[((a - n % a) % a).argmin()])
    return Domain(n, best, -(-n // best))


def keys(seed: int, tag: str, epoch: int) -> tuple[int, int]:
    """Two 32-bit halves of one digest, as ``hashing.key64`` of the same arguments."""
    d = hashlib.md5(f"{seed}|{tag}|{epoch}".encode()).hexdigest()
    return int(d[:8], 16), int(d[8:16], 16)


def permuted(number: Column, first: Column, second: Column, n: int, inverse: bool = False) -> Column:
    """The place of ``number`` (of 0..n-1) under the key halves ``first`` and ``second``, or
    with ``inverse`` the number whose place it is.

    Whole Arrow batches take the rounds in step, as bigint arithmetic; a walk goes on for the few
    numbers that are still beyond n.  The number of rounds is even, so both halves end as they began.
    """
    d = domain(n)
    a, b, walks, mask, weyl, multiplier = d.a, d.b, d.walks, MASK32, WEYL_STEP, MIX_MULTIPLIER
    order = list(reversed(range(ROUNDS))) if inverse else list(range(ROUNDS))

    def run(number: pa.Array, first: pa.Array, second: pa.Array) -> pa.Array:
        import numpy as np
        import pyarrow as pa

        def mixed(x):
            return (((x >> 16) ^ x) * multiplier) & mask

        def network(at, k1, k2):
            x, y = at // b, at % b
            for i in order:
                size = a if i % 2 == 0 else b
                half = x if inverse else y
                m = mixed(mixed(half ^ ((k1 + (i + 1) * weyl) & mask)) ^ k2)
                m ^= m >> 16
                x, y = ((y - m) % size, x) if inverse else (y, (x + m) % size)
            return x * b + y

        known = np.asarray(number.is_valid())
        at, k1, k2 = (c.fill_null(0).to_numpy(zero_copy_only=False) for c in (number, first, second))
        out = network(at, k1, k2)
        live = np.flatnonzero(known & (out >= n))
        for _ in range(walks - 1):
            if not len(live):
                break
            out[live] = network(out[live], k1[live], k2[live])
            live = live[out[live] >= n]
        return pa.array(out, pa.int64(), mask=~known)

    return F.arrow_udf(run, "bigint")(number.cast("bigint"), first.cast("bigint"), second.cast("bigint"))

"""Masked-language-model corruption inside a row (no shuffle).

Each (epoch, example) gets a 64-bit key from one digest of seed, epoch and
example id.  Position ``i`` then uses three counter draws through an integer
mixer: counter ``3i`` decides selection, ``3i+1`` the branch ([MASK] / random
id / unchanged) and ``3i+2`` the random id.  Masks are redrawn every epoch;
the same seed always gives the same masks, whatever the partitioning.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import IGNORE_INDEX, SpecialIds
from .hashing import MASK32, MIX_MULTIPLIER, TWO_POW_32, WEYL_STEP, counter32, key64, mix32, unit32

MLM_TAG = "mlm"
DRAWS_PER_POSITION = 3
#: Examples whose positions are drawn in one step.
ROWS_AT_ONCE = 1024


def mask_key(seed: int, epoch, example_id) -> Column:
    """Struct of the two halves of the key."""
    return key64(seed, MLM_TAG, epoch, example_id)


def position_draw(key, pos, j: int) -> Column:
    """Draw ``j`` (0 selection, 1 branch, 2 random id) of one position as a
    fraction in [0, 1); scalar form for long tables.  ``key`` is a struct column."""
    p = F.col(pos) if isinstance(pos, str) else pos
    return unit32(mix32(counter32(key["a"], p * DRAWS_PER_POSITION + j), key["b"]))


def masked_and_labels(ids, key, vocab_size: int, p: float, mask_share: float, random_share: float,
                      special: SpecialIds = SpecialIds()) -> Column:
    """Struct of ``ids``, masked, and ``labels`` from an array of ids and a key struct.

    Whole Arrow batches are drawn in step; the branch and random-id draws (counters ``3i+1``,
    ``3i+2``) only for selected positions.  A NULL array stays NULL, a NULL id is never selected.
    """
    never = np.array(sorted(special.never_masked), np.int64)
    unscored, mask_id, fill = IGNORE_INDEX, special.mask, int(never[0])
    mask, weyl, multiplier, draws, whole, step = MASK32, WEYL_STEP, MIX_MULTIPLIER, DRAWS_PER_POSITION, TWO_POW_32, ROWS_AT_ONCE
    rand_t = round(mask_share + random_share, 12)

    def run(ids: pa.Array, first: pa.Array, second: pa.Array) -> pa.Array:
        import numpy as np
        import pyarrow as pa

        def mixed(x):
            return (((x >> 16) ^ x) * multiplier) & mask

        def unit(counter, half):
            x = mixed(mixed(counter & mask) ^ half)
            return ((x >> 16) ^ x) / whole

        def part(ids, a, b):
            sizes = ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(sizes)
            flat = ids.flatten()
            null = None if not flat.null_count else np.asarray(flat.is_null())
            t = (flat if null is None else flat.fill_null(fill)).to_numpy(zero_copy_only=False)
            free = t != never[0]
            for x in never[1:]:
                free &= t != x
            at = np.flatnonzero(free)
            row = np.repeat(np.arange(len(sizes)), sizes)[at]
            counter = a[row] + (at - (ends - sizes)[row]) * (draws * weyl)
            chosen = unit(counter, b[row]) < p
            at, row, counter = at[chosen], row[chosen], counter[chosen]
            labels = np.full(len(t), unscored, np.int64)
            labels[at] = t[at]
            branch, masked = unit(counter + weyl, b[row]), t.copy()
            masked[at[branch < mask_share]] = mask_id
            drawn = (branch >= mask_share) & (branch < rand_t)
            masked[at[drawn]] = np.floor(unit(counter[drawn] + 2 * weyl, b[row[drawn]]) * vocab_size).astype(np.int64)
            offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
            gone = None if not ids.null_count else ids.is_null()
            lists = [pa.ListArray.from_arrays(offsets, pa.array(v, pa.int64(), mask=m), mask=gone) for v, m in ((masked, null), (labels, None))]
            return pa.StructArray.from_arrays(lists, names=["ids", "labels"])

        a, b = (c.to_numpy(zero_copy_only=False) for c in (first, second))
        parts = [part(ids[i : i + step], a[i : i + step], b[i : i + step]) for i in range(0, max(1, len(ids)), step)]
        return pa.concat_arrays(parts)

    out = F.arrow_udf(run, "struct<ids: array<bigint>, labels: array<bigint>>")
    return out(ids, key["a"], key["b"])

"""A vocabulary as constant arrays, looked up inside a row.

Hash and displace: a token's 64-bit hash names a bucket, the bucket's displacement turns the
hash into a slot, and no two tokens of the vocabulary share a slot.  A slot holds its token, which
is compared, so a token outside the vocabulary is never taken for one inside.  The
arrays are constants of the plan: no join, no regrouping, no shuffle.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Largest vocabulary, in tokens and bytes, that becomes constants of a plan.
MAX_TOKENS = 1 << 17
MAX_BYTES = 4 << 20
PER_BUCKET = 4
#: Characters tried to keep tokens apart in one string constant.
SEPARATORS = ("\n", "\x00", "\x01", "\x02", "\x1f")


def _prime(n: int) -> int:
    """The smallest prime of at least n."""
    n = max(n, 2)
    while any(n % d == 0 for d in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def _parts(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket, and the start and step of a token's slots, from its hash."""
    low, high = hashes & 0xFFFFFFFF, (hashes >> 32) & 0xFFFFFFFF
    return (low ^ (high >> 7)) % buckets, low, high


def displace(hashes: np.ndarray) -> tuple[np.ndarray, int]:
    """Displacements by bucket and the number of slots: (start + d * step) mod slots differs
    for all hashes.  If no displacement of a bucket does, there are more slots (only very small
    vocabularies need that)."""
    if len(np.unique(hashes)) != len(hashes):
        raise ValueError("two tokens of the vocabulary have one hash")
    slots = _prime(int(len(hashes) * 1.05) + 1)
    while (out := _displaced(hashes, slots)) is None:
        slots = _prime(slots + slots // 4 + 1)
    return out, slots


def _displaced(hashes: np.ndarray, slots: int) -> np.ndarray | None:
    """Large buckets first; a bucket tries one displacement after the other."""
    buckets = max(1, len(hashes) // PER_BUCKET)
    bucket, start, step = _parts(hashes, buckets)
    start, step = start % slots, step % (slots - 1) + 1  # a step of 0 would go nowhere
    order = np.argsort(bucket, kind="stable")
    sizes = np.bincount(bucket, minlength=buckets)
    ends = np.cumsum(sizes)
    taken = np.zeros(slots, bool)
    out = np.zeros(buckets, np.int64)
    for b in np.argsort(-sizes, kind="stable"):
        own = order[ends[b] - sizes[b] : ends[b]]
        if not len(own):
            break
        for low in range(0, slots, 512):
            d = np.arange(low, min(low + 512, slots))
            at = (start[own][None, :] + d[:, None] * step[own][None, :]) % slots
            free = ~taken[at].any(1)
            if len(own) > 1:
                s = np.sort(at, 1)
                free &= (s[:, 1:] != s[:, :-1]).all(1)
            if free.any():
                k = int(free.argmax())
                out[b] = d[k]
                taken[at[k]] = True
                break
        else:
            return None
    return out


class TokenTable:
    """Constant arrays of a vocabulary: displacements, tokens and ids by slot."""

    def __init__(self, tokens: list[str], ids: list[int], hashes: list[int]):
        self.separator = next((s for s in SEPARATORS if not any(s in t for t in tokens)), None)
        if self.separator is None or "" in tokens:
            raise ValueError("the tokens cannot be kept apart in one constant")
        h = np.array(hashes, np.int64)
        self.displacements, self.slots = displace(h)
        bucket, start, step = _parts(h, len(self.displacements))
        at = (start % self.slots + self.displacements[bucket] * (step % (self.slots - 1) + 1)) % self.slots
        self.tokens, self.ids = [""] * self.slots, [0] * self.slots
        for slot, token, id_ in zip(at.tolist(), tokens, ids):
            self.tokens[slot], self.ids[slot] = token, int(id_)

    def _array(self, values, kind: str, separator: str) -> Column:
        # one string constant, split when the plan is optimised
        return F.split(F.lit(separator.join(map(str, values))), F.lit(f"\\Q{separator}\\E")).cast(f"array<{kind}>")

    def ids_of(self, words: Column, unknown: int) -> Column:
        """array<bigint> of ids of an array of words, ``unknown`` for those outside."""
        displacements = self._array(self.displacements.tolist(), "bigint", ",")
        tokens, ids = self._array(self.tokens, "string", self.separator), self._array(self.ids, "bigint", ",")
        n = len(self.displacements)

        def slot(h):
            low, high = h.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32)
            d = F.get(displacements, (low.bitwiseXOR(F.shiftright(high, 7)) % n).cast("int"))
            return ((low % self.slots + d * (high % (self.slots - 1) + 1)) % self.slots).cast("int")

        hashes = F.transform(words, lambda w: F.xxhash64(w))
        slots = F.transform(hashes, slot)
        unk = F.lit(unknown).cast("bigint")
        return F.zip_with(words, slots, lambda w, s: F.when(F.get(tokens, s) == w, F.get(ids, s)).otherwise(unk))


def token_table(vocab: DataFrame, max_tokens: int = MAX_TOKENS, max_bytes: int = MAX_BYTES) -> TokenTable | None:
    """The table of a vocabulary whose counted size allows it, else None (then a join looks
    tokens up).  A repeated token raises; null and empty tokens are in no text."""
    v = vocab.where("token is not null and token <> ''")
    size = v.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("token") + 16).alias("b")).first()
    if not size["n"] or size["n"] > max_tokens or size["b"] > max_bytes:
        return None
    rows = v.select("token", "id", F.xxhash64("token").alias("h")).collect()
    if len({r["token"] for r in rows}) != len(rows):
        raise ValueError("the vocabulary has a token twice")
    if len({r["h"] for r in rows}) != len(rows) or all(any(s in r["token"] for r in rows) for s in SEPARATORS):
        return None
    return TokenTable([r["token"] for r in rows], [r["id"] for r in rows], [r["h"] for r in rows])

"""Truncation and layout: worked tables and the properties that fix them."""

import random

import pytest
from pyspark.sql import functions as F

from pairloom.config import SpecialIds
from pairloom.functions.sequences import assemble, truncated_lengths

# budget, lengths of a and b -> kept lengths, worked by hand
KEPT = [
    (10, 3, 4, 3, 4), (10, 5, 5, 5, 5), (10, 6, 5, 5, 5), (10, 5, 6, 5, 5), (10, 9, 9, 5, 5),
    (11, 9, 9, 6, 5), (11, 20, 2, 9, 2), (11, 2, 20, 2, 9), (11, 6, 20, 6, 5), (11, 5, 20, 5, 6),
    (10, 0, 15, 0, 10), (10, 15, 0, 10, 0), (0, 4, 4, 0, 0), (1, 4, 4, 1, 0), (7, 4, 4, 4, 3), (10, 0, 0, 0, 0),
]


def lengths(spark, cases):
    out = {}
    for budget in sorted({c[0] for c in cases}):
        df = spark.createDataFrame([c[1:3] for c in cases if c[0] == budget], "la int, lb int")
        na, nb = truncated_lengths(F.col("la"), F.col("lb"), budget)
        out |= {(budget, r.la, r.lb): (r.na, r.nb) for r in df.select("la", "lb", na.alias("na"), nb.alias("nb")).collect()}
    return out


def test_worked_truncations(spark):
    got = lengths(spark, KEPT)
    assert got == {(b, x, y): (na, nb) for b, x, y, na, nb in KEPT}


def test_truncation_properties(spark):
    got = lengths(spark, [(b, x, y) for b in range(14) for x in range(20) for y in range(20)])
    assert len(got) == 14 * 400
    for (budget, x, y), (na, nb) in got.items():
        assert 0 <= na <= x and 0 <= nb <= y
        # nothing is cut without need, and never more than needed
        assert na + nb == min(x + y, budget)
        if na < x and nb < y:
            assert na - nb in (0, 1)  # both cut: even, the odd token stays with a
        elif na < x:
            assert na >= nb  # only the longer side is cut
        elif nb < y:
            assert nb >= na - 1


CLS, SEP, PAD = 2, 3, 1
# a, b -> ids, segments, attention for 10 positions
LAID_OUT = [
    ([10, 11], [20], [CLS, 10, 11, SEP, 20, SEP, PAD, PAD, PAD, PAD], [0, 0, 0, 0, 1, 1, 0, 0, 0, 0], [1, 1, 1, 1, 1, 1, 0, 0, 0, 0]),
    ([], [], [CLS, SEP, SEP] + [PAD] * 7, [0, 0, 1] + [0] * 7, [1, 1, 1] + [0] * 7),
    ([10, 11, 12, 13, 14, 15], [20, 21, 22, 23, 24], [CLS, 10, 11, 12, 13, SEP, 20, 21, 22, SEP], [0] * 6 + [1] * 4, [1] * 10),
    ([], [20, 21, 22, 23, 24, 25, 26, 27, 28], [CLS, SEP, 20, 21, 22, 23, 24, 25, 26, SEP], [0, 0] + [1] * 8, [1] * 10),
]


def laid_out(spark, rows, seq_len, special=None):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(rows)], "i int, a array<bigint>, b array<bigint>")
    na, nb = truncated_lengths(F.size("a"), F.size("b"), seq_len - 3)
    x = df.select("i", "a", "b", na.alias("na"), nb.alias("nb"))
    parts = assemble(F.col("a"), F.col("b"), F.col("na"), F.col("nb"), seq_len, special or SpecialIds())
    rows = x.select("i", "na", "nb", *[v.alias(k) for k, v in parts.items()]).orderBy("i").collect()
    return [(r.na, r.nb, list(r.input_ids), list(r.token_type_ids), list(r.attention_mask)) for r in rows]


def test_worked_layouts(spark):
    got = laid_out(spark, [(a, b) for a, b, *_ in LAID_OUT], 10)
    assert [g[2:] for g in got] == [tuple(want) for _, _, *want in LAID_OUT]


def test_layout_properties(spark):
    rng = random.Random(11)
    rows = [([rng.randint(5, 50) for _ in range(rng.randint(0, 20))], [rng.randint(5, 50) for _ in range(rng.randint(0, 20))]) for _ in range(300)]
    for (a, b), (na, nb, ids, seg, attn) in zip(rows, laid_out(spark, rows, 16), strict=True):
        assert len(ids) == len(seg) == len(attn) == 16
        marks = [i for i, t in enumerate(ids) if t == SEP]
        assert ids[0] == CLS and marks == [na + 1, na + nb + 2]
        assert ids[1 : marks[0]] == a[:na] and ids[marks[0] + 1 : marks[1]] == b[:nb]
        assert set(ids[marks[1] + 1 :]) <= {PAD}
        assert [i for i, s in enumerate(seg) if s] == list(range(marks[0] + 1, marks[1] + 1))
        assert [i for i, s in enumerate(attn) if s] == list(range(marks[1] + 1))


@pytest.mark.parametrize("special", [SpecialIds(unk=4, pad=0, cls=3, sep=1, mask=2)])
def test_special_ids_of_another_vocabulary(spark, special):
    (_, _, ids, _, _), = laid_out(spark, [([10], [20])], 7, special)
    assert ids == [3, 10, 1, 20, 1, 0, 0]

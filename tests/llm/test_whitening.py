import math
import random

import numpy as np
import pytest

from pairloom.llm import whitening


@pytest.fixture(scope="module")
def make_vectors(spark):
    def make(rows):
        return spark.createDataFrame([(i, v, 1, "t" * 5) for i, v in rows], "vec_id long, embedding array<float>, x int, text string").repartition(3)

    return make


def brute(rows, width, k=8, distinct=False):
    """Whitened values, deviations and shares by one matrix on one machine."""
    f32 = [[float(np.float32(c)) for c in v] + [0.0] * (width - len(v)) for _, v in rows]
    x = np.array([[math.floor(1024 * c) + 100000 for c in v] for v in f32], object)
    fit = np.array(sorted({tuple(r) for r in x.tolist()}), object) if distinct else x
    n, s = len(fit), fit.sum(0)
    dev = (((x * n) - s) ** 2).sum(1)
    centred = (fit * n - s).astype(float) / n
    cov = centred.T @ centred / n
    e, u = np.linalg.eigh(cov)
    order = [i for i in np.argsort(-e) if e[i] > 1e-9 * e.max()][:k]
    y = ((x * n) - s).astype(float) / n @ u[:, order] / np.sqrt(e[order])
    return n, dev, y, e[order] / np.trace(cov)


def check(out, rows, width, **options):
    n, dev, y, share = brute(rows, width, **options)
    got = out.collect()
    ids = [i for i, _ in rows]
    assert len(got) == y.shape[0] * y.shape[1]
    assert {r["n"] for r in got} == {n}
    by = {}
    for r in got:
        by.setdefault(r["vec_id"], {})[r["component"]] = r
        assert r["explained"] == pytest.approx(share[r["component"] - 1], rel=1e-9)
        assert r["identity_error"] < 1e-6
    signs = np.sign([y[0][c] * by[ids[0]][c + 1]["whitened"] for c in range(y.shape[1])])
    for at, i in enumerate(ids):
        for c in range(y.shape[1]):
            assert by[i][c + 1]["whitened"] * signs[c] == pytest.approx(y[at][c], abs=1e-7)
            assert int(by[i][c + 1]["deviation"]) == dev[at]


def vectors(n, width, seed):
    rng = random.Random(seed)
    return [[rng.gauss(0, 0.1 * (d + 1)) for d in range(width)] for _ in range(n)]


def test_matches_one_matrix(make_vectors):
    rows = list(enumerate(vectors(60, 12, 1)))
    check(whitening.whiten(make_vectors(rows)), rows, 12)


def test_copies_weigh_as_often_as_they_occur(make_vectors, monkeypatch):
    base = vectors(12, 5, 2)
    rows = list(enumerate(base + [base[0]] * 200 + [base[3]] * 40))
    check(whitening.whiten(make_vectors(rows), components=4), rows, 5, k=4)
    check(whitening.whiten(make_vectors(rows), components=4, weights="one"), rows, 5, k=4, distinct=True)
    monkeypatch.setattr(whitening, "HOT", 3)  # one group passes the bound, the others are shuffled
    check(whitening.whiten(make_vectors(rows), components=4), rows, 5, k=4)


def test_rows_without_finite_entries_are_dropped(make_vectors):
    rows = list(enumerate(vectors(30, 4, 3)))
    bad = [(90, None), (91, [1.0, None, 0.0, 0.0]), (92, [float("nan"), 0.0, 0.0, 0.0]), (93, [0.0, float("-inf"), 0.0, 0.0])]
    check(whitening.whiten(make_vectors(rows + bad), components=3), rows, 4, k=3)


def test_short_vectors_end_in_zeros(make_vectors):
    rows = list(enumerate(vectors(20, 4, 4) + [[0.5, 0.25], [], [0.5, 0.25, 0.0, 0.0]]))
    check(whitening.whiten(make_vectors(rows)), rows, 4)
    check(whitening.whiten(make_vectors(rows), weights="one"), rows, 4, distinct=True)


def test_large_entries_stay_exact(make_vectors):
    rows = list(enumerate([[c * 2.0**22 for c in v] for v in vectors(40, 4, 5)]))
    check(whitening.whiten(make_vectors(rows)), rows, 4)


def test_few_directions(make_vectors):
    line = [(i, [0.1 * i, 0.2 * i, 0.0]) for i in range(9)]
    assert {r["component"] for r in whitening.whiten(make_vectors(line)).collect()} >= {1}
    plane = [(i, [float(i % 3), float(i % 2), 7.0]) for i in range(12)]
    assert {r["component"] for r in whitening.whiten(make_vectors(plane)).collect()} == {1, 2}


def test_nothing_to_whiten(make_vectors):
    columns = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for rows in ([], [(1, None)], [(1, [0.5, 0.5])], [(1, [0.5]), (2, [0.5]), (None, [0.5])], [(1, []), (2, [])]):
        out = whitening.whiten(make_vectors(rows))
        assert out.columns == columns and out.collect() == []


def test_repeated_and_null_ids_keep_their_rows(make_vectors):
    rows = [(i, v) for i, v in enumerate(vectors(10, 3, 6))]
    out = whitening.whiten(make_vectors(rows + [(None, rows[0][1]), (3, rows[3][1]), (3, rows[4][1])]))
    assert out.count() == 13 * 3
    assert out.where("vec_id is null").count() == 3
    with pytest.raises(ValueError):
        whitening.whiten(make_vectors(rows), weights="two")

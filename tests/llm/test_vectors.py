import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom.llm import embedding_dups, hash_search


@pytest.fixture(scope="module")
def vectors(spark):
    def make(rows):
        return spark.createDataFrame([(i, v, l, 1, 2, 3) for i, v, l in rows], "vec_id long, embedding array<float>, label int, id int, k1 int, copies int").repartition(3)

    return make


def f32(x):
    return np.asarray(x, np.float32).tolist()


def data(n=400, d=16, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, d))
    rows = []
    for i in range(n):
        c = centres[i % 12]
        rows.append((i, f32(c + rng.normal(size=d) * (0.04, 0.12, 0.5)[i % 3]), i % 2))
    rows += [(1000, None, 0), (1001, f32([0] * d), 0), (1002, [float("nan")] + [1.0] * (d - 1), 0), (1003, [None] + [1.0] * (d - 1), 1),
             (1004, [float("inf")] + [1.0] * (d - 1), 1), (1005, rows[3][1], None), (None, rows[3][1], 1), (1006, [], 1), (3, rows[3][1], 1),
             (1007, rows[3][1], 1), (1008, f32(np.asarray(rows[3][1]) * 4), 1), (1009, rows[3][1][:5], 1), (1010, rows[5][1][:5], 1)]
    return rows


def valid(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)


def brute_links(rows, cosine):
    n = len(rows)
    links = np.zeros((n, n), bool)
    for a, (i, v, l) in enumerate(rows):
        for b, (j, w, m) in enumerate(rows):
            if a != b and i is not None and j is not None and l is not None and l == m and valid(v) and valid(w) and len(v) == len(w):
                x, y = np.asarray(v, np.float64), np.asarray(w, np.float64)
                links[a, b] = x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= cosine
    root = {i: i for i, _, _ in rows if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in np.argwhere(links):
        lo, hi = sorted((find(rows[a][0]), find(rows[b][0])))
        root[hi] = lo
    return sorted(((i, int(links[a].sum()), None if i is None else find(i)) for a, (i, _, _) in enumerate(rows)), key=str)


@pytest.mark.parametrize(("cell", "block"), [(2048, 2048), (20, 2048), (40, 7)])
def test_links_equal_brute_force(vectors, monkeypatch, cell, block):
    monkeypatch.setattr(embedding_dups, "CELL", cell)
    monkeypatch.setattr(embedding_dups, "BLOCK", block)
    rows = data()
    got = embedding_dups.near_duplicate_vectors(vectors(rows)).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str) == brute_links(rows, 0.98)
    assert all(r.kept == (r.vec_id is None or r.vec_id == r.component_id) for r in got)


def test_no_vectors(vectors):
    assert embedding_dups.near_duplicate_vectors(vectors([])).collect() == []
    assert embedding_dups.near_duplicate_vectors(vectors([(1, None, 1)])).collect()[0].n_links == 0
    assert hash_search.nearest(vectors([]), F.lit(True)).collect() == []
    assert hash_search.nearest(vectors([(1, [1.0], 1)]), F.lit(False)).collect() == []


def test_neighbours(vectors):
    rng = np.random.default_rng(5)
    rows = [(i, f32(rng.normal(size=16) * (1 + i % 5)), 0) for i in range(600)]
    rows += [(700, None, 0), (701, f32([0] * 16), 0), (702, rows[0][1], 0), (703, rows[0][1], 0), (None, rows[1][1], 0), (704, [float("nan")] * 16, 0), (705, [1.0], 0)]
    got = hash_search.nearest(vectors(rows), F.col("vec_id") % 20 == 0, k=20).collect()
    use = [(i, np.asarray(v, np.float64)) for i, v, _ in rows if i is not None and valid(v) and len(v) == 16]
    hits = total = 0
    for q, x in use:
        if q % 20:
            continue
        own = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [r for r, _, _ in own] == list(range(1, 21))
        assert [(i, s) for _, i, s in own] == sorted(((i, s) for _, i, s in own), key=lambda t: (-t[1], t[0]))
        want = sorted(((-float(x @ y), i) for i, y in use if i != q))[:20]
        exact = {i: float(x @ y) for i, y in use}
        assert all(abs(exact[i] - s) < 1e-9 for _, i, s in own)
        hits += len({i for _, i in want} & {i for _, i, _ in own})
        total += 20
    assert hits / total >= 0.9


def test_few_candidates_are_all_found(vectors):
    rng = np.random.default_rng(6)
    rows = [(i, f32(rng.normal(size=4)), 0) for i in range(5)]
    got = hash_search.nearest(vectors(rows), F.col("vec_id") == 0, k=20).collect()
    assert sorted(r.vec_id for r in got) == [1, 2, 3, 4]


def test_probing_retrieves_every_code_within_the_radius():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 256, (500, 8), dtype=np.uint8)
    codes[250:] = codes[:250] ^ (rng.random((250, 8)) < 0.3).astype(np.uint8)
    index = hash_search.Index(np.arange(500), np.zeros((500, 1)), codes)
    for radius in (0, 1, 5, 17, 28, 64):
        assert (index.retrieve(codes[:60], radius) == (hash_search.hamming(codes[:60], codes) <= radius)).all()

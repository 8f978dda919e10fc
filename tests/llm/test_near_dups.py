import random
import re

import numpy as np
import pytest

from pairloom.llm import near_dups
from pairloom.llm.common import utf8

WORDS = re.compile(r"[^\x20\x09-\x0d]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, k):
    w = WORDS.findall((text or "").translate(LOW))
    if len(w) < k:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def brute(rows, k, percent):
    sets = [(i, shingle_set(t, k)) for i, t, _ in rows]
    root = {i: i for i, _ in sets if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, x) in enumerate(sets):
        for j, y in sets[a + 1 :]:
            if i is not None and j is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
                lo, hi = sorted((find(i), find(j)))
                root[hi] = lo
    return sorted(((i, len(s), None if i is None else find(i)) for i, s in sets), key=str)


def edited(text, n, seed):
    rng = random.Random(seed)
    w = text.split(" ")
    for _ in range(n):
        w[rng.randrange(len(w))] = f"w{rng.randrange(10**6)}"
    return " ".join(w)


def corpus(prose):
    rows = [(i, prose(30 + i % 80, i), "s") for i in range(80)]
    rows += [(100 + i, edited(rows[i % 8][1], i % 7, i), "s") for i in range(90)]  # families about the limit
    rows += [(300, None, "s"), (301, "", "s"), (302, " \n", "s"), (303, "One two", "s"), (304, "one  TWO", "s"), (305, "one", "s"),
             (None, rows[0][1], "s"), (3, rows[3][1], "s"), (306, rows[3][1].upper().replace("É", "é"), None), (307, prose(20_000, 5), "s"), (308, edited(prose(20_000, 5), 300, 1), "s")]
    return rows


@pytest.mark.parametrize(("k", "percent"), [(3, 85), (5, 80)])
def test_groups_equal_brute_force(make_docs, prose, k, percent):
    rows = corpus(prose)
    got = near_dups.near_duplicates(make_docs(rows), percent=percent, k=k).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows, k, percent)
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got)


def test_a_large_group_is_compared_in_blocks(make_docs, prose, monkeypatch):
    base = prose(60, 1)
    rows = [(i, edited(base, i % 9, i), "s") for i in range(150)]
    plain = near_dups._confirmed
    monkeypatch.setattr(near_dups, "_confirmed", lambda m, s, p: plain(m, s, p, block=16))
    got = near_dups.near_duplicates(make_docs(rows), percent=80, k=5).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows, 5, 80)


def test_documents_kept(make_docs, prose):
    rows = corpus(prose)
    docs = make_docs(rows)
    out = near_dups.distinct_documents(docs)
    assert out.columns == docs.columns
    want = {i for i, _, c in brute(rows, 5, 80) if i is None or i == c}
    assert {r.doc_id for r in out.collect()} == want


def test_one_row_of_repeated_rows(make_docs, prose):
    a, b, c = prose(60, 1), prose(60, 2), prose(60, 3)
    rows = [(1, a, "s"), (1, a, "s"), (1, a, "s"), (2, edited(a, 1, 5), "s"), (3, b, "s"), (3, c, "s"), (4, c, "s"),
            (None, b, "s"), (None, b, "s"), (None, c + " end", "s"), (5, "", "s"), (5, "", "s"), (6, "", "s"), (None, "", "s"), (None, None, "s")]
    docs = make_docs(rows)
    out = [(r.doc_id, r.text) for r in near_dups.distinct_documents(docs).collect()]
    want = [(1, a), (3, b), (3, c), (None, b), (None, c + " end"), (5, ""), (6, ""), (None, ""), (None, None)]
    assert sorted(out, key=str) == sorted(want, key=str)
    linked = near_dups.distinct_documents(docs, link_null_ids=True)
    assert linked.columns == docs.columns
    want = [(1, a), (3, b), (3, c), (5, ""), (6, ""), (None, ""), (None, None)]
    assert sorted(((r.doc_id, r.text) for r in linked.collect()), key=str) == sorted(want, key=str)


def test_no_documents(make_docs):
    assert near_dups.near_duplicates(make_docs([])).collect() == []
    assert near_dups.near_duplicates(make_docs([(1, None, None)])).collect()[0].kept


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(0)
    t = 512
    for share in (0.3, 0.8):
        common = rng.integers(0, 1 << 63, int(400 * share), dtype=np.uint64)
        sets = [np.unique(np.r_[common, rng.integers(0, 1 << 63, 400 - len(common), dtype=np.uint64)]) for _ in range(2)]
        jaccard = len(np.intersect1d(*sets)) / len(np.union1d(*sets))
        s = near_dups.sketch(np.concatenate(sets), np.array([0, len(sets[0]), len(sets[0]) + len(sets[1])]), t)
        assert abs((s[0] == s[1]).mean() - jaccard) < 0.09
    one = near_dups.sketch(np.array([5], np.uint64), np.array([0, 1, 1]), 40)
    assert (one[0] != near_dups.EMPTY).all() and (one[1] == near_dups.EMPTY).all()


def test_bands_find_the_threshold():
    for s in (0.5, 0.8, 0.85, 0.95):
        b = near_dups.bands_for(s)
        assert b.size <= 160 and (1 - s**b.rows) ** b.count <= near_dups.MISS


def test_shingle_counts(prose):
    import pyarrow as pa

    texts = [prose(50, 1), None, "", "a b", "A  b\tc\x0bd", prose(300, 2)]
    data, offsets = utf8(pa.array(texts))
    values, offs = near_dups.shingles(data, offsets, 3)
    assert np.diff(offs).tolist() == [len(shingle_set(t, 3)) for t in texts]


def test_common_counts():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, rng.integers(0, 50)).astype(np.int64)) for _ in range(40)]
    offsets = np.r_[0, np.cumsum([len(s) for s in sets])]
    every = np.arange(40)
    got = near_dups.common_counts(np.concatenate(sets), offsets, every, every)
    for i in range(40):
        for j in range(40):
            if i != j:
                assert got[i, j] == len(np.intersect1d(sets[i], sets[j]))

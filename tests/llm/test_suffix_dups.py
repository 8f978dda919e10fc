import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom.llm import suffix_dups


def brute(rows, length):
    count = {}
    texts = [(t or "").encode() for _, t, _ in rows]
    for b in texts:
        for p in range(len(b) - length + 1):
            count[b[p : p + length]] = count.get(b[p : p + length], 0) + 1
    out = []
    for (i, _, _), b in zip(rows, texts, strict=True):
        mask = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if count[b[p : p + length]] > 1:
                mask[p : p + length] = b"\1" * length
        kept = bytes(c for c, m in zip(b, mask, strict=True) if not m)
        spans = sum(1 for k in range(len(b)) if mask[k] and (k == 0 or not mask[k - 1]))
        out.append((i, len(b), sum(mask), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(docs, length=200):
    out = suffix_dups.remove_repeats(docs, length)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["size"])
    rows = out.select("row.doc_id", "n_bytes", removed.alias("r"), F.size("spans").alias("n"), F.sha2("kept", 256).alias("h")).collect()
    return sorted(map(tuple, rows), key=str)


def corpus(prose):
    rng = random.Random(1)
    passages = [prose(60, 1000 + i) for i in range(6)]
    rows = []
    for i in range(60):
        parts = [prose(rng.randint(1, 60), i)]
        for _ in range(rng.randint(0, 2)):
            p = rng.choice(passages)
            a = rng.randint(0, 120)
            parts += [p[a : a + rng.choice((150, 199, 200, 201, 260, 999))], prose(rng.randint(0, 30), 77 * i)]
        rows.append((i, " ".join(parts), "s"))
    rows += [(100, rows[1][1], "s"), (101, None, "s"), (102, "", "s"), (103, "a" * 199, "s"), (104, "b" * 200, "s"), (105, "c" * 201, "s"),
             (106, "abc" * 400, "s"), (None, rows[2][1], None), (5, rows[5][1], "s"), (107, prose(15_000, 9) + passages[0] * 2, "s"), (7, "other text " + passages[1], "s")]
    return rows


def test_equals_brute_force(make_docs, prose):
    rows = corpus(prose)
    assert run(make_docs(rows)) == brute(rows, 200)


def test_an_anchor_with_very_many_contexts(make_docs, prose, monkeypatch):
    monkeypatch.setattr(suffix_dups, "BLOCK_SEGMENTS", 8)
    widths, marks = [], suffix_dups._window_marks

    def spy(segs, length, width):
        widths.append(width)
        return marks(segs, length, width)

    monkeypatch.setattr(suffix_dups, "_window_marks", spy)
    passage = prose(60, 5)
    rows = [(i, prose(20, i) + " " + passage + " " + prose(3 + i % 30, i // 3), "s") for i in range(80)]
    assert run(make_docs(rows)) == brute(rows, 200)
    # groups too large go on with narrower pieces
    assert widths[:2] == [77, 20]


def test_pieces_hold_each_window_once_with_bytes_that_all_share(spark):
    rng = random.Random(3)
    rows = []
    for k in range(40):
        anchor = rng.randint(0, 152)
        windows = rng.randint(1, anchor + 1)
        rows.append((k, k, 1, windows, anchor, bytearray(rng.randbytes(windows + 199))))
    segs = spark.createDataFrame(rows, "hash long, bytes long, copies long, windows int, anchor int, data binary")
    for width in (77, 20, 1):
        seen = {}
        for r in suffix_dups._pieces(segs, 200, width).collect():
            _, _, _, windows, anchor, data = rows[r.hash]
            assert r.anchor == anchor - r["skip"] and 1 <= r.windows <= width
            assert r.data == data[r["skip"] : r["skip"] + r.windows + 199]
            seen.setdefault(r.hash, []).extend(range(r["skip"], r["skip"] + r.windows))
        assert all(sorted(seen[k]) == list(range(w)) for k, _, _, w, _, _ in rows)


def test_identical_rows_are_one_text(make_docs, prose, monkeypatch):
    passage = prose(60, 5)
    text = prose(40, 1) + " " + passage + " " + prose(40, 2)
    rows = [(1, text, "s")] * 30 + [(None, text + "x", "s")] * 30 + [(1, "other " + passage, "s"), (2, prose(40, 3) + passage, "s"), (3, prose(40, 4), "s"), (3, None, "s")]
    runs, cut = [], []
    plain_spans, plain_cut = suffix_dups._repeated_spans, suffix_dups._cut_segments

    def spans(*args):
        runs.append(plain_spans(*args))
        return runs[-1]

    def cuts(*args):
        cut.append(plain_cut(*args))
        return cut[-1]

    monkeypatch.setattr(suffix_dups, "_repeated_spans", spans)
    monkeypatch.setattr(suffix_dups, "_cut_segments", cuts)
    assert run(make_docs(rows)) == brute(rows, 200)
    # a text has as many runs, and gives as many segments to the sort, as if it were there once
    assert all(len(r.spans) == len({(x.first, x.size) for x in r.spans}) for r in runs[0].collect() if r.spans)
    pieces = [(r.hash, r.bytes) for r in cut[0].collect()]
    assert pieces and len(pieces) == len(set(pieces))


def test_unique_ids_and_no_documents(make_docs, prose):
    rows = [(i, prose(50, i % 7), "s") for i in range(20)]
    assert run(make_docs(rows)) == brute(rows, 200)
    assert run(make_docs([])) == []


def test_texts(make_docs, prose):
    passage = "é" * 150
    rows = [(1, "start" + passage + "x", "s"), (2, "other" + passage, "s"), (3, None, "s"), (4, prose(5, 1), "s")]
    docs = make_docs(rows)
    out = suffix_dups.without_repeats(docs)
    assert out.columns == docs.columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: "startx", 2: "other", 3: None, 4: rows[3][1]}


@pytest.mark.parametrize("seed", range(6))
def test_deep_shallow_finds_equal_strings(seed):
    rng = np.random.default_rng(seed)
    length = 80
    data = rng.integers(97, 99 + seed, 4000).astype(np.uint8)
    for a, b in rng.integers(0, 3800, (30, 2)):
        n = int(rng.integers(40, 150))
        data[b : b + n] = data[a : a + n][: len(data[b : b + n])]
    at = np.arange(len(data) - length)
    group = at % 3
    padded = np.r_[data, np.zeros(8, np.uint8)]
    seen = {}
    for p in at.tolist():
        seen.setdefault((p % 3, data[p : p + length].tobytes()), []).append(p)
    want = np.zeros(len(at), bool)
    for ps in seen.values():
        want[ps] = len(ps) > 1
    order = rng.permutation(len(at))
    assert (suffix_dups.deep_shallow(padded, at[order], group[order], length) == want[order]).all()


def test_a_text_longer_than_a_slice(make_docs, prose, monkeypatch):
    monkeypatch.setattr(suffix_dups, "SLICE_BYTES", 3000)
    data = np.frombuffer((prose(2000, 1) + prose(300, 2) + prose(2000, 3) + prose(300, 2)).encode(), np.uint8)
    cut = [s for _, part, offs, _ in suffix_dups._parts(data, np.array([0, len(data)]), 200) for s in [suffix_dups.segments(part, offs, 200)]]
    assert sum(int(s["windows"].sum()) for s in cut) == len(data) - 199

import re
import struct
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from pairloom.llm import fingerprints as fp


def xx(seed, *values):
    """Spark's xxhash64 of strings, longs and ints, chained through the seed."""
    for v in values:
        data = v.encode() if isinstance(v, str) else struct.pack("<i", v[0]) if isinstance(v, tuple) else struct.pack("<q", v)
        seed = xxhash.xxh64(data, seed=seed & (2**64 - 1)).intdigest()
        seed -= (seed >> 63) << 64
    return seed


def low(value, bits=36):
    """The low bits, signed."""
    value &= (1 << bits) - 1
    return value - ((value >> (bits - 1)) << bits)


def brute(text):
    """Order MinHash by its definition: every permutation over all items."""
    pieces = [xx(42, w) for w in re.findall(r"[^\x20\x09-\x0D]{1,16}", text or "")]
    seen, items = Counter(), []
    for at, a in enumerate(pieces):
        kmer = low(xx(42, a, *pieces[at + 1 : at + 2]))
        items.append((kmer, seen[kmer], at))
        seen[kmer] += 1
    out = []
    for r in range(fp.ROUNDS):
        values = [(low(xx(42, h, (o,), (r,))), at) for h, o, at in items]
        for b in range(fp.BINS):
            start = (b - fp.BINS // 2) * (2**36 // fp.BINS)
            chosen = sorted(values, key=lambda v: ((v[0] - start) % 2**36, v[1]))[: fp.TUPLE]
            out.append(xx(42, *[v % 2**36 for v, _ in sorted(chosen, key=lambda v: v[1])]) >> 32)
    return out


def edited(texts):
    n = [len(t) // 2 for t in texts]
    return [t[: len(t) - h] + (texts[(i + 1) % len(texts)])[:h] for i, (t, h) in enumerate(zip(texts, n))]


def rows_of(make_docs, rows):
    return fp.fingerprints(make_docs([(i, t, "s") for i, t in rows])).collect()


TEXTS = ["", "a", "a b", "a a a a a a", "x " * 300, "é" * 100, " \n\t ", "one two three two one two three two one", "日本 語 " * 7]


def test_signatures_match_the_definition(spark, prose):
    texts = [None, *TEXTS, prose(80, 1), prose(700, 2), prose(30, 3) * 4]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").repartition(2)
    got = {r["i"]: r["sig"] for r in fp.with_signatures(df, {"text": "sig"}).collect()}
    for i, t in enumerate(texts):
        assert list(got[i]) == brute(t), repr(t)[:40]


def test_next_documents_and_likeness(make_docs, prose, monkeypatch):
    monkeypatch.setattr(fp, "BLOCK_ROWS", 2)
    ids = [*range(-9, 60, 2), 10**12, 10**12 + 1, -(2**63), 2**63 - 1]
    texts = {i: TEXTS[n] if n < len(TEXTS) else prose(5 + n * 3, n) for n, i in enumerate(ids)}
    order = sorted(ids, reverse=True)
    changed = edited([texts[i] for i in order])
    got = {r["doc_id"]: r for r in rows_of(make_docs, list(texts.items()))}
    assert len(got) == len(ids)
    for n, i in enumerate(order):
        r, nxt = got[i], texts[order[(n + 1) % len(order)]]
        mine, new, other = brute(texts[i]), brute(changed[n]), brute(nxt)
        assert r["n_chars"] == len(texts[i]) and r["edited"] == changed[n]
        assert list(r["signature"]) == mine and list(r["edited_signature"]) == new
        assert r["near_edited"] == sum(a == b for a, b in zip(mine, new)) / len(mine)
        assert r["near_next"] == sum(a == b for a, b in zip(mine, other)) / len(mine)


def test_repeated_rows_null_ids_and_null_texts(make_docs, prose, monkeypatch):
    monkeypatch.setattr(fp, "BLOCK_ROWS", 2)
    rows = [(7, prose(20, 1))] * 40 + [(None, prose(9, 2))] * 150 + [(None, None), (None, ""), (5, "five six"), (5, "seven eight nine")]
    got = rows_of(make_docs, rows)
    digest = {t: __import__("hashlib").md5((t or "").encode()).hexdigest() for _, t in rows}
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), digest[r[1]]))
    want = Counter(zip([i for i, _ in order], edited([t or "" for _, t in order])))
    assert Counter((r["doc_id"], r["edited"]) for r in got) == want


def test_one_document_and_none(make_docs):
    (r,) = rows_of(make_docs, [(3, "alone in the world")])
    assert r["edited"] == "alone in alone in" [:9] + "alone in " and r["near_next"] == 1.0
    assert rows_of(make_docs, []) == []
    assert rows_of(make_docs, [(None, None)])[0]["n_chars"] == 0


def test_edits_lower_the_likeness(spark, prose):
    words = prose(400, 5).split()
    swapped = words[200:] + words[:200]
    shuffled = sorted(words, key=lambda w: hash(w) % 97)
    texts = [" ".join(w) for w in (words, words[:390] + ["new"] * 10, swapped, shuffled)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    sig = {r["i"]: r["s"] for r in fp.with_signatures(df, {"text": "s"}).collect()}
    near = [sum(a == b for a, b in zip(sig[0], sig[i])) / len(sig[0]) for i in range(4)]
    assert near[0] == 1.0 and near[1] > 0.8 and near[1] > near[2] > near[3]


def test_very_long_text(spark):
    long = " ".join(f"w{i % 50021}" for i in range(400_000))
    df = spark.createDataFrame([(1, long), (2, long + " end")], "doc_id long, text string")
    out = fp.fingerprints(df).select("doc_id", "n_chars", "near_next").collect()
    assert all(r["near_next"] > 0.9 and r["n_chars"] >= len(long) for r in out)


@pytest.mark.parametrize("part", ["fingerprints", "signatures"])
def test_plan_has_no_python(make_docs, part):
    df = make_docs([(1, "a b", "s"), (2, "c", "s")])
    out = fp.fingerprints(df) if part == "fingerprints" else fp.with_signatures(df, {"text": "sig"})
    plan = out.select(F.struct("*"))._jdf.queryExecution().toString()
    assert not re.search(r"Python|Arrow|Pandas", plan)
    assert plan.split("== Physical Plan ==")[1].count("Exchange hashpartitioning") == (part == "fingerprints")

import re

from pyspark.sql import functions as F

from pairloom.llm import mixing

WORDS = re.compile(r"[^\x20\x09-\x0d]+")


def run(docs):
    out = mixing.mix(docs, mixing.word_count(F.col("text")), ["doc_id", "source"])
    return out.select("row.doc_id", "row.source", "size", "source_size", "target", "taken").collect()


def targets(sizes):
    """Water-filling by hand: raise all in steps of the smallest that is full."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        rest = [s for s in order if s not in full]
        level = (total - sum(2 * sizes[s] for s in full)) / max(1, sum(weight[s] for s in rest))
        more = {s for s in rest if weight[s] * level > 2 * sizes[s]}
        if not more:
            return {s: 2 * sizes[s] if s in full else weight[s] * level for s in order}
        full |= more


def test_targets_and_cuts(make_docs, prose):
    rows = [(i, prose(5 + i % 40, i), f"s{i % 7}" if i % 3 else "s0") for i in range(300)]
    rows += [(300, None, "s1"), (301, "", "s1"), (302, "one two", None), (None, "no id here", "s2"), (7, rows[7][1], rows[7][2]), (303, prose(20_000, 9), "s0")]
    got = run(make_docs(rows))
    assert len(got) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(WORDS.findall(t or ""))
    want = targets(sizes)
    for s in sizes:
        own = [r for r in got if r.source == s]
        assert {r.source_size for r in own} == {sizes[s]}
        assert abs(own[0].target - want[s]) < 1e-6 * max(1, want[s])
        assert sum(r.taken for r in own) == int(own[0].target)
    assert all(0 <= r.taken <= 2 * r.size for r in got)


def test_reruns_agree(make_docs, prose):
    rows = [(i, prose(10, i), f"s{i % 3}") for i in range(90)]
    docs = make_docs(rows)
    assert sorted(map(tuple, run(docs))) == sorted(map(tuple, run(docs.repartition(7))))


def test_documents_follow_the_mix(make_docs, prose):
    rows = [(i, "  " + prose(5 + i % 9, i) + "\n", f"s{i % 4}") for i in range(80)]
    docs = make_docs(rows)
    taken = {r.doc_id: r.taken for r in run(docs)}
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    words = {}
    text = {i: t for i, t, _ in rows}
    for r in out.collect():
        assert text[r.doc_id].startswith(r.text)
        words[r.doc_id] = words.get(r.doc_id, 0) + len(WORDS.findall(r.text))
    assert words == {i: n for i, n in taken.items() if n}


def test_empty_and_wordless(make_docs):
    assert run(make_docs([])) == []
    assert [(r.target, r.taken) for r in run(make_docs([(1, None, "a"), (2, " ", None)]))] == [(0.0, 0), (0.0, 0)]

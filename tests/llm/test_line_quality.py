import itertools
import zlib

import numpy as np

from pairloom.llm import line_quality as lq


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    sizes = [1, 4, 2, 5]
    row = np.repeat(np.arange(4), sizes)
    score, transition = rng.normal(size=12), rng.normal(size=(2, 2))
    got, pairs, log_z = lq.marginals(score, row, transition)
    want, want_pairs, want_z, at = [], np.zeros((2, 2)), 0.0, 0
    for n in sizes:
        total, good, steps = 0.0, np.zeros(n), np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=n):
            w = np.exp(sum(score[at + i] * y[i] for i in range(n)) + sum(transition[a, b] for a, b in zip(y, y[1:], strict=False)))
            total += w
            good += w * np.array(y)
            for a, b in zip(y, y[1:], strict=False):
                steps[a, b] += w
        want += list(good / total)
        want_pairs += steps / total
        want_z += np.log(total)
        at += n
    assert np.allclose(got, want) and np.allclose(pairs, want_pairs) and np.isclose(log_z, want_z)


def table(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def junk(text, k):
    return (text.upper().replace(" ", "!! "), text.replace(" ", "$$$ "), text.replace(" ", " | "), " ".join(w for x in text.split() for w in [x] * 9))[k % 4]


def test_held_out_accuracy_and_odd_texts(spark, make_docs, prose):
    lines = lambda i: "\n".join(prose(8 + i % 9, 100 * i + j).capitalize() + "." for j in range(1 + i % 6))
    rows = [(i, lines(i) if i % 4 else junk(lines(i), i // 4), "s") for i in range(400)]
    odd = [(900, None, "s"), (901, "", "s"), (902, "\n\n", "s"), (None, lines(3), None), (1, rows[1][1], "s"), (903, prose(20_000, 3), "s"), (904, "\n".join(["x y"] * 3000), "s")]
    docs = make_docs(rows + odd)
    labels = table(spark, [(i, int(i % 4 > 0), 0) for i in range(400)] + [(None, 1, 0), (500, None, 0), (7, 0, 0), (7, 1, 0)], "doc_id long, quality int, toxic int")
    model = lq.train(docs, labels)
    got = lq.score(docs, model).collect()
    assert len(got) == len(rows) + len(odd) and all(0 <= r.score <= 1 for r in got)
    by_id = {r.doc_id: r.score for r in got}
    out = [i for i in range(400) if zlib.crc32(str(i).encode()) % 3 == 1]
    right = sum((by_id[i] >= 0.5) == (i % 4 > 0) for i in out)
    assert len(out) > 80 and right / len(out) >= 0.95
    assert by_id[900] == by_id[901] == by_id[902] == model.empty
    kept = lq.accepted(docs, model)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in got if r.score >= 0.5)


def test_training_ignores_the_held_out_fold(spark, make_docs, prose):
    docs = make_docs([(i, prose(10, i), "s") for i in range(60)])
    right = [(i, int(i % 2), 0) for i in range(60)]
    wrong = [(i, 1 - q if zlib.crc32(str(i).encode()) % 3 == 1 else q, t) for i, q, t in right]
    models = [lq.train(docs, table(spark, rows, "doc_id long, quality int, toxic int")) for rows in (right, wrong)]
    assert (models[0].emission == models[1].emission).all()


def test_without_labels_or_documents(spark, make_docs):
    labels = table(spark, [], "doc_id long, quality int, toxic int")
    model = lq.train(make_docs([(1, "a b", "s")]), labels)
    assert lq.score(make_docs([(1, "a b", "s")]), model).collect()[0].score == 0.5
    assert lq.score(make_docs([]), model).collect() == []


def test_features_see_neighbours():
    data = np.frombuffer("ab|cd\nplain line\n\nWORD word word".encode(), np.uint8)
    x, row, size = lq.line_features(data, np.array([0, len(data)]))
    at = lq.FEATURES.index
    assert size.tolist() == [5, 10, 14] and row.tolist() == [0, 0, 0]
    assert x[1, at("before: bar")] == x[0, at("bar")] > 0 and x[0, at("after: bar")] == 0
    assert x[:, at("first")].tolist() == [1, 0, 0] and x[:, at("last")].tolist() == [0, 0, 1]
    assert np.isclose(x[2, at("repeated words")], 1 / 3)


def test_long_documents_and_repeated_ids_are_in_the_sample(spark, monkeypatch):
    good, bad = "A plain line of words, as people write.", "$$$ BUY NOW!!! ||| ### !!!"
    rows = [(i, "\n".join([good if i % 2 else bad] * 500)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    model = lq.train(docs, labels)
    got = {r.doc_id: r.score for r in lq.score(docs, model).collect()}
    assert all((got[i] >= 0.5) == bool(i % 2) for i in range(60))
    fitted = []
    monkeypatch.setattr(lq, "fit", lambda x, row, size, label: fitted.append(label.tolist()))
    lq.train(docs.union(spark.createDataFrame(rows[:6] * 40, docs.schema)), labels)
    lq.train(docs, labels)
    assert len(fitted[0]) == len(fitted[1]) and sorted(fitted[0]) == sorted(fitted[1])

"""The pipeline, stage by stage, against brute force on a small corpus."""

import random

import numpy as np
import public_tokenizers
import pytest
from test_mixing import WORDS, targets
from test_near_dups import brute as near_groups
from test_near_dups import edited
from test_suffix_dups import brute as repeats
from tokenizers import Tokenizer

import corpus_pipeline
from pairloom.llm import line_quality


def junk(text, k):
    return (text.upper().replace(" ", "!! "), text.replace(" ", "$$$ "), " ".join(w for x in text.split() for w in [x] * 9))[k % 3]


@pytest.fixture(scope="module")
def sf_dir(spark, prose, tmp_path_factory):
    rng = random.Random(4)
    passage = prose(70, 999)
    rows = []
    for i in range(150):
        text = "\n".join(prose(rng.randint(6, 20), 50 * i + j).capitalize() + "." for j in range(rng.randint(1, 6)))
        if i % 9 == 4:
            text += "\n" + passage
        rows.append((i, junk(text, i) if i % 5 == 2 else text, "en", f"s{i % 4}" if i % 2 else "s0", len(text)))
    rows += [(200 + i, edited(rows[i][1], 1, i), "en", "s1", 0) for i in (0, 1, 3, 5)]
    rows += [(300, None, None, None, None), (301, "", "en", "s1", 0), (302, rows[3][1], "en", None, 0)]
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 5 != 2), 0) for i in range(150)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def by_id(df):
    return sorted(((r.doc_id, r.text, r.source) for r in df.collect()), key=lambda r: (r[0], r[1] or ""))


def test_stages_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_duplicates", "repeated_passages", "mix", "token_ids"]

    good = stages["quality"](spark, docs, sf_dir)
    model = line_quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    kept = {r.doc_id for r in line_quality.score(docs, model).collect() if r.score >= 0.5}
    assert good.columns == docs.columns and {r.doc_id for r in good.collect()} == kept
    clean = {i for i in range(150) if i % 5 != 2}
    assert len(kept & clean) >= 0.95 * len(clean) and len(kept - clean - set(range(200, 400))) <= 3
    good = good.cache()
    rows = by_id(good)

    unique = stages["near_duplicates"](spark, good, sf_dir)
    groups = near_groups(rows, 5, 80)
    assert unique.columns == docs.columns
    unique = unique.cache()
    assert {r.doc_id for r in unique.collect()} == {i for i, _, c in groups if i == c}
    rows = by_id(unique)

    fresh = stages["repeated_passages"](spark, unique, sf_dir).cache()
    assert fresh.columns == docs.columns
    want = {i: (n, removed) for i, n, removed, _, _ in repeats(rows, 200)}
    for r in fresh.collect():
        n, removed = want[r.doc_id]
        assert len((r.text or "").encode()) <= n - removed and (removed or dict((i, t) for i, t, _ in rows)[r.doc_id] == r.text)
        assert r.n_chars == (None if r.text is None else len(r.text))
    assert any(removed for _, removed in want.values())
    rows = by_id(fresh)

    mixed = stages["mix"](spark, fresh, sf_dir).cache()
    assert mixed.columns == docs.columns
    sizes, taken = {}, {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(WORDS.findall(t or ""))
    for _, t, s in by_id(mixed):
        taken[s] = taken.get(s, 0) + len(WORDS.findall(t))
    assert {s: n for s, n in taken.items() if n} == {s: int(t) for s, t in targets(sizes).items() if int(t)}

    out = stages["token_ids"](spark, mixed, sf_dir).collect()
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = sorted((i, library.encode(t, add_special_tokens=False).ids) for i, t, _ in by_id(mixed))
    assert sorted((r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in out) == ids
    assert all(r.n_tokens == len(r.ids) // 4 for r in out)


def test_run_is_the_stages_in_a_row(spark, sf_dir):
    first = corpus_pipeline.run(spark, sf_dir)
    again = corpus_pipeline.run(spark, sf_dir)
    rows = sorted((r.doc_id, r.n_tokens, bytes(r.ids)) for r in first.collect())
    assert rows and rows == sorted((r.doc_id, r.n_tokens, bytes(r.ids)) for r in again.collect())


def test_repeated_rows_pass_the_stages_once(spark, prose):
    a, b, c = (prose(80, i) for i in (1, 2, 3))
    rows = [(1, a), (1, a), (2, b), (None, b), (None, c), (None, c), (3, prose(80, 4))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    stages = dict(corpus_pipeline.STAGES)
    unique = stages["near_duplicates"](spark, docs, "").cache()
    fresh = stages["repeated_passages"](spark, unique, "").cache()
    want = sorted([(1, a), (2, b), (None, c), (3, rows[-1][1])], key=str)
    assert sorted(((r.doc_id, r.text) for r in unique.collect()), key=str) == want
    assert sorted(((r.doc_id, r.text) for r in fresh.collect()), key=str) == want
    mixed = stages["mix"](spark, fresh, "").collect()
    assert {r.text for r in mixed} >= {a, b, c}


def test_token_ids_are_decoded(spark, prose):
    docs = spark.createDataFrame([(1, prose(20, 1)), (2, ""), (3, None)], "doc_id long, text string")
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = {r.doc_id: r for r in dict(corpus_pipeline.STAGES)["token_ids"](spark, docs, "").collect()}
    for r in got.values():
        assert r.decoded == library.decode(np.frombuffer(r.ids, "<u4").tolist(), skip_special_tokens=False)
    assert got[1].decoded and got[2].decoded == got[3].decoded == ""

"""What ``mlm_long`` does for every sentence and example is done once, on no more than it needs."""

import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pairloom import DEFAULT, Preparation
from pairloom.functions.text import STRIP_CHARS
from pairloom.functions.word_split import code_point_classes, splitter
from pairloom.operators.corpus import _flagged, sentence_lines
from pairloom.operators.examples import EXAMPLE_COLUMNS, assemble_examples
from pairloom.operators.pairs import attach_tokens, nsp_pairs
from pairloom.operators.scan import Buckets
from pairloom.operators.vocab import lookup_ids


def corpus(spark):
    """Documents of one to seven sentences, short and longer than an example, with empty ones."""
    words = "ab cd ef gh ij kl mn op qr st uv wx yz".split()
    rows = []
    for d in range(40):
        rows += [f" = title {d} = ", ""]
        rows += [" ".join(words[(d * k + i) % 13] for i in range(2 + (d * 37 + k * 53) % 170)) + "  " for k in range(1 + d % 7)]
        rows += ["..." if d % 5 == 0 else "", "[MASK] left"]
    return spark.createDataFrame(list(enumerate(rows)), "row_id long, text string").repartition(3)


@pytest.fixture
def prep(spark):
    with Preparation(corpus(spark), DEFAULT) as p:
        yield p


def stored(p, name):
    path = p.stages.path.removeprefix("file:")
    (folder,) = [d for d in os.listdir(path) if d.rsplit("-", 1)[0] == name]
    return p.rows.sparkSession.read.parquet(f"{p.stages.path}/{folder}")


def test_stored_examples_hold_no_padding(prep):
    p = prep
    ex = p.examples
    kept = stored(p, "examples")
    assert kept.columns == ["example_id", "doc_idx", "is_next", "ids", "ids_b", "n_a", "n_b"]
    assert kept.where((F.size("ids") != F.col("n_a")) | (F.size("ids_b") != F.col("n_b")) | (F.col("n_a") + F.col("n_b") > 125)).count() == 0
    pairs = p.pairs.select("example_id", "doc_idx", "is_next", "bucket", "b_id", "b_bucket")
    want = assemble_examples(attach_tokens(pairs, p.sentence_tokens, p.n_buckets), p.cfg, special=p.special)
    assert ex.columns == want.columns == EXAMPLE_COLUMNS
    got = sorted(ex.collect())
    assert got == sorted(want.collect()) and len(got) == p.n_examples
    assert all(len(r[c]) == 128 for r in got for c in ("input_ids", "token_type_ids", "attention_mask"))
    assert len({r["n_a"] + r["n_b"] == 125 for r in got}) == 2  # cut ones and whole ones


def test_tokens_need_no_scan_over_the_text(prep, monkeypatch):
    p = prep
    monkeypatch.setattr(Preparation, "sentences", property(lambda self: pytest.fail("text went through the scan")))
    found = {r["row_id"]: r for r in p.sentence_tokens.collect()}
    monkeypatch.undo()
    want = lookup_ids(p.sentences, p.vocab, ["bucket", "row_id"], max_tokens=p.cfg.pair_budget, special=p.special).collect()
    assert want and all(found[r["row_id"]]["ids"] == r["ids"] and found[r["row_id"]]["bucket"] == r["bucket"] for r in want)
    lines = sentence_lines(p.rows, p.buckets)
    assert sorted(r["row_id"] for r in lines.collect()) == sorted(found) == sorted(r["row_id"] for r in p.flags.where("_b = 0").collect())


def test_partners_are_not_drawn_to_test_them_for_null(prep):
    p = prep
    plan = nsp_pairs(p.index, p.documents, p.n_documents, p.cfg)._jdf.queryExecution().optimizedPlan().toString()
    assert "md5(" in plan and not [x for x in plan.splitlines() if "Filter" in x and "md5(" in x]


def test_literals_and_wide_characters_at_the_edges_of_texts(spark):
    texts = ["[MA", "SK]", "a[MASK", "]é", "日[MASK]本", "", "é", "🙂[MASK]", "[SEP]"]
    words, counts = splitter(code_point_classes(spark), ("[MASK]", "[SEP]", "[CLS]"))(pa.array(texts))
    assert words.to_pylist() == ["[", "MA", "SK", "]", "a", "[", "MASK", "]", "é", "日", "[MASK]", "本", "é", "🙂", "[MASK]", "[SEP]"]
    assert counts.tolist() == [2, 2, 3, 2, 3, 0, 1, 2, 1]


@pytest.mark.parametrize("marked", [None, "is_start"])
def test_boundaries_are_told_without_stripping_the_end(spark, marked):
    edges = [c for c in STRIP_CHARS] + ["", "\u200b", "=", "a", "é"]
    texts = [a + m + b for a in edges for m in ("", "=", "x", " = x") for b in ("", " ", "\x1c\u3000", "=")]
    rows = spark.createDataFrame([(i, t, i % 3 == 0) for i, t in enumerate(texts)], "row_id long, text string, is_start boolean")
    flags = _flagged(rows, marked, text=False)
    assert "btrim" not in flags._jdf.queryExecution().optimizedPlan().toString()
    want = {i: (t.strip(STRIP_CHARS) == "" or (t.strip(STRIP_CHARS).startswith("=") if marked is None else i % 3 == 0)) for i, t in enumerate(texts)}
    assert {r["row_id"]: r["_b"] == 1 for r in flags.collect()} == want
    lines = sentence_lines(rows, Buckets(4, (), 99), marked)
    assert {r["row_id"]: r["text"] for r in lines.collect()} == {i: t.strip(STRIP_CHARS) for i, t in enumerate(texts) if not want[i]}
    for k in (0, 1):
        with pytest.raises(Exception, match="text must not be NULL"):
            sentence_lines(rows.select("row_id", F.when(F.col("row_id") != k, F.col("text")).alias("text"), "is_start"), Buckets(4, (), 99), marked).collect()

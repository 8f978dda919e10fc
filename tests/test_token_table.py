"""Vocabulary lookup by constant arrays against the join."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom import DEFAULT
from pairloom.config import SpecialIds
from pairloom.functions.token_table import TokenTable, displace, token_table
from pairloom.operators.vocab import lookup_ids

SPECIAL = SpecialIds()


def vocab_of(spark, words):
    return spark.createDataFrame([(w, i, 1) for i, w in enumerate(words)], "token string, id long, n long")


def test_no_two_hashes_share_a_slot():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 10, 500, 30_000):
        h = rng.integers(-(2**63), 2**63 - 1, n)
        table = TokenTable([str(i) for i in range(n)], list(range(n)), h.tolist())
        assert sorted(t for t in table.tokens if t) == sorted(map(str, range(n)))
        assert len(table.tokens) == table.slots <= (1.05 * n + 30 if n > 400 else 10 * n + 10)
    with pytest.raises(ValueError):
        displace(np.array([5, 5]))


def test_same_ids_as_the_join(spark):
    rng = random.Random(3)
    words = ["[UNK]", "[PAD]", "[CLS]", "[SEP]", "[MASK]"] + [f"w{i}é" for i in range(300)] + ["\n", ",", "\\E", "a,b", "日本"]
    vocab = vocab_of(spark, words)
    texts = [" ".join(rng.choice(words[5:305] + ["new", "日本", ","]) for _ in range(rng.randint(0, 30))) for _ in range(200)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, "", None])], "row_id long, text string")
    split = lambda c: F.filter(F.split(c, " "), lambda w: w != "")
    kw = dict(key_cols=["row_id"], split_fn=split, special=SPECIAL)
    here = lookup_ids(rows, vocab, cfg=DEFAULT, **kw)
    joined = lookup_ids(rows, vocab, cfg=DEFAULT.with_(broadcast_max_rows=1), **kw)
    key = lambda r: r["row_id"]
    assert sorted(here.collect(), key=key) == sorted(joined.collect(), key=key)
    cut = lookup_ids(rows, vocab, cfg=DEFAULT, max_tokens=3, **kw).collect()
    assert max(len(r["ids"]) for r in cut) == 3


def test_plan_has_no_join_generate_or_aggregate(spark):
    vocab = vocab_of(spark, [*"abcdefgh"])
    rows = spark.createDataFrame([(1, "a b z")], "row_id long, text string")
    plan = lookup_ids(rows, vocab, ["row_id"], special=SPECIAL)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Join", "Generate", "Aggregate", "Exchange"))


def test_sizes_and_odd_vocabularies(spark):
    assert token_table(vocab_of(spark, [*"abc"]), max_tokens=2) is None
    assert token_table(vocab_of(spark, [*"abc"]), max_bytes=20) is None
    assert token_table(vocab_of(spark, [])) is None
    assert token_table(vocab_of(spark, ["\n\x00\x01\x02\x1f", "b"])) is None
    with pytest.raises(ValueError):
        token_table(vocab_of(spark, ["a", "a"]))

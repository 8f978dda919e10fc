"""Selection of the k smallest digests against sorting."""

import hashlib

import pytest
from pyspark.sql import functions as F

from pairloom.functions.hashing import digest
from pairloom.operators import scan
from pairloom.operators.batches import label_examples, split_examples


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(("rows", "digits"), [(4096, 3), (5, 1), (1, 2)])
def test_the_k_smallest(spark, monkeypatch, rows, digits):
    monkeypatch.setattr(scan, "SELECT_ROWS", rows)
    monkeypatch.setattr(scan, "SELECT_DIGITS", digits)
    n = 700
    df = spark.range(n).select(F.col("id").alias("example_id")).repartition(3)
    order = digest(42, "split", F.col("example_id"))
    want = sorted(range(n), key=lambda i: (hashlib.md5(f"42|split|{i}".encode()).hexdigest(), i))
    for k in (0, 1, 2, 69, 350, n - 1, n, n + 5):
        got = df.where(scan.among_smallest(df, order, "example_id", k, n)).collect()
        assert sorted(r[0] for r in got) == sorted(want[:k])


def test_equal_digests_go_by_the_tie(spark, monkeypatch):
    monkeypatch.setattr(scan, "SELECT_ROWS", 2)
    df = spark.range(50).select((F.col("id") * 7 % 50).alias("i"))
    same = F.md5(F.concat(F.lit("x"), (F.col("i") * 0).cast("string")))
    got = df.where(scan.among_smallest(df, same, "i", 20, 50)).collect()
    assert sorted(r[0] for r in got) == list(range(20))


def test_labels_equal_the_ranked_split_and_nothing_is_sorted(spark):
    df = spark.range(9_000).select((F.col("id") * 3).alias("example_id"))
    labels = label_examples(df, 9_000)
    ranked = split_examples(df, 9_000).select("example_id", "split")
    assert labels.exceptAll(ranked).count() == 0 and labels.count() == 9_000
    assert not any(x in plan_text(labels) for x in ("Sort", "Exchange", "Window", "Join"))

"""Counts kept by file against counts of everything."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from pairloom import DEFAULT
from pairloom.sources.vocab_counts import VocabCounts
from pairloom.sources.vocab_store import StaleVocabularyError


def put(spark, base, name, texts):
    spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1).write.mode("overwrite").parquet(f"{base}/{name}")


def test_updates_equal_a_full_count(spark, tmp_path):
    base = str(tmp_path / "the corpus+1")
    now = {"a": ["x y\ny z", ""], "b": ["x x", "q"], "c": ["only here"]}

    def check(files_read):
        counts = VocabCounts(spark, str(tmp_path / "counts"), F.split("text", "\n"))
        got = {r.token: r.n for r in counts.update(base).collect()}
        want = Counter(w for texts in now.values() for t in texts for w in t.split())
        assert got == dict(want)
        assert len(counts.files_read) == files_read
        return counts

    for name, texts in now.items():
        put(spark, base, name, texts)
    check(3)
    check(0)
    now["b"], now["d"] = ["x q q new", "y"], ["z z"]
    put(spark, base, "b", now["b"])
    put(spark, base, "d", now["d"])
    check(2)
    now["c"] = []
    put(spark, base, "c", [])
    check(1)
    # a file changed again: its counts lie in a later generation
    now["b"] = ["back"]
    put(spark, base, "b", now["b"])
    counts = check(1)
    words = [(r.token, r.id) for r in counts.vocab(base).collect()]
    want = Counter(w for texts in now.values() for t in texts for w in t.split())
    common = sorted(((t, n) for t, n in want.items() if n > 1), key=lambda x: (-x[1], x[0]))
    assert words[5:] == [(t, i + 5) for i, (t, _) in enumerate(common)]
    with pytest.raises(StaleVocabularyError):
        VocabCounts(spark, str(tmp_path / "counts"), F.split("text", "\n"), DEFAULT.with_(min_frequency=1)).update(base)

"""Vocabulary selection against a brute-force ranking, for caps that cut
through runs of equal counts."""

from collections import Counter

from paths import SF_SMALL
from pairloom import DEFAULT
from pairloom.operators.corpus import clean_lines
from pairloom.operators.vocab import build_vocab, count_threshold, token_counts
from pairloom.sources.corpus import documents_corpus, table


def test_vocab_top_k_matches_brute_force(spark):
    counts = token_counts(clean_lines(documents_corpus(table(spark, SF_SMALL, "documents"))))
    rows = [(r.token, r.n) for r in counts.collect()]
    for cap in (6, 12, 50, 400, 100000):
        cfg = DEFAULT.with_(vocab_size=cap)
        got = [(r.token, r.id, r.n) for r in build_vocab(counts, cfg).orderBy("id").collect()]
        words = sorted([(t, n) for t, n in rows if n >= 2], key=lambda x: (-x[1], x[0].encode()))
        want = [(t, i, 0) for i, t in enumerate(DEFAULT.special_tokens)]
        want += [(t, i + 5, n) for i, (t, n) in enumerate(words[: cap - 5])]
        assert got == want, cap


def test_count_threshold(spark):
    df = spark.createDataFrame([("a", 9), ("b", 7), ("c", 7), ("d", 7), ("e", 2)], "token string, n bigint")
    assert count_threshold(df, 1) == 9
    assert count_threshold(df, 2) == 7
    assert count_threshold(df, 4) == 7
    assert count_threshold(df, 5) == 2
    assert count_threshold(df, 6) is None

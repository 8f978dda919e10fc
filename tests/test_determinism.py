"""Same output whatever the shuffle partitioning (which also changes the
bucket widths of the scans), and one huge document across many buckets."""

from pyspark.sql import functions as F

from paths import SF_SMALL
from pairloom import Preparation
from pairloom.operators.corpus import segment_documents
from pairloom.operators.scan import Buckets
from pairloom.sources.corpus import documents_corpus, table


def _fingerprint(p):
    m = p.masked(0)
    return sorted(
        (r.example_id, r.is_next, tuple(r.input_ids), tuple(r.labels))
        for r in m.select("example_id", "is_next", "input_ids", "labels").collect()
    )


def test_examples_independent_of_shuffle_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        results = []
        for parts in ("1", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            p = Preparation(documents_corpus(table(spark, SF_SMALL, "documents")))
            results.append((_fingerprint(p), sorted(tuple(r) for r in p.split.collect())))
        assert results[0] == results[1]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_one_huge_document_across_buckets(spark):
    lines = ["= T ="] + [f"line {i}" for i in range(600)] + ["", "a", "b", "", "c"]
    df = spark.createDataFrame(list(enumerate(lines)), "row_id bigint, text string")
    out = segment_documents(df, buckets=Buckets(3, (), (len(lines) >> 3) + 1))
    rows = out.orderBy("row_id").collect()
    big = [r for r in rows if r.n_sents == 600]
    assert [r.sent_idx for r in big] == list(range(600))
    assert len({r.bucket for r in big}) == (600 >> 3) + 1  # rows 1..600 span buckets 0..75
    assert [(r.text, r.sent_idx, r.n_sents) for r in rows if r.n_sents == 2] == [("a", 0, 2), ("b", 1, 2)]
    assert not any(r.text == "c" for r in rows)

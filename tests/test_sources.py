"""Corpus scan order, vocabulary cache, example and scalar sinks, streaming log."""

import os
import tempfile

import pyarrow.parquet as pq
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from paths import SF_SMALL
from pairloom.operators.corpus import clean_lines
from pairloom.operators.metrics import epoch_averages
from pairloom.sources.corpus import conversations_corpus, documents_corpus, read_corpus, scalar_fixture, table
from pairloom.sources.sinks import append_scalars, epoch_examples, read_epoch, read_scalars, write_examples
from pairloom.sources.vocab_store import StaleVocabularyError, get_or_build_vocab
from pairloom.streaming.scalar_log import epoch_average_stream, read_epoch_averages


def test_read_corpus_keeps_file_order(spark):
    path = f"{SF_SMALL}/documents.parquet"
    rows = read_corpus(spark, path).orderBy("row_id").collect()
    texts = pq.read_table(path, columns=["text"]).column("text").to_pylist()
    assert [r.row_id for r in rows] == list(range(len(texts)))
    assert [r.text for r in rows] == texts


def test_vocab_cache_builds_reuses_and_refuses_stale(spark):
    root = tempfile.mkdtemp(prefix="vocab-cache-")
    lines = clean_lines(documents_corpus(table(spark, SF_SMALL, "documents")))
    v1 = get_or_build_vocab(lines, root)
    v2 = get_or_build_vocab(lines, root)
    assert v1.count() == v2.count()
    assert v1.exceptAll(v2).count() == 0
    other = lines.filter(F.col("row_id") % 2 == 0)
    with pytest.raises(StaleVocabularyError):
        get_or_build_vocab(other, root)
    with pytest.raises(StaleVocabularyError):
        get_or_build_vocab(lines, root, split_fn=lambda c: F.split(c, " "), split_name="spaces")


def test_vocab_cache_survives_a_build_that_stopped(spark, monkeypatch):
    from pairloom.sources import vocab_store

    root = tempfile.mkdtemp(prefix="vocab-cache-")
    lines = clean_lines(documents_corpus(table(spark, SF_SMALL, "documents")))

    def stop(counts, cfg):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(vocab_store, "build_vocab", stop)
        with pytest.raises(RuntimeError):
            get_or_build_vocab(lines, root)
    assert get_or_build_vocab(lines, root).count() > 5


def test_documents_of_any_length_keep_every_row(spark):
    long = "x\n" * 1_100_000
    docs = spark.createDataFrame([(1, long, "s"), (2, "a\nb", "s"), (1 << 61, "c", "t")], "doc_id long, text string, source string")
    r = documents_corpus(docs).agg(F.count("*").alias("n"), F.countDistinct("row_id").alias("d"), F.max("row_id").alias("m")).first()
    assert r.n == r.d == r.m + 1 == (1_100_001 + 220_000 + 2) + 4 + 3


@pytest.mark.parametrize("row", [(1, "a", "s"), (None, "a", "s"), (7, None, "s"), (7, "a", None)])
def test_documents_that_repeat_or_miss_something_raise(spark, row):
    docs = spark.createDataFrame([(1, "x", "s"), (2, "y", "s"), row], "doc_id long, text string, source string")
    with pytest.raises((PySparkException, ValueError)):
        documents_corpus(docs).collect()


def test_conversations_of_any_length(spark):
    rows = [(1, 0, "a"), (1, (1 << 20) + 5, "z"), (2, 0, "b"), (2, 1, "c")]
    got = conversations_corpus(spark.createDataFrame(rows, "conv_id long, turn int, text string")).orderBy("row_id").collect()
    assert [r.text for r in got] == ["", "a", "z", "", "b", "c"] and len({r.row_id for r in got}) == 6
    with pytest.raises(ValueError):
        conversations_corpus(spark.createDataFrame([(1 << 60, 0, "a")], "conv_id long, turn int, text string"))


def test_batches_lie_in_one_file(prep_small):
    p = prep_small
    out = os.path.join(tempfile.mkdtemp(prefix="examples-"), "out")
    write_examples(epoch_examples(p.batches(0, 1), p.examples, p.vocab_size, p.cfg, p.special), out)
    rows = p.examples.sparkSession.read.parquet(out).withColumn("f", F.input_file_name())
    rows = rows.groupBy("split", "epoch", "batch_id").agg(F.countDistinct("f").alias("files"))
    spread = [r.files for r in rows.collect()]
    parts = int(p.examples.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    assert max(spread) <= 2 and sum(f == 2 for f in spread) < parts


def test_stages_are_deleted_on_close(spark):
    from pairloom import Preparation

    with Preparation(documents_corpus(table(spark, SF_SMALL, "documents"))) as p:
        assert p.n_examples > 0
        path = p.stages.path.removeprefix("file:")
        assert os.path.isdir(path)
    assert not os.path.exists(path)


def test_write_and_read_examples(prep_small):
    p = prep_small
    out = os.path.join(tempfile.mkdtemp(prefix="examples-"), "out")
    rows = epoch_examples(p.batches(0, 1), p.examples, p.vocab_size, p.cfg)
    write_examples(rows, out)
    spark = p.examples.sparkSession
    e1 = read_epoch(spark, out, "train", 1)
    n_train, n_val = p.sizes
    assert e1.count() == n_train
    assert read_epoch(spark, out, "val", 0).count() == n_val
    # the same rows as masking epoch 1 directly
    direct = p.masked(1).select("example_id", "labels")
    got = e1.select("example_id", "labels")
    assert got.exceptAll(direct).count() == 0
    assert sorted(d for d in os.listdir(out) if d.startswith("split=")) == ["split=train", "split=val"]


def test_scalar_log_append_and_stream(spark):
    root = tempfile.mkdtemp(prefix="scalars-")
    log_dir, out_dir, ck = (os.path.join(root, d) for d in ("log", "out", "ck"))
    sc = scalar_fixture(table(spark, SF_SMALL, "events"))
    # two appends, as a run would log them
    first, second = sc.filter(F.col("epoch") < 5), sc.filter(F.col("epoch") >= 5)
    append_scalars(first, log_dir)
    append_scalars(second, log_dir)
    q = epoch_average_stream(spark, log_dir, out_dir, ck, trigger_once=True)
    q.awaitTermination(120)
    got = read_epoch_averages(spark, out_dir)
    want = epoch_averages(sc)
    cols = ["split", "epoch", "tag", "n_batches", "n_missing"]
    assert got.select(*cols).exceptAll(want.select(*cols)).count() == 0
    assert got.count() == want.count()
    j = got.join(want.withColumnRenamed("mean_value", "w"), ["split", "epoch", "tag"])
    assert j.filter(F.abs(F.col("mean_value") - F.col("w")) > 1e-9).count() == 0
    assert read_scalars(spark, log_dir).count() == sc.count()
    # a restart that finds nothing new leaves the published table
    epoch_average_stream(spark, log_dir, out_dir, ck, trigger_once=True).awaitTermination(120)
    assert read_epoch_averages(spark, out_dir).count() == want.count()


def test_multi_file_corpus_segments_like_the_adapter(spark):
    from pairloom.operators.corpus import segment_documents

    rows = documents_corpus(table(spark, SF_SMALL, "documents"))
    out = os.path.join(tempfile.mkdtemp(prefix="corpus-"), "c")
    # several files whose names follow the line order
    rows.repartitionByRange(5, "row_id").sortWithinPartitions("row_id").select("text", "row_id").write.parquet(out)
    scanned = read_corpus(spark, out)
    assert scanned.agg(F.min("row_id"), F.max("row_id"), F.count("*")).first() == (0, rows.count() - 1, rows.count())

    def docs(df):
        s = segment_documents(df).select("doc_key", "sent_idx", "text").collect()
        by = {}
        for r in s:
            by.setdefault(r.doc_key, {})[r.sent_idx] = r.text
        return sorted(tuple(d[i] for i in range(len(d))) for d in by.values())

    assert docs(scanned) == docs(rows)


def test_unordered_lines_are_the_lines_of_the_corpus(spark):
    from pairloom.operators.corpus import clean_lines
    from pairloom.sources.corpus import documents_corpus, documents_lines, table

    docs = table(spark, SF_SMALL, "documents")
    want = clean_lines(documents_corpus(docs)).select("text")
    got = documents_lines(docs)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


@pytest.mark.parametrize("ids", [[1, 2, 1], [1, None]])
def test_unordered_lines_check_ids(spark, ids):
    from pairloom.operators.vocab import token_counts
    from pairloom.sources.corpus import documents_lines

    docs = spark.createDataFrame([(i, "a b", "s") for i in ids], "doc_id long, text string, source string")
    with pytest.raises(ValueError):
        token_counts(documents_lines(docs))

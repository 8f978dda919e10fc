"""Cross-entropy per batch against a numpy computation on the fixture."""

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from paths import SF_SMALL
from pairloom.operators.metrics import batch_losses, epoch_averages, masked_cross_entropy, pair_loss, split_cross_entropy
from pairloom.sources.corpus import logits_fixture, scalar_fixture, table


def ce(logits, label):
    x = np.asarray(logits, dtype=np.float64)
    m = x.max()
    return np.log(np.exp(x - m).sum()) + (m - x[label])


def test_batch_losses(spark):
    lg = logits_fixture(table(spark, SF_SMALL, "embeddings"))
    rows = lg.collect()
    got = {r.batch_id: r for r in batch_losses(lg).collect()}
    by = {}
    for r in rows:
        by.setdefault(r.batch_id, []).append(r)
    for b, rs in by.items():
        scored = [ce(r.logits, r.mlm_label) for r in rs if r.mlm_label != -100]
        nsp = np.mean([ce(r.nsp_logits, r.nsp_label) for r in rs])
        g = got[b]
        if scored:
            assert abs(g.mlm_loss - np.mean(scored)) < 1e-9
            assert abs(g.loss - (np.mean(scored) + nsp)) < 1e-9
        else:
            assert g.mlm_loss is None and g.loss is None
        assert abs(g.nsp_loss - nsp) < 1e-9
        assert g.n_scored == len(scored)


def test_epoch_average_is_mean_of_batch_values(spark):
    sc = scalar_fixture(table(spark, SF_SMALL, "events"))
    rows = sc.collect()
    got = {(r.split, r.epoch, r.tag): r for r in epoch_averages(sc).collect()}
    acc = {}
    for r in rows:
        acc.setdefault((r.split, r.epoch, r.tag), []).append(r.value)
    for k, vs in acc.items():
        assert abs(got[k].mean_value - sum(vs) / len(vs)) < 1e-9
        assert got[k].n_batches == len(vs)
    full = {(r.split, r.epoch, r.tag): r for r in epoch_averages(sc, denominator=1000).collect()}
    for k, vs in acc.items():
        assert abs(full[k].mean_value - sum(vs) / 1000) < 1e-12


@pytest.mark.parametrize("label", [7, -1, None])
def test_labels_out_of_range_raise(spark, label):
    df = spark.createDataFrame([(0, [0.1, 0.9], 1), (0, [0.3, 0.7], label)], "batch_id int, logits array<float>, mlm_label long")
    with pytest.raises(PySparkException):
        pair_loss(df, "logits", "mlm_label").collect()
    if label is not None:
        with pytest.raises(PySparkException):
            masked_cross_entropy(df).collect()


def test_the_ignore_index_is_left_out(spark):
    df = spark.createDataFrame([(0, [0.0, 0.0], 1), (0, [0.3, 0.7], -100)], "batch_id int, logits array<float>, mlm_label long")
    r = masked_cross_entropy(df).first()
    assert abs(r.mlm_loss - np.log(2)) < 1e-12 and r.n_scored == 1


def test_the_pair_head_reads_whole_vectors(spark):
    lg = logits_fixture(table(spark, SF_SMALL, "embeddings")).limit(20).collect()
    for r in lg:
        x = np.asarray(r.logits, np.float64)
        assert np.allclose(r.nsp_logits, [x[: len(x) // 2].sum(), x[len(x) // 2 :].sum()])


def parts_of(rows, width):
    out = []
    for key, batch, label, logits in rows:
        out += [(key, batch, label, i, logits[i : i + width]) for i in range(0, len(logits), width)]
    return out


PARTS = "vec_id long, batch_id long, mlm_label long, first int, logits array<double>"


def test_split_logits_equal_whole_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(i, i // 4, -100 if i % 3 == 0 or i < 4 else int(rng.integers(0, 23)), rng.normal(size=23).tolist()) for i in range(40)]
    rows += [(100, 50, 2, [1e4, -1e4, 1e4, 0.0]), (101, 51, 1, [-1e4, -1e4 - 5, -1e4 + 3]), (102, 52, 0, [7.0]), (103, 53, 1, [float("-inf"), 1.0, 2.0, 0.5])]
    for width in (1, 2, 5, 23):
        df = spark.createDataFrame(parts_of(rows, width), PARTS).repartition(5)
        got = {r.batch_id: r for r in split_cross_entropy(df, "vec_id").collect()}
        for b in {r[1] for r in rows}:
            want = [ce(x, label) for _, batch, label, x in rows if batch == b and label != -100]
            assert got[b].n_scored == len(want)
            assert (got[b].mlm_loss is None) if not want else abs(got[b].mlm_loss - np.mean(want)) < 1e-12 * max(1, abs(np.mean(want)))


@pytest.mark.parametrize("rows", [
    [(1, 0, 9, 0, [1.0, 2.0])],
    [(1, 0, 0, 0, [1.0]), (1, 0, 0, 2, [1.0])],
    [(1, 0, 0, 0, [1.0, 2.0]), (1, 0, 0, 1, [1.0, 3.0]), (1, 0, 0, 4, [1.0])],
    [(1, 0, 0, 0, [1.0]), (1, 0, 1, 1, [1.0])],
    [(1, 0, None, 0, [1.0])],
    [(1, 0, -1, 0, [1.0])],
])
def test_parts_that_do_not_tile_raise(spark, rows):
    with pytest.raises(PySparkException):
        split_cross_entropy(spark.createDataFrame(rows, PARTS), "vec_id").collect()


def test_a_resumed_log_averages_like_an_uninterrupted_one(spark, tmp_path):
    from pairloom.sources.sinks import append_scalars, compact_scalars, next_run, read_scalars

    def log(steps, shift):
        return spark.createDataFrame([("train", s // 10, "loss", s, None if s == 7 else float(s + shift)) for s in steps], "split string, epoch long, tag string, step long, value double")

    path, whole = str(tmp_path / "log"), str(tmp_path / "whole")
    append_scalars(log(range(0, 18), 0), path)  # without a number: run 0
    assert next_run(spark, path) == 1
    append_scalars(log(range(5, 14), 100), path, 1)
    append_scalars(log(range(7, 30), 200), path, next_run(spark, path))
    append_scalars(log(range(0, 5), 0).union(log(range(5, 7), 100)).union(log(range(7, 30), 200)), whole)
    got = compact_scalars(spark, path, str(tmp_path / "compact"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, read_scalars(spark, whole).collect()), key=str)
    key = lambda r: r["epoch"]
    assert sorted(epoch_averages(got).collect(), key=key) == sorted(epoch_averages(read_scalars(spark, whole)).collect(), key=key)

"""Segmentation over file splits against a plain loop."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pairloom.config import DEFAULT
from pairloom.operators.split_scan import place_lines, segment_splits
from pairloom.session import Stages


def brute(rows, least):
    docs, out, key, cur = [], [], 0, []
    for i, text in enumerate(rows):
        if text is None or text.strip() == "" or text.strip().startswith("="):
            docs.append((key, cur))
            key, cur = key + 1, []
        else:
            cur.append((i, text.strip()))
    docs.append((key, cur))
    for k, d in docs:
        out += [(i, k, j, len(d), t) for j, (i, t) in enumerate(d) if len(d) >= least]
    return sorted(out)


def corpus(seed, n):
    rng = random.Random(seed)
    kinds = ["", " = h = ", None, *["line"] * rng.choice([2, 8, 60])]
    return [k if k != "line" else f" text {i} " for i, k in enumerate(rng.choices(kinds, k=n))]


@pytest.mark.parametrize(("seed", "hold"), [(1, (1 << 16, 1 << 25)), (2, (3, 1 << 25)), (3, (1 << 16, 20)), (4, (0, 0))])
def test_splits_of_many_files(spark, tmp_path, seed, hold):
    rng = random.Random(seed)
    rows, path = corpus(seed, 700), str(tmp_path / "c")
    # files of different length, some with several row groups, one that is one open document
    rows[300:420] = [f"long {i}" for i in range(120)]
    at, files = 0, 0
    import pyarrow.parquet as pq

    (tmp_path / "c").mkdir()
    while at < len(rows):
        size = rng.choice([1, 2, 30, 90])
        pq.write_table(pa.table({"x": pa.array(rows[at : at + size], pa.string()), "y": range(len(rows[at : at + size]))}), f"{path}/part-{files:04d}.parquet", row_group_size=7)
        at, files = at + size, files + 1
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "900")
    try:
        with Stages(spark) as stages:
            table = spark.read.parquet(path)
            assert table.select("x").rdd.getNumPartitions() > 4
            for text in (True, False):
                got = segment_splits(table, F.array("x"), stages.write, DEFAULT, text=text, hold=hold).collect()
                want = brute(rows, DEFAULT.min_sentences)
                assert sorted(tuple(r) for r in got) == (want if text else [w[:4] for w in want])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_rows_of_several_lines_or_none(spark, tmp_path):
    path = str(tmp_path / "c")
    rows = [["a", "b"], [], ["", "c"], ["d", "= e", "f", "g", "h"], []]
    spark.createDataFrame([(r,) for r in rows], "lines array<string>").coalesce(1).write.parquet(path)
    with Stages(spark) as stages:
        got = segment_splits(spark.read.parquet(path), F.col("lines"), stages.write, DEFAULT).collect()
        assert sorted(tuple(r) for r in got) == brute([x for r in rows for x in r], 2)
        empty = spark.read.parquet(path).where("size(lines) > 99")
        assert segment_splits(empty, F.col("lines"), stages.write, DEFAULT).collect() == []


def test_plan_neither_sorts_nor_exchanges_lines(spark, tmp_path):
    path = str(tmp_path / "c")
    spark.createDataFrame([("a",)], "x string").write.parquet(path)
    plans = []
    with Stages(spark) as stages:
        def write(df, name):
            plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
            return stages.write(df, name)

        out = segment_splits(spark.read.parquet(path), F.array("x"), write)
        plans.append(("out", out._jdf.queryExecution().executedPlan().toString()))
    plans = dict(plans)
    assert not any(x in plans["placed_lines"] for x in ("Sort", "Exchange", "Window"))
    # the last step joins the carries: they are broadcast, lines stay
    assert "SortMergeJoin" not in plans["out"] and "hashpartitioning" not in plans["out"]


def test_batches_cut_anywhere_give_the_same_places():
    rng = np.random.default_rng(5)
    flags = rng.random(200) < 0.2
    path = pa.array([f"f{i // 70}" for i in range(200)])
    batch = pa.record_batch([path, pa.array([0] * 200), pa.array(flags)], names=["path", "start", "flag"])

    def lines(batches):
        out = pa.Table.from_batches(list(place_lines(batches, 0, 0, (1000, 1000)))).to_pylist()
        return sorted((tuple((k, v) for k, v in r.items()) for r in out), key=str)

    whole = lines([batch])
    for size in (1, 3, 64):
        assert lines([batch.slice(i, size) for i in range(0, 200, size)]) == whole

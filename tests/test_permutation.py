"""The keyed bijection behind the epoch order."""

import re

import pytest
from pyspark.sql import functions as F

from pairloom import DEFAULT
from pairloom.functions import permutation as pm
from pairloom.operators.batches import epoch_batches, numbers_of_batches, with_slots


def by_hand(n, a32, b32):
    """Slots by a direct walk in Python integers."""
    d = pm.domain(n)

    def mix(x):
        return (((x >> 16) ^ x) * 0x45D9F3B) & 0xFFFFFFFF

    out = []
    for x in range(n):
        while True:
            left, right = divmod(x, d.b)
            for i in range(pm.ROUNDS):
                half = right if i % 2 == 0 else left
                m = mix(mix(half ^ ((a32 + (i + 1) * 0x9E3779B9) & 0xFFFFFFFF)) ^ b32)
                m ^= m >> 16
                left, right = ((left + m) % d.a, right) if i % 2 == 0 else (left, (right + m) % d.b)
            x = left * d.b + right
            if x < n:
                break
        out.append(x)
    return out


def test_domains_hold_n_with_little_to_spare():
    for n in [*range(1, 3000), 10**6 + 3, 10**9 + 7, 10**12 + 39]:
        d = pm.domain(n)
        assert d.a * d.b >= n and d.a * (d.b - 1) < n and d.walks == d.a * d.b - n + 1
        assert n < 4 or d.b > 1
        assert d.walks <= 12 and max(d.a, d.b) <= 8 * n**0.5 + 8
    assert pm.domain(0).n == 0


def test_a_permutation_for_every_size(spark):
    for some in (range(1, 67), range(67, 134), range(134, 201)):
        place = [pm.permuted(F.col("id"), *map(F.lit, pm.keys(7, "shuffle", n)), n).alias(f"p{n}") for n in some]
        rows = spark.range(0, some[-1], 1, 1).select("id", *place).sort("id").collect()
        for n in some:
            got = [r[f"p{n}"] for r in rows[:n]]
            assert sorted(got) == list(range(n)) and got == by_hand(n, *pm.keys(7, "shuffle", n))


def test_the_inverse_undoes_it(spark):
    sizes = (1, 2, 3, 5, 10, 97, 144, 1009, 4093)
    place = [pm.permuted(F.col("id"), F.lit(9), F.lit(4_000_000_000), n).alias(f"p{n}") for n in sizes]
    x = spark.range(0, max(sizes), 1, 1).select("id", *place)
    x = x.select("id", *[pm.permuted(F.col(f"p{n}"), F.lit(9), F.lit(4_000_000_000), n, inverse=True).alias(f"b{n}") for n in sizes])
    for r in x.collect():
        assert all(r[f"b{n}"] == r["id"] for n in sizes if r["id"] < n)


def test_large_sizes_stay_one_to_one(spark):
    for n in (99_991, 1_000_003):
        x = spark.range(0, n).select("id", pm.permuted(F.col("id"), F.lit(3_000_000_001), F.lit(17), n).alias("place"))
        r = x.agg(F.countDistinct("place"), F.min("place"), F.max("place"), F.corr("id", "place")).first()
        assert r[0] == n and r[1] == 0 and r[2] == n - 1 and abs(r[3]) < 0.01


def test_slots_spread_evenly(spark):
    """An example's slots over many epochs lie everywhere."""
    n, cfg = 64, DEFAULT.with_(num_epochs=400)
    x = with_slots(spark.range(0, n).select(F.col("id").alias("number")), n, cfg)
    hits = {(r["number"], r["q"]): r["count"] for r in x.groupBy("number", F.expr("slot div 16").alias("q")).count().collect()}
    assert len(hits) == n * 4 and all(50 <= v <= 155 for v in hits.values())


def split_of(spark, n, n_val):
    return spark.range(0, n).select(
        (F.col("id") * 10).alias("example_id"), F.when(F.col("id") < n_val, "val").otherwise("train").alias("split"), F.col("id").alias("split_rank")
    )


def test_epoch_order_needs_no_exchange_and_no_window(spark):
    plan = epoch_batches(split_of(spark, 1000, 100), 1000)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Exchange|Window|Sort|Join", plan)


def test_batches_are_found_without_the_order(spark):
    n, n_val = 333, 33
    batches = epoch_batches(split_of(spark, n, n_val), n).where("split = 'train' and epoch = 4 and batch_id between 2 and 40")
    want = {(r["batch_id"], r["slot"]): r["example_id"] // 10 - n_val for r in batches.collect()}
    got = {(r["batch_id"], r["slot"]): r["number"] for r in numbers_of_batches(spark, n - n_val, 4, 2, 40).collect()}
    assert got == want and len(got) == n - n_val - 16


def test_manifest_has_one_exchange_of_counts(prep_small):
    prep_small.examples, prep_small.split  # written before
    plan = prep_small.manifest()._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "posexplode" not in plan
    assert len(re.findall(r"Exchange hashpartitioning\(epoch", plan)) == 1
    assert not re.search(r"Exchange hashpartitioning\([^)]*batch_id[^)]*\).*\n.*input_ids", plan)

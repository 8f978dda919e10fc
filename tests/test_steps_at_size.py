"""Steps that touch every word or position run on whole batches, with unchanged results."""

import random

import pyarrow as pa
from pyspark.sql import functions as F

from pairloom.config import DEFAULT, IGNORE_INDEX, SPECIAL_TOKENS, SpecialIds
from pairloom.functions import permutation as pm
from pairloom.functions import word_split
from pairloom.functions.masking import mask_key, position_draw
from pairloom.functions.text import split_keeping, split_words
from pairloom.functions.word_split import code_point_classes, splitter
from pairloom.operators.batches import epoch_batches
from pairloom.operators.examples import apply_mlm
from pairloom.operators.vocab import lookup_ids, summed_token_counts, token_counts
from pairloom.sources.sinks import write_examples


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_epoch_order_has_no_fold_for_each_row(spark):
    split = spark.range(0, 1000).select(
        F.col("id").alias("example_id"), F.when(F.col("id") < 100, "val").otherwise("train").alias("split"), F.col("id").alias("split_rank")
    )
    plan = plan_text(epoch_batches(split, 1000))
    assert "aggregate(" not in plan and "ArrowEvalPython" in plan


def test_numbers_that_are_null_or_beyond_the_domain(spark):
    n = 5
    x = spark.createDataFrame([(None,), (3,), (10**6,)], "number long")
    place = [r[0] for r in x.select(pm.permuted(F.col("number"), F.lit(9), F.lit(17), n)).collect()]
    same = spark.range(0, n).select(pm.permuted(F.col("id"), F.lit(9), F.lit(17), n)).collect()
    assert place[0] is None and place[1] == same[3][0] and sorted(r[0] for r in same) == list(range(n))


def test_masks_equal_the_draws_of_single_positions(spark):
    cfg, special, size = DEFAULT.with_(mlm_probability=0.5), SpecialIds(), 1000
    ids = [[special.cls, *range(10, 10 + n), special.sep, special.pad] for n in range(60)] + [[], None, [11, None, 12]]
    x = spark.createDataFrame(list(enumerate(ids)), "example_id long, input_ids array<long>")
    x = x.union(x.select(F.col("example_id") + 10_000, "input_ids").where("example_id < 60")).coalesce(1)
    masked = apply_mlm(x, size, 2, cfg, special)
    plan = plan_text(masked)
    assert "ArrowEvalPython" in plan and "transform(" not in plan and "zip_with(" not in plan
    got = {r["example_id"]: r for r in masked.collect()}
    assert got[61]["input_ids"] is None and got[61]["labels"] is None and got[60]["input_ids"] == []
    assert got[62]["input_ids"][1] is None and got[62]["labels"][1] == IGNORE_INDEX
    key = mask_key(cfg.seed, F.lit(2), F.col("example_id"))
    one = x.select("example_id", key.alias("key"), "input_ids")
    one = one.select("example_id", "key", F.posexplode("input_ids").alias("pos", "id")).where("id is not null")
    one = one.select("example_id", "pos", "id", *[position_draw(F.col("key"), F.col("pos"), j).alias(f"d{j}") for j in range(3)])
    scored = 0
    for r in one.collect():
        chosen = r["id"] not in special.never_masked and r["d0"] < cfg.mlm_probability
        new = special.mask if r["d1"] < cfg.mask_share else int(r["d2"] * size) if r["d1"] < cfg.mask_share + cfg.random_share else r["id"]
        assert got[r["example_id"]]["input_ids"][r["pos"]] == (new if chosen else r["id"])
        assert got[r["example_id"]]["labels"][r["pos"]] == (r["id"] if chosen else IGNORE_INDEX)
        scored += chosen
    assert scored > 1000


def test_examples_are_made_once_to_be_written(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    def one(x: int) -> int:
        made.add(1)
        return x

    n = 500
    rows = spark.range(0, n).select(
        F.when(F.col("id") < 100, "val").otherwise("train").alias("split"), F.lit(1).cast("bigint").alias("epoch"),
        F.expr("id div 8").alias("batch_id"), F.col("id").alias("slot"), F.udf(one, "long")("id").alias("example_id"))
    write_examples(rows, str(tmp_path / "out"))
    assert made.value == n
    read = spark.read.parquet(str(tmp_path / "out")).withColumn("f", F.input_file_name())
    assert sorted(r[0] for r in read.select("example_id").collect()) == list(range(n))
    files = read.groupBy("split", "batch_id").agg(F.countDistinct("f").alias("n")).collect()
    assert all(r["n"] == 1 for r in files) and read.select("f").distinct().count() > 1
    write_examples(rows.limit(0), str(tmp_path / "none"))


def odd_texts():
    rng = random.Random(7)
    parts = [*SPECIAL_TOKENS, "[MASK", "a", "né", "日本", "x1_", "½", "́", "‍", "𝒳y", "🙂", "...", " ", "\t", "\x1c", "\x85", "\xa0", " "]
    out = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(500)]
    every = [chr(x) for x in range(0x110000) if not 0xD800 <= x < 0xE000]
    return [*out, "", None, "[SEP][SEP]x", *("a" + "".join(every[k : k + 10_000]) for k in range(0, len(every), 10_000))]


def test_words_of_batches_are_those_of_the_pattern(spark):
    texts = odd_texts()
    x = spark.createDataFrame(list(enumerate(texts)), "i int, t string").coalesce(1)
    for literals in ((), SPECIAL_TOKENS, ("eos", " x ", "<s>", "<s>>", "né日")):
        split = split_keeping(literals) if literals else split_words
        want = [r[0] or [] for r in x.sort("i").select(split(F.col("t"))).collect()]
        words, counts = splitter(code_point_classes(spark), literals)(pa.array(texts))
        assert words.to_pylist() == sum(want, []) and counts.tolist() == [len(w) for w in want]
        some, _ = splitter(code_point_classes(spark), literals)(pa.array(texts).slice(3, 90))
        assert some.to_pylist() == sum(want[3:93], [])


def test_counts_and_ids_of_batches(spark, monkeypatch):
    texts = odd_texts()
    rows = spark.createDataFrame([(i, i // 40 % 3 or None, t) for i, t in enumerate(texts)], "i long, file int, text string").coalesce(2)
    vocab = spark.createDataFrame([(t, i, 1) for i, t in enumerate([*SPECIAL_TOKENS, "a", "né", "日本", "..."])], "token string, id long, n long")
    joined = lookup_ids(rows, vocab, ["i"], max_tokens=5, cfg=DEFAULT.with_(broadcast_max_rows=1)).collect()
    counts = token_counts(rows).collect()
    by_file = rows.select("file", F.explode(split_words("text")).alias("token")).groupBy("file", "token").count().collect()
    for limit in (1 << 20, 50):
        monkeypatch.setattr(word_split, "BYTES_AT_ONCE", limit)
        monkeypatch.setattr(word_split, "BYTES_COUNTED", 10 * limit)
        here = lookup_ids(rows, vocab, ["i"], max_tokens=5)
        assert "MapInArrow" in plan_text(here) and sorted(here.collect()) == sorted(joined)
        assert sorted(summed_token_counts(rows).collect()) == sorted(counts)
        kept = word_split.counted_words(rows, "file").groupBy("file", "token").agg(F.sum("n")).collect()
        assert len(kept) == len(by_file) and {tuple(r) for r in kept} == {tuple(r) for r in by_file}
    assert summed_token_counts(rows.limit(0)).count() == 0 == lookup_ids(rows.limit(0), vocab, ["i"]).count()

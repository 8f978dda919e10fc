"""Invariants and statistics of the full example build (sf0.001)."""

import math

from pyspark.sql import functions as F

from pairloom.config import IGNORE_INDEX


def test_example_invariants(prep_small):
    p = prep_small
    seq = p.cfg.seq_len
    m = p.masked(0)
    ex = p.examples
    n = p.n_examples
    # one example per non-final sentence of a kept document
    st = p.index
    expected = st.agg(F.sum(F.when(F.col("sent_idx") == 0, F.col("n_sents") - 1))).first()[0]
    assert n == expected
    bad_len = m.filter(
        (F.size("input_ids") != seq) | (F.size("labels") != seq) | (F.size("attention_mask") != seq)
        | (F.size("token_type_ids") != seq)
    ).count()
    assert bad_len == 0
    # unmasked layout: [CLS] first, exactly two [SEP]
    assert ex.filter(F.col("input_ids")[0] != 2).count() == 0
    assert ex.filter(F.size(F.filter("input_ids", lambda t: t == 3)) != 2).count() == 0
    # labels only on maskable positions, and they restore the unmasked ids
    j = m.select("example_id", "labels", F.col("input_ids").alias("mids")).join(
        ex.select("example_id", "input_ids"), "example_id"
    )
    z = j.select(F.explode(F.arrays_zip("labels", "mids", "input_ids")).alias("z")).select("z.*")
    assert z.filter((F.col("labels") != IGNORE_INDEX) & F.col("input_ids").isin(1, 2, 3)).count() == 0
    assert z.filter((F.col("labels") != IGNORE_INDEX) & (F.col("labels") != F.col("input_ids"))).count() == 0
    assert z.filter((F.col("labels") == IGNORE_INDEX) & (F.col("mids") != F.col("input_ids"))).count() == 0


def test_negative_pairs_use_other_documents(prep_small):
    p = prep_small
    pairs = p.pairs
    assert pairs.filter((F.col("is_next") == 0) & (F.col("b_doc_idx") == F.col("doc_idx"))).count() == 0
    pos = pairs.filter(F.col("is_next") == 1)
    assert pos.filter((F.col("b_doc_idx") != F.col("doc_idx")) | (F.col("b_sent_idx") != F.col("sent_idx") + 1)).count() == 0


def _within(k, n, p, z=5.0):
    sd = math.sqrt(n * p * (1 - p))
    return abs(k - n * p) <= z * sd


def test_rates(prep_small):
    p = prep_small
    pairs = p.pairs.groupBy().agg(F.count("*").alias("n"), F.sum("is_next").alias("k")).first()
    assert _within(pairs.k, pairs.n, 0.5)
    m = p.masked(0)
    x = m.select(F.explode(F.arrays_zip(F.col("labels").alias("l"), F.col("input_ids").alias("m"))).alias("z")).select("z.*")
    e = p.examples.select(F.explode("input_ids").alias("id"))
    maskable = e.filter(~F.col("id").isin(1, 2, 3)).count()
    sel = x.filter(F.col("l") != IGNORE_INDEX)
    n_sel = sel.count()
    assert _within(n_sel, maskable, 0.15)
    n_mask = sel.filter(F.col("m") == 4).count()
    # [MASK] also arises from a random draw equal to 4, or an original [MASK]
    assert _within(n_mask, n_sel, 0.8, z=6.0)


def test_masks_change_with_epoch_pairs_do_not(prep_small):
    p = prep_small
    a = p.masked(0).select("example_id", F.col("labels").alias("l0"))
    b = p.masked(1).select("example_id", F.col("labels").alias("l1"))
    j = a.join(b, "example_id")
    assert j.filter(F.col("l0") != F.col("l1")).count() > 0


def test_streams_of_two_million_keys_do_not_meet(spark):
    """Two examples draw from one stream only if their counters overlap and the second
    halves of their keys are equal."""
    from pairloom.functions.masking import DRAWS_PER_POSITION, mask_key

    keys = spark.range(2_000_000).select(mask_key(42, F.lit(0), F.col("id")).alias("k")).select("k.*")
    assert keys.distinct().count() == 2_000_000
    twins = keys.groupBy("b").agg(F.count("*").alias("n"), F.collect_list("a").alias("a")).where("n > 1").collect()
    inverse = pow(0x9E3779B9, -1, 1 << 32)
    window = 128 * DRAWS_PER_POSITION
    for r in twins:
        at = sorted(a * inverse % (1 << 32) for a in r.a)  # place of the stream on the one cycle of counters
        assert all(y - x >= window for x, y in zip(at, [*at[1:], at[0] + (1 << 32)], strict=True))


def test_special_ids_come_from_the_vocabulary(spark):
    import pytest

    from paths import SF_SMALL
    from pairloom import DEFAULT, Preparation
    from pairloom.sources.corpus import documents_corpus, table

    rows = documents_corpus(table(spark, SF_SMALL, "documents"))
    cfg = DEFAULT.with_(special_tokens=("[PAD]", "[MASK]", "[SEP]", "[UNK]", "[CLS]"))
    with Preparation(rows, cfg) as p:
        s = p.special
        assert (s.pad, s.mask, s.sep, s.unk, s.cls) == (0, 1, 2, 3, 4)
        r = p.examples.agg(F.min(F.col("input_ids")[0]).alias("lo"), F.max(F.col("input_ids")[0]).alias("hi")).first()
        assert (r.lo, r.hi) == (4, 4)
        padded = p.examples.where("n_a + n_b + 3 < 128").select(F.col("input_ids")[127].alias("t")).distinct().collect()
        assert [x.t for x in padded] == [0]
        masked = p.masked(0).select(F.explode(F.arrays_zip("input_ids", "labels")).alias("z")).select("z.*").where("labels != -100")
        assert masked.where("input_ids = 1").count() > 0.7 * masked.count()
        assert masked.where(F.col("labels").isin(0, 2, 4)).count() == 0
        shifted = p.vocab.select("token", (F.col("id") + 1000).alias("id"), "n")
        with Preparation(rows, cfg, vocab=shifted) as q:
            assert q.special.unk == 1003
        with Preparation(rows, cfg, vocab=p.vocab.where("token != '[SEP]'")) as q, pytest.raises(ValueError):
            q.special  # noqa: B018


def test_one_document_with_a_third_of_the_sentences(spark):
    from pairloom import Preparation

    lines = []
    for d in range(40):
        lines += ["= t ="] + [f"d{d} s{i} word" for i in range(400 if d == 7 else 20)] + [""]
    df = spark.createDataFrame(list(enumerate(lines)), "row_id bigint, text string")
    with Preparation(df) as p:
        n = p.pairs.groupBy("is_next").count().collect()
        assert sum(r["count"] for r in n) == 399 + 39 * 19
        own = p.pairs.where("is_next = 0").where("doc_idx = b_doc_idx").count()
        assert own == 0
        drawn = p.pairs.where("is_next = 0 and doc_idx != 7 and b_doc_idx = 7").count()
        assert drawn < 60  # one document in 39, however long


def test_sequences_longer_than_the_model_are_refused():
    import pytest

    from pairloom import DEFAULT

    with pytest.raises(ValueError):
        DEFAULT.with_(seq_len=600, max_position_embeddings=512)
    assert DEFAULT.with_(seq_len=512, max_position_embeddings=512).seq_len == 512

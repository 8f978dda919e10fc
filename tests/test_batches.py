"""Exact split, per-epoch batches and resume."""

from pyspark.sql import functions as F

from pairloom.operators.batches import resume_filter, split_sizes


def test_split_exact(prep_small):
    p = prep_small
    n = p.n_examples
    n_train, n_val = split_sizes(n, p.cfg)
    s = p.split
    assert s.filter(F.col("split") == "val").count() == n_val == max(1, int(0.1 * n))
    assert s.filter(F.col("split") == "train").count() == n_train
    ids = p.examples.select("example_id")
    assert s.select("example_id").exceptAll(ids).count() == 0
    assert ids.exceptAll(s.select("example_id")).count() == 0
    tr = s.filter(F.col("split") == "train").select("example_id")
    va = s.filter(F.col("split") == "val").select("example_id")
    assert tr.intersect(va).count() == 0


def test_batches_and_resume(prep_small):
    p = prep_small
    bs = p.cfg.batch_size
    b = p.batches(0, 2)
    n_train, n_val = p.sizes
    spe = p.steps_per_epoch
    tr = b.filter(F.col("split") == "train")
    sizes = tr.groupBy("epoch", "batch_id").count().collect()
    by_epoch = {}
    for r in sizes:
        by_epoch.setdefault(r.epoch, {})[r.batch_id] = r["count"]
    for e, d in by_epoch.items():
        assert sorted(d) == list(range(spe))
        assert all(v == bs for k, v in d.items() if k < spe - 1)
        assert sum(d.values()) == n_train
    # each epoch is a permutation of the train examples, and epochs differ
    e0 = [r.example_id for r in tr.filter("epoch = 0").orderBy("slot").collect()]
    e1 = [r.example_id for r in tr.filter("epoch = 1").orderBy("slot").collect()]
    assert sorted(e0) == sorted(e1) and e0 != e1
    # resume mid-epoch: prefix + tail = whole run from that epoch on
    k = spe // 2
    tail = resume_filter(b, 1, k)
    head = tr.filter((F.col("epoch") == 1) & (F.col("batch_id") < k))
    whole = tr.filter(F.col("epoch") >= 1)
    assert head.unionByName(tail).exceptAll(whole).count() == 0
    assert whole.exceptAll(head.unionByName(tail)).count() == 0
    # a stored step of 0 means the epoch was finished
    assert resume_filter(b, 1, 0).filter("epoch = 1").count() == 0


def test_split_by_document_keeps_documents_whole(spark):
    from paths import SF_SMALL
    from pairloom import DEFAULT, Preparation
    from pairloom.sources.corpus import documents_corpus, table

    p = Preparation(documents_corpus(table(spark, SF_SMALL, "documents")), DEFAULT.with_(split_by="document"))
    s = p.split.join(p.example_ids.select("example_id", "doc_idx"), "example_id")
    both = s.groupBy("doc_idx").agg(F.countDistinct("split").alias("k")).filter("k > 1").count()
    assert both == 0
    n_train, n_val = p.sizes
    target = max(1, int(0.1 * p.n_examples))
    assert n_val >= target and n_train + n_val == p.n_examples
    biggest = s.groupBy("doc_idx").count().agg(F.max("count")).first()[0]
    assert n_val - target < biggest


def test_resuming_from_a_tag_keeps_validation(prep_small):
    p = prep_small
    b = p.resumed("18_50q").collect()
    n_train, n_val = p.sizes
    spe = p.steps_per_epoch
    val = [r for r in b if r.split == "val"]
    train = [r for r in b if r.split == "train"]
    assert {r.epoch for r in val} == {18, 19} and len(val) == 2 * n_val
    assert min(r.batch_id for r in train if r.epoch == 18) == spe // 2
    assert sum(r.epoch == 19 for r in train) == n_train
    done = p.resumed("18_100q").collect()
    assert {r.epoch for r in done} == {19}


def test_manifest_counts_masked_positions(prep_small):
    p = prep_small
    row = p.manifest().where("epoch = 2 and batch_id = 3").first()
    ids = p.batches(2, 2).where("split = 'train' and batch_id = 3").select("example_id")
    labels = p.masked(2).join(ids, "example_id").select(F.explode("labels").alias("l")).where("l != -100").count()
    assert row.scored_tokens == labels and row.rows == p.cfg.batch_size


def test_schedule_steps_cover_the_run(spark, prep_small):
    from pairloom.operators.batches import schedule_steps

    p = prep_small
    steps = schedule_steps(spark, p.sizes[0], p.cfg)
    want = p.batches().where("split = 'train'").select("epoch", "batch_id").distinct()
    assert steps.exceptAll(want).count() == 0 and steps.count() == want.count()

"""Physical plan checks: no single-partition exchange over data-sized input,
broadcast vocabulary lookup, and a regroup that reuses the scan partitioning."""

import re

from pyspark.sql import functions as F

from pairloom.operators.vocab import lookup_ids


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_segmentation_plan(prep_small):
    txt = plan_text(prep_small.sentences)
    # single-partition exchanges feed the windows over the bucket tables of the
    # documents and of the lines only
    assert txt.count("SinglePartition") == 2
    assert "hashpartitioning(bucket" in txt
    assert "BroadcastHashJoin" in txt


def test_lookup_inside_rows_keeps_the_scan_partitioning(prep_small):
    p = prep_small
    txt = plan_text(lookup_ids(p.sentences, p.vocab, key_cols=["bucket", "row_id"], carry_cols=["doc_key"]))
    assert txt.count("hashpartitioning") == plan_text(p.sentences).count("hashpartitioning")
    assert txt.count("Join") == plan_text(p.sentences).count("Join") and "collect_list" not in txt


def test_joined_lookup_is_broadcast_and_regroup_shuffle_free(prep_small, monkeypatch):
    # a vocabulary too large for constants of the plan, yet below the broadcast limits
    monkeypatch.setattr("pairloom.operators.vocab.token_table", lambda *a: None)
    p = prep_small
    st = lookup_ids(p.sentences, p.vocab, key_cols=["bucket", "row_id"], carry_cols=["doc_key"])
    txt = plan_text(st)
    assert "BroadcastHashJoin" in txt
    assert "BroadcastExchange" in txt
    # exchanges: the input spread, the bucket exchange and those of the small
    # bucket table -- but none keyed by row_id for the regroup
    assert "hashpartitioning(bucket" in txt
    assert "hashpartitioning(bucket#" in txt and "hashpartitioning(row_id" not in txt


def test_vocab_scan_prunes_columns(spark):
    from paths import SF_SMALL
    from pairloom.operators.corpus import clean_lines
    from pairloom.operators.vocab import token_counts
    from pairloom.sources.corpus import documents_corpus, table

    tc = token_counts(clean_lines(documents_corpus(table(spark, SF_SMALL, "documents"))))
    txt = plan_text(tc)
    assert "ReadSchema: struct<doc_id:bigint,text:string,source:string>" in txt
    assert "n_chars" not in txt and "lang" not in txt
    assert "partial_count" in txt  # map-side combine before the shuffle


def stage_names(p):
    import os

    path = p.stages.path.removeprefix("file:")
    return sorted({d.rsplit("-", 1)[0] for d in os.listdir(path)}) if os.path.isdir(path) else []


def small_prep(spark, **cfg):
    from paths import SF_SMALL
    from pairloom import DEFAULT, Preparation
    from pairloom.sources.corpus import documents_corpus, table

    return Preparation(documents_corpus(table(spark, SF_SMALL, "documents")), DEFAULT.with_(**cfg))


def test_pairs_split_and_batches_need_the_narrow_index_only(spark):
    with small_prep(spark) as p:
        assert p.pairs.count() == p.n_examples and p.batches(0, 1).count() > 0
        assert stage_names(p) == ["boundary_flags", "numbered_index", "sentence_index", "split"]
        p.totals().collect()
        assert stage_names(p) == ["boundary_flags", "numbered_index", "sentence_index", "split", "token_counts", "vocab"]


def test_pairs_carry_no_arrays_and_no_document_exchange(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with small_prep(spark, broadcast_max_rows=1) as p:
            txt = plan_text(p.pairs)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin" not in txt and "ids#" not in txt
    keys = re.findall(r"hashpartitioning\(([^()]*), \d+\)", txt)
    assert keys and not any(re.fullmatch(r"doc_(key|idx)#\d+L?", k) for k in keys)


def test_a_large_vocabulary_is_not_broadcast(spark):
    from pairloom.operators.vocab import lookup_join

    rows = spark.createDataFrame([("a",)], "token string")
    big = spark.range(3_000_000).select(F.concat(F.lit("w"), F.col("id")).alias("token"), "id")
    assert "BroadcastHashJoin" not in plan_text(lookup_join(rows, big))
    assert lookup_join(rows, big).collect()[0].id is None


def test_arrays_of_first_sentences_stay_where_they_are_stored(spark):
    from pairloom.operators.pairs import attach_tokens
    from pairloom.session import stored_partitioning

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with small_prep(spark) as p:
            pairs = p.stages.write(p.pairs, "pairs")
            joined = attach_tokens(pairs, p.sentence_tokens, p.n_buckets)
            with stored_partitioning(spark):
                txt = plan_text(joined)
            want = {r.row_id: r.ids for r in p.sentence_tokens.collect()}
            ids = {r.example_id: r.b_id for r in pairs.collect()}
            got = joined.collect()
            assert len(got) == p.n_examples
            assert all(r.ids == want[r.example_id] and r.ids_b == want[ids[r.example_id]] for r in got)
            tables = spark.catalog.listTables()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # both sides of both joins: the pairs move by bucket, the stored arrays are read in place
    assert txt.count("Bucketed: true") == 2 and "Bucketed: false (disabled" not in txt
    assert sorted(re.findall(r"hashpartitioning\((\w+)#", txt)) == ["b_bucket", "bucket"]
    assert len(spark.catalog.listTables()) < len(tables)

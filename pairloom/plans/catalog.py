"""Named queries over the test tables: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the given tables and runs over all of their rows.  Column
names match the SQL twins in ``oracle``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, IGNORE_INDEX, PrepConfig
from ..functions.masking import mask_key, position_draw
from ..operators.batches import resume_filter, schedule_steps, with_schedule
from ..operators.corpus import clean_lines, document_lengths
from ..operators.encoders import encode_texts
from ..operators.metrics import (
    batch_losses,
    epoch_averages,
    masked_cross_entropy,
    pair_loss,
    epoch_rows,
    log_rows,
    lr_rows,
    scalar_rows,
    split_cross_entropy,
)
from ..operators.split_scan import segment_splits
from ..operators.vocab import lookup_ids, lookup_join, token_counts, tokens
from ..session import Stages, ensure_checkpoint_dir
from ..sources.corpus import (
    conversations_corpus,
    document_rows,
    document_text_lines,
    documents_corpus,
    documents_lines,
    logits_fixture,
    read_corpus,
    scalar_fixture,
    table,
)
from ..sources.sinks import append_scalars, compact_scalars, epoch_examples, next_run, read_epoch, read_scalars, write_examples
from ..sources.vocab_counts import VocabCounts
from ..sources.vocab_store import get_or_build_vocab
from .pretraining import Preparation

Query = Callable[[SparkSession, str], DataFrame]

# The resumed run of ``resume_tail``: checkpoint "3_50q", i.e. epoch 3 at
# step int(0.5 * steps_per_epoch).
RESUME_EPOCH = 3
RESUME_FRACTION = 0.5
RESUME_TAG = "3_50q"
LATER_EPOCH = 3
PART_LOGITS = 7
WRITTEN_EPOCH = 1


def _docs_prep(spark: SparkSession, sf_dir: str, cfg: PrepConfig = DEFAULT) -> Preparation:
    ensure_checkpoint_dir(spark)
    docs = table(spark, sf_dir, "documents")
    return Preparation(documents_corpus(docs), cfg, vocab_lines=documents_lines(docs))


def _conv_prep(spark: SparkSession, sf_dir: str, cfg: PrepConfig = DEFAULT) -> Preparation:
    ensure_checkpoint_dir(spark)
    return Preparation(conversations_corpus(table(spark, sf_dir, "conversations")), cfg, boundary_col="is_start")


def _fresh(spark: SparkSession, name: str) -> str:
    """A new folder under the session's checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _joined(col: str) -> F.Column:
    return F.array_join(F.col(col).cast("array<string>"), " ")


# -- step 1: lines and vocabulary ------------------------------------------

def q_corpus_scan(spark, sf_dir):
    """Rows of the files of ``documents``, numbered in file order."""
    return read_corpus(spark, f"{sf_dir.rstrip('/')}/documents.parquet")


def q_clean_lines(spark, sf_dir):
    return clean_lines(documents_corpus(table(spark, sf_dir, "documents")))


def q_token_counts(spark, sf_dir):
    return token_counts(documents_lines(table(spark, sf_dir, "documents")))


def q_vocab_build(spark, sf_dir):
    return _docs_prep(spark, sf_dir).vocab


def q_vocab_cached(spark, sf_dir):
    """The vocabulary as the cache gives it back to a second call."""
    lines = clean_lines(documents_corpus(table(spark, sf_dir, "documents")))
    path = _fresh(spark, "vocab-cache")
    get_or_build_vocab(lines, path)
    return get_or_build_vocab(lines, path)


def q_vocab_incremental(spark, sf_dir):
    """The vocabulary of files of which one has changed, one is new and one is gone since the
    counts were first made."""
    docs = table(spark, sf_dir, "documents")
    part = F.pmod(F.col("doc_id"), F.lit(3))
    base = _fresh(spark, "corpus")
    put = lambda rows, name: rows.write.mode("overwrite").parquet(f"{base}/{name}")
    put(docs.where(part == 0), "stays")
    put(docs.where(part == 1).withColumn("text", F.upper("text")), "changes")
    put(docs, "goes")
    counts = VocabCounts(spark, _fresh(spark, "counts"), document_text_lines())
    counts.update(base)
    put(docs.where(part == 1), "changes")
    put(docs.where(part == 2), "comes")
    put(docs.limit(0), "goes")
    return counts.vocab(base)


def space_split(c):
    """A custom word split: runs of characters between spaces."""
    return F.filter(F.split(c, " "), lambda w: w != "")


def q_custom_split_ids(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    p = Preparation(documents_corpus(docs), vocab_lines=documents_lines(docs), split_fn=space_split)
    ids = lookup_ids(p.sentences, p.vocab, key_cols=["bucket", "row_id"], split_fn=space_split, cfg=p.cfg)
    return ids.select("row_id", F.size("ids").cast("bigint").alias("n_tokens"), _joined("ids").alias("ids"))


def q_encoder_ids(spark, sf_dir):
    """Ids of every sentence from an encoder object, a public sub-word tokenizer."""
    import public_tokenizers
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = encode_texts(_docs_prep(spark, sf_dir).sentences, encoder, ["row_id"])
    return ids.select("row_id", F.size("ids").cast("bigint").alias("n_tokens"), _joined("ids").alias("ids"))


# -- step 2: documents ----------------------------------------------------

def q_documents_segmented(spark, sf_dir):
    return document_lengths(_docs_prep(spark, sf_dir).index)


def q_sentence_index(spark, sf_dir):
    return _docs_prep(spark, sf_dir).index.select("row_id", "doc_key", "sent_idx", "n_sents")


def q_sentence_scan(spark, sf_dir):
    """The sentence index from one pass over the splits of the files."""
    stages = Stages(spark)
    out = segment_splits(table(spark, sf_dir, "documents"), document_rows(), stages.write, text=False)
    return out.select("row_id", "doc_key", "sent_idx", "n_sents")


def q_doc_lengths(spark, sf_dir):
    d = document_lengths(_docs_prep(spark, sf_dir).index)
    return d.groupBy("n_sents").agg(F.count(F.lit(1)).cast("bigint").alias("n_documents"))


def q_corpus_totals(spark, sf_dir):
    return _docs_prep(spark, sf_dir).totals()


# -- step 3: token ids ----------------------------------------------------

def q_token_ids(spark, sf_dir):
    p = _docs_prep(spark, sf_dir)
    ids = lookup_ids(p.sentences, p.vocab, key_cols=["bucket", "row_id"], cfg=p.cfg)
    return ids.select("row_id", F.size("ids").cast("bigint").alias("n_tokens"), _joined("ids").alias("ids"))


def q_special_token_ids(spark, sf_dir):
    """Ids of every sentence with special tokens written into it: apart, glued to words, inside
    punctuation, and cut short."""
    p = _docs_prep(spark, sf_dir)
    text = F.concat(F.lit("[MASK] ([SEP]"), "text", F.lit("[CLS]x [MASK [PAD]."))
    ids = lookup_ids(p.sentences.withColumn("text", text), p.vocab, key_cols=["bucket", "row_id"], cfg=p.cfg)
    return ids.select("row_id", F.size("ids").cast("bigint").alias("n_tokens"), _joined("ids").alias("ids"))


def q_unk_rate(spark, sf_dir):
    p = _docs_prep(spark, sf_dir)
    t = lookup_join(tokens(p.lines), p.vocab, p.cfg)
    return t.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_tokens"),
        F.count_if(F.col("id").isNull()).cast("bigint").alias("n_unk"),
        F.round(F.count_if(F.col("id").isNull()) / F.count(F.lit(1)), 6).alias("unk_rate"),
    )


# -- step 4: pairs --------------------------------------------------------

def q_nsp_pairs(spark, sf_dir):
    return _docs_prep(spark, sf_dir).pairs.select("example_id", "b_id", "is_next")


def q_nsp_balance(spark, sf_dir):
    return (
        _docs_prep(spark, sf_dir)
        .pairs.groupBy("is_next")
        .agg(F.count(F.lit(1)).cast("bigint").alias("n_pairs"))
    )


# -- step 5: assembly -----------------------------------------------------

def q_pair_truncation(spark, sf_dir):
    ex = _docs_prep(spark, sf_dir).examples
    return ex.select("example_id", F.col("n_a").cast("bigint").alias("n_a"), F.col("n_b").cast("bigint").alias("n_b"))


def q_assembled_long(spark, sf_dir):
    ex = _docs_prep(spark, sf_dir).examples
    z = F.arrays_zip("input_ids", "token_type_ids", "attention_mask")
    x = ex.select("example_id", F.posexplode(z).alias("pos", "v"))
    return x.select(
        "example_id",
        F.col("pos").cast("bigint").alias("pos"),
        F.col("v.input_ids").alias("id"),
        F.col("v.token_type_ids").alias("seg"),
        F.col("v.attention_mask").alias("attn"),
    )


# -- step 6: masking and examples -----------------------------------------

def q_mlm_long(spark, sf_dir):
    return _mlm_long(spark, sf_dir, 0)


def q_mlm_long_later(spark, sf_dir):
    """Masked positions of a later epoch: the masks are drawn anew."""
    return _mlm_long(spark, sf_dir, LATER_EPOCH)


def _mlm_long(spark, sf_dir, epoch):
    m = _docs_prep(spark, sf_dir).masked(epoch)
    x = m.select("example_id", F.posexplode(F.arrays_zip("input_ids", "labels")).alias("pos", "v"))
    return x.select(
        "example_id",
        F.col("pos").cast("bigint").alias("pos"),
        F.col("v.input_ids").alias("input_id"),
        F.col("v.labels").alias("label"),
    )


def q_mlm_rates(spark, sf_dir):
    """Counts of the masking branches at epoch 0 over all maskable positions."""
    p = _docs_prep(spark, sf_dir)
    cfg = p.cfg
    x = p.examples.select(mask_key(cfg.seed, F.lit(0), F.col("example_id")).alias("key"), "input_ids")
    x = x.select("key", F.posexplode("input_ids").alias("pos", "id"))
    x = x.filter(~F.col("id").isin(*p.special.never_masked))
    x = x.select(position_draw(F.col("key"), F.col("pos"), 0).alias("sel"),
                 position_draw(F.col("key"), F.col("pos"), 1).alias("br"))
    sel = F.col("sel") < F.lit(cfg.mlm_probability)
    mask_t = cfg.mask_share
    rand_t = round(cfg.mask_share + cfg.random_share, 12)
    return x.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_maskable"),
        F.count_if(sel).cast("bigint").alias("n_selected"),
        F.count_if(sel & (F.col("br") < mask_t)).cast("bigint").alias("n_mask"),
        F.count_if(sel & (F.col("br") >= mask_t) & (F.col("br") < rand_t)).cast("bigint").alias("n_random"),
        F.count_if(sel & (F.col("br") >= rand_t)).cast("bigint").alias("n_unchanged"),
    )


def _training_examples(p: Preparation) -> DataFrame:
    t = p.training_rows(0)
    return t.select(
        "example_id",
        _joined("input_ids").alias("input_ids"),
        _joined("attention_mask").alias("attention_mask"),
        _joined("token_type_ids").alias("token_type_ids"),
        _joined("labels").alias("labels"),
        "next_sentence_label",
    )


def q_training_examples(spark, sf_dir):
    return _training_examples(_docs_prep(spark, sf_dir))


def q_example_summary(spark, sf_dir):
    """Flagship: the whole build, summarised per ``is_next``."""
    return example_summary(_docs_prep(spark, sf_dir))


def example_summary(p: Preparation) -> DataFrame:
    m = p.masked(0)
    return m.groupBy("is_next").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_examples"),
        F.sum(F.col("n_a") + F.col("n_b") + 3).cast("bigint").alias("real_tokens"),
        F.sum(F.size(F.filter("labels", lambda v: v != F.lit(IGNORE_INDEX)))).cast("bigint").alias("scored_tokens"),
    )


# -- step 7: split and batches --------------------------------------------

def q_split_exact(spark, sf_dir):
    return _docs_prep(spark, sf_dir).split


def q_split_selected(spark, sf_dir):
    """The split without ranks, by selection of the n_val-th smallest digest."""
    return _docs_prep(spark, sf_dir).split_labels


def q_split_by_document(spark, sf_dir):
    return _docs_prep(spark, sf_dir, DEFAULT.with_(split_by="document")).split


def q_epoch_batches(spark, sf_dir):
    return _docs_prep(spark, sf_dir).batches()


def q_resume_tail(spark, sf_dir):
    p = _docs_prep(spark, sf_dir)
    step = int(p.steps_per_epoch * RESUME_FRACTION)
    left = resume_filter(p.batches(first_epoch=RESUME_EPOCH), RESUME_EPOCH, step)
    return left.select("epoch", "batch_id", "slot", "example_id")


def q_resume_from_tag(spark, sf_dir):
    """Train and validation batches left after the checkpoint ``3_50q``."""
    return _docs_prep(spark, sf_dir).resumed(RESUME_TAG)


def q_batch_manifest(spark, sf_dir):
    return _docs_prep(spark, sf_dir).manifest()


def q_examples_written(spark, sf_dir):
    """Train and validation examples of one epoch, read back from the example files."""
    p = _docs_prep(spark, sf_dir)
    path = _fresh(spark, "examples")
    rows = epoch_examples(p.batches(WRITTEN_EPOCH, WRITTEN_EPOCH), p.examples, p.vocab_size, p.cfg, p.special)
    write_examples(rows, path)
    t = read_epoch(spark, path, "train", WRITTEN_EPOCH).unionByName(read_epoch(spark, path, "val", WRITTEN_EPOCH))
    return t.select("split", "batch_id", "slot", "example_id", *[_joined(c).alias(c) for c in ("input_ids", "attention_mask", "token_type_ids", "labels")], "next_sentence_label")


# -- step 8: losses and logs ----------------------------------------------

def _r6(c: str) -> F.Column:
    return F.round(F.col(c), 6).alias(c)


def q_masked_cross_entropy(spark, sf_dir):
    g = masked_cross_entropy(logits_fixture(table(spark, sf_dir, "embeddings")))
    return g.select("batch_id", _r6("mlm_loss"), "n_scored")


def q_split_cross_entropy(spark, sf_dir):
    """The masked loss of logits that lie in several rows, seven to a row."""
    lg = logits_fixture(table(spark, sf_dir, "embeddings"))
    parts = lg.select("vec_id", "batch_id", "mlm_label", "logits", F.explode(F.sequence(F.lit(0), F.size("logits") - 1, F.lit(PART_LOGITS))).alias("first"))
    parts = parts.withColumn("logits", F.slice("logits", F.col("first") + 1, F.lit(PART_LOGITS)))
    return split_cross_entropy(parts, "vec_id").select("batch_id", _r6("mlm_loss"), "n_scored")


def q_pair_loss(spark, sf_dir):
    g = pair_loss(logits_fixture(table(spark, sf_dir, "embeddings")))
    return g.select("batch_id", _r6("nsp_loss"), "n_rows")


def q_total_loss(spark, sf_dir):
    g = batch_losses(logits_fixture(table(spark, sf_dir, "embeddings")))
    return g.select("batch_id", _r6("loss"), _r6("mlm_loss"), _r6("nsp_loss"))


def q_epoch_metrics(spark, sf_dir):
    g = epoch_averages(scalar_fixture(table(spark, sf_dir, "events")))
    return g.select("split", "epoch", "tag", _r6("mean_value"), "n_batches", "n_missing")


def q_scalar_log(spark, sf_dir):
    losses = batch_losses(logits_fixture(table(spark, sf_dir, "embeddings")))
    return scalar_rows(losses).select("tag", "step", _r6("value"))


def q_scalar_log_written(spark, sf_dir):
    """The scalar log of the losses, appended in two parts and read back."""
    losses = batch_losses(logits_fixture(table(spark, sf_dir, "embeddings")))
    rows = log_rows(scalar_rows(losses), "train", 0)
    path = _fresh(spark, "scalars")
    for part in (0, 1):
        append_scalars(rows.where(F.col("step") % 2 == part), path)
    return read_scalars(spark, path).select("split", "epoch", "tag", "step", _r6("value"))


def q_scalar_log_resumed(spark, sf_dir):
    """Averages of a log whose run stopped in every epoch and was resumed at half of it: steps from
    there on were logged before, with other values."""
    rows = scalar_fixture(table(spark, sf_dir, "events"))
    path = _fresh(spark, "scalars")
    place = F.col("step") % 100
    before = F.when(place < 50, F.col("value")).otherwise(F.col("value") + 1000)
    append_scalars(rows.where(place < 80).withColumn("value", before), path, 0)
    append_scalars(rows.where(place >= 50), path, next_run(spark, path))
    g = epoch_averages(compact_scalars(spark, path, _fresh(spark, "scalars-compact")))
    return g.select("split", "epoch", "tag", _r6("mean_value"), "n_batches", "n_missing")


def q_lr_log(spark, sf_dir):
    """``train/lr`` rows a run logs after each step (one per train batch)."""
    p = _docs_prep(spark, sf_dir)
    return lr_rows(with_schedule(schedule_steps(spark, p.sizes[0], p.cfg), p.sizes[0], p.cfg))


def q_epoch_metrics_full_denominator(spark, sf_dir):
    """Epoch sums divided by all batches of the epoch, logged or not."""
    g = epoch_averages(scalar_fixture(table(spark, sf_dir, "events")), denominator=100)
    return g.select("split", "epoch", "tag", _r6("mean_value"), "n_batches", "n_missing")


def q_epoch_log(spark, sf_dir):
    """``epoch/{split}_{name}`` rows, one per epoch, from the logged scalars."""
    g = epoch_averages(scalar_fixture(table(spark, sf_dir, "events")))
    return epoch_rows(g).select("tag", "step", _r6("value"))


# -- conversations as documents -------------------------------------------

def q_conv_sentence_index(spark, sf_dir):
    return _conv_prep(spark, sf_dir).index.select("row_id", "doc_key", "sent_idx", "n_sents")


def q_conv_nsp_pairs(spark, sf_dir):
    return _conv_prep(spark, sf_dir).pairs.select("example_id", "b_id", "is_next")


def q_conv_training_examples(spark, sf_dir):
    return _training_examples(_conv_prep(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "corpus_scan": q_corpus_scan,
    "clean_lines": q_clean_lines,
    "token_counts": q_token_counts,
    "vocab_build": q_vocab_build,
    "vocab_cached": q_vocab_cached,
    "vocab_incremental": q_vocab_incremental,
    "custom_split_ids": q_custom_split_ids,
    "encoder_ids": q_encoder_ids,
    "documents_segmented": q_documents_segmented,
    "sentence_index": q_sentence_index,
    "sentence_scan": q_sentence_scan,
    "doc_lengths": q_doc_lengths,
    "corpus_totals": q_corpus_totals,
    "token_ids": q_token_ids,
    "special_token_ids": q_special_token_ids,
    "unk_rate": q_unk_rate,
    "nsp_pairs": q_nsp_pairs,
    "nsp_balance": q_nsp_balance,
    "pair_truncation": q_pair_truncation,
    "assembled_long": q_assembled_long,
    "mlm_long": q_mlm_long,
    "mlm_long_later": q_mlm_long_later,
    "mlm_rates": q_mlm_rates,
    "training_examples": q_training_examples,
    "example_summary": q_example_summary,
    "split_exact": q_split_exact,
    "split_selected": q_split_selected,
    "split_by_document": q_split_by_document,
    "epoch_batches": q_epoch_batches,
    "resume_tail": q_resume_tail,
    "resume_from_tag": q_resume_from_tag,
    "batch_manifest": q_batch_manifest,
    "examples_written": q_examples_written,
    "masked_cross_entropy": q_masked_cross_entropy,
    "split_cross_entropy": q_split_cross_entropy,
    "pair_loss": q_pair_loss,
    "total_loss": q_total_loss,
    "epoch_metrics": q_epoch_metrics,
    "epoch_metrics_full_denominator": q_epoch_metrics_full_denominator,
    "scalar_log": q_scalar_log,
    "scalar_log_written": q_scalar_log_written,
    "scalar_log_resumed": q_scalar_log_resumed,
    "lr_log": q_lr_log,
    "epoch_log": q_epoch_log,
    "conv_sentence_index": q_conv_sentence_index,
    "conv_nsp_pairs": q_conv_nsp_pairs,
    "conv_training_examples": q_conv_training_examples,
}

"""Fixed-length training examples and masking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, PrepConfig, SpecialIds
from ..functions.masking import mask_key, masked_and_labels
from ..functions.sequences import assemble, truncated_lengths

EXAMPLE_COLUMNS = ["example_id", "doc_idx", "is_next", "input_ids", "token_type_ids", "attention_mask", "n_a", "n_b"]


def assemble_examples(pairs: DataFrame, cfg: PrepConfig = DEFAULT, ids_a: str = "ids", ids_b: str = "ids_b",
                      special: SpecialIds = SpecialIds()) -> DataFrame:
    """Truncate the pair to ``seq_len - 3`` tokens and lay it out unmasked."""
    return lay_out(truncate_pairs(pairs, cfg, ids_a, ids_b), cfg, ids_a, ids_b, special)


def truncate_pairs(pairs: DataFrame, cfg: PrepConfig = DEFAULT, ids_a: str = "ids", ids_b: str = "ids_b") -> DataFrame:
    """The pair cut to ``seq_len - 3`` tokens, with the kept lengths ``n_a`` and ``n_b``: all that an
    example holds, without the padding, segments and mask that follow from it."""
    na, nb = truncated_lengths(F.size(ids_a), F.size(ids_b), cfg.pair_budget)
    x = pairs.select("example_id", "doc_idx", "is_next", ids_a, ids_b, na.alias("n_a"), nb.alias("n_b"))
    return x.select(
        "example_id",
        "doc_idx",
        "is_next",
        F.slice(ids_a, 1, F.col("n_a")).alias(ids_a),
        F.slice(ids_b, 1, F.col("n_b")).alias(ids_b),
        "n_a",
        "n_b",
    )


def lay_out(pairs: DataFrame, cfg: PrepConfig = DEFAULT, ids_a: str = "ids", ids_b: str = "ids_b",
            special: SpecialIds = SpecialIds()) -> DataFrame:
    """The unmasked tensors of truncated pairs."""
    parts = assemble(F.col(ids_a), F.col(ids_b), F.col("n_a"), F.col("n_b"), cfg.seq_len, special)
    return pairs.select(
        "example_id",
        "doc_idx",
        "is_next",
        parts["input_ids"].alias("input_ids"),
        parts["token_type_ids"].alias("token_type_ids"),
        parts["attention_mask"].alias("attention_mask"),
        "n_a",
        "n_b",
    )


def apply_mlm(examples: DataFrame, vocab_size: int, epoch: Column | int, cfg: PrepConfig = DEFAULT,
              special: SpecialIds = SpecialIds()) -> DataFrame:
    """Replace ``input_ids`` by the masked ids and add ``labels``.

    Masks depend on ``epoch`` (redrawn every epoch); pairs do not.
    """
    ep = epoch if isinstance(epoch, Column) else F.lit(int(epoch))
    key = mask_key(cfg.seed, ep, F.col("example_id"))
    x = examples.withColumn("_key", key)
    drawn = masked_and_labels(F.col("input_ids"), F.col("_key"), int(vocab_size), cfg.mlm_probability,
                              cfg.mask_share, cfg.random_share, special)
    return x.withColumn("_drawn", drawn).select(
        *[c for c in examples.columns if c != "input_ids"],
        F.col("_drawn.ids").alias("input_ids"),
        F.col("_drawn.labels").alias("labels"),
    )


def to_training_rows(masked: DataFrame) -> DataFrame:
    """The five tensors of one example, in the order a loader emits them."""
    return masked.select(
        "example_id",
        "input_ids",
        "attention_mask",
        "token_type_ids",
        "labels",
        F.col("is_next").alias("next_sentence_label"),
    )

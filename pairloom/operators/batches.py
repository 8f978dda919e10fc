"""Exact split, per-epoch shuffle, batches, resume and the batch manifest."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, PrepConfig, SpecialIds
from ..functions.hashing import MASK32, MIX_MULTIPLIER, WEYL_STEP, digest
from ..functions.masking import DRAWS_PER_POSITION, MLM_TAG
from ..functions.permutation import keys, permuted
from ..functions.schedule import checkpoint_tag, lr_multiplier, milestone_label, tag_position
from ..session import join_small
from .scan import among_smallest, hash_rank, hash_running_sum


def split_sizes(n_examples: int, cfg: PrepConfig = DEFAULT) -> tuple[int, int]:
    """``(n_train, n_val)`` with ``n_val = max(1, int(fraction * N))``."""
    n_val = max(1, int(cfg.validation_fraction * n_examples))
    return n_examples - n_val, n_val


def steps_per_epoch(n_train: int, cfg: PrepConfig = DEFAULT) -> int:
    """Batches per epoch; the last short batch is kept."""
    return math.ceil(n_train / cfg.batch_size)


def split_examples(examples: DataFrame, n_examples: int, cfg: PrepConfig = DEFAULT, docs: DataFrame | None = None,
                   n_docs: int = 0) -> DataFrame:
    """``(example_id, split, split_rank)``.

    ``split_by="example"``: exact sizes, uniform without replacement, per
    example (a document can feed both sides).  ``split_by="document"``:
    documents in digest order go to validation while the examples already
    taken are fewer than the target, so validation holds whole documents and
    at least the target count; ``docs`` then has ``(doc_idx, doc_key, n)``, a document's number
    of examples, and ``examples`` a ``doc_idx``.  ``split_rank`` orders examples inside their
    split (validation batches keep that order).
    """
    _, n_val = split_sizes(n_examples, cfg)
    order = digest(cfg.seed, "split", F.col("example_id"))
    if cfg.split_by == "example":
        r = hash_rank(examples.select("example_id"), order, ["example_id"], "split_rank", n_rows=n_examples, cfg=cfg)
        return r.select(
            "example_id",
            F.when(F.col("split_rank") < n_val, F.lit("val")).otherwise(F.lit("train")).alias("split"),
            "split_rank",
        )
    docs = hash_running_sum(
        docs, digest(cfg.seed, "split", F.col("doc_key")), ["doc_key"], "n", "_before", n_rows=n_docs, cfg=cfg
    ).select("doc_idx", F.when(F.col("_before") < n_val, F.lit("val")).otherwise(F.lit("train")).alias("split"))
    x = join_small(examples.select("example_id", "doc_idx"), docs, "doc_idx",
                   row_bound=n_docs, max_rows=cfg.broadcast_max_rows)
    r = hash_rank(x, order, ["example_id"], "split_rank", n_rows=n_examples,
                  partition_cols=("split",), n_partition_values=2, cfg=cfg)
    return r.select("example_id", "split", "split_rank")


def label_examples(examples: DataFrame, n_examples: int, cfg: PrepConfig = DEFAULT) -> DataFrame:
    """``(example_id, split)``: the labels of ``split_examples`` for ``split_by="example"``,
    without ranks.  The n_val-th smallest digest is found by counting, so no row is sorted."""
    _, n_val = split_sizes(n_examples, cfg)
    ids = examples.select("example_id")
    order = digest(cfg.seed, "split", F.col("example_id"))
    val = among_smallest(ids, order, "example_id", n_val, n_examples)
    return ids.select("example_id", F.when(val, F.lit("val")).otherwise(F.lit("train")).alias("split"))


def epoch_batches(
    split: DataFrame,
    n_examples: int,
    cfg: PrepConfig = DEFAULT,
    first_epoch: int = 0,
    last_epoch: int | None = None,
    n_train: int | None = None,
) -> DataFrame:
    """``(split, epoch, batch_id, slot, example_id)`` for epochs
    ``first_epoch..last_epoch`` (inclusive; default all ``num_epochs``).

    Train examples get a new permutation every epoch: a keyed bijection takes an
    example's dense number to its slot, so no epoch is sorted or shuffled.  Validation keeps
    its split order.  ``slot`` is the position in the epoch order and
    ``batch_id = slot div batch_size``.  Epochs are produced with a generator, not a join.
    """
    last_epoch = cfg.num_epochs - 1 if last_epoch is None else last_epoch
    n_train = split_sizes(n_examples, cfg)[0] if n_train is None else n_train
    tr = with_slots(train_numbers(split, n_examples - n_train, cfg), n_train, cfg, first_epoch, last_epoch)
    tr = tr.select(F.lit("train").alias("split"), "epoch", "slot", "example_id")
    epochs = F.explode(F.sequence(F.lit(first_epoch).cast("bigint"), F.lit(last_epoch).cast("bigint"))).alias("epoch")
    va = split.filter(F.col("split") == "val").select(
        F.lit("val").alias("split"), epochs, F.col("split_rank").alias("slot"), "example_id"
    )
    both = tr.unionByName(va)
    return both.select(
        "split", "epoch", F.expr(f"slot div {cfg.batch_size}").alias("batch_id"), "slot", "example_id"
    )


def train_numbers(split: DataFrame, n_val: int, cfg: PrepConfig = DEFAULT) -> DataFrame:
    """``(example_id, number)``: train examples by their dense number in split order."""
    before = n_val if cfg.split_by == "example" else 0  # one order for both sides, or one for each
    return split.filter(F.col("split") == "train").select("example_id", (F.col("split_rank") - before).alias("number"))


def _epoch_keys(cfg: PrepConfig, first_epoch: int, last_epoch: int) -> Column:
    structs = []
    for epoch in range(first_epoch, last_epoch + 1):
        a, b = keys(cfg.seed, "shuffle", epoch)
        structs.append(F.struct(F.lit(epoch).cast("bigint").alias("epoch"), F.lit(a).cast("bigint").alias("a"), F.lit(b).cast("bigint").alias("b")))
    return F.array(*structs)


def with_slots(numbered: DataFrame, n_train: int, cfg: PrepConfig = DEFAULT, first_epoch: int = 0, last_epoch: int | None = None) -> DataFrame:
    """Every row of ``numbered`` (with ``number``, 0..n_train-1) once an epoch, with
    ``epoch`` and ``slot``."""
    last_epoch = cfg.num_epochs - 1 if last_epoch is None else last_epoch
    x = numbered.select("*", F.explode(_epoch_keys(cfg, first_epoch, last_epoch)).alias("_k"))
    x = x.select(*numbered.columns, F.col("_k.epoch").alias("epoch"), F.col("_k.a").alias("_a"), F.col("_k.b").alias("_b"))
    slot = permuted(F.col("number"), F.col("_a"), F.col("_b"), n_train)
    return x.select(*numbered.columns, "epoch", slot.alias("slot"))


def numbers_of_batches(spark: SparkSession, n_train: int, epoch: int, first_batch: int, last_batch: int, cfg: PrepConfig = DEFAULT) -> DataFrame:
    """``(batch_id, slot, number)`` of some batches of an epoch, by arithmetic alone: the inverse
    bijection, so a reader finds a batch's examples without the epoch's order."""
    low, high = first_batch * cfg.batch_size, min((last_batch + 1) * cfg.batch_size, n_train)
    a, b = keys(cfg.seed, "shuffle", epoch)
    number = permuted(F.col("id"), F.lit(a), F.lit(b), n_train, inverse=True)
    return spark.range(low, max(low, high)).select(F.expr(f"id div {cfg.batch_size}").alias("batch_id"), F.col("id").alias("slot"), number.alias("number"))


def resume_filter(batches: DataFrame, epoch: int, step_in_epoch: int, validation: bool = False) -> DataFrame:
    """Train batches still to run after a checkpoint at (epoch, step).

    A stored step of 0 marks a finished epoch: start at the next one.
    Otherwise re-enter the same epoch and skip its first ``step`` batches.  With
    ``validation`` the validation batches of every epoch still to end come along, whole.
    """
    first = epoch if step_in_epoch > 0 else epoch + 1
    tr = F.col("split") == "train"
    left = (F.col("epoch") > epoch) | ((F.col("epoch") == epoch) & (F.col("batch_id") >= step_in_epoch)) if step_in_epoch > 0 else F.col("epoch") > epoch
    keep = tr & left
    if validation:
        keep = keep | (~tr & (F.col("epoch") >= first))
    return batches.filter(keep)


def resume_from_tag(batches: DataFrame, tag: str, n_train: int, cfg: PrepConfig = DEFAULT) -> DataFrame:
    """What a run preloaded from a checkpoint such as ``"3_50q"`` still does: the
    train batches left, and the validation of every epoch still to end."""
    epoch, step = tag_position(tag, steps_per_epoch(n_train, cfg))
    return resume_filter(batches, epoch, step, validation=True)


def scored_by_epoch(examples: DataFrame, cfg: PrepConfig = DEFAULT, special: SpecialIds = SpecialIds()) -> DataFrame:
    """``(example_id, real, scored)``: real positions, and the masked ones of every epoch, an
    array.  The selection draws of ``functions.masking`` for all epochs in one pass over the
    ids, as array arithmetic on Arrow batches; the rows stay where they are."""
    seed, p, epochs = cfg.seed, cfg.mlm_probability, cfg.num_epochs
    never = list(special.never_masked)
    mask, weyl, multiplier, draws, tag = MASK32, WEYL_STEP, MIX_MULTIPLIER, DRAWS_PER_POSITION, MLM_TAG

    def run(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa

        def mixed(x):
            return (((x >> 16) ^ x) * multiplier) & mask

        for batch in batches:
            ids = batch.column("ids").flatten().to_numpy(zero_copy_only=False)
            real = batch.column("real").to_numpy(zero_copy_only=False).astype(np.int64)
            rows = np.repeat(np.arange(len(real)), real)
            at = np.arange(len(ids)) - np.repeat(np.cumsum(real) - real, real)
            maskable = ~np.isin(ids, never)
            rows, counter = rows[maskable], at[maskable] * draws * weyl
            examples_ = batch.column("example_id").to_pylist()
            scored = np.zeros((len(real), epochs), np.int64)
            for e in range(epochs):
                digests = [hashlib.md5(f"{seed}|{tag}|{e}|{x}".encode()).digest() for x in examples_]
                halves = np.array([(int.from_bytes(d[:4]), int.from_bytes(d[4:8])) for d in digests], np.int64).reshape(-1, 2)
                x = (halves[rows, 0] + counter) & mask
                x = mixed(mixed(x) ^ halves[rows, 1])
                x ^= x >> 16
                scored[:, e] = np.bincount(rows[x / 4294967296.0 < p], minlength=len(real))
            yield pa.RecordBatch.from_arrays(
                [batch.column("example_id"), batch.column("real"), pa.array(list(scored), pa.list_(pa.int64()))], names=["example_id", "real", "scored"]
            )

    n = (F.col("n_a") + F.col("n_b") + 3).cast("bigint")
    x = examples.select("example_id", n.alias("real"), F.slice("input_ids", F.lit(1), n.cast("int")).alias("ids"))
    return x.mapInArrow(run, f"example_id {examples.schema['example_id'].dataType.simpleString()}, real bigint, scored array<bigint>")


def batch_manifest(
    split: DataFrame,
    examples: DataFrame,
    n_examples: int,
    n_train: int,
    cfg: PrepConfig = DEFAULT,
    special: SpecialIds = SpecialIds(),
) -> DataFrame:
    """One row per train ``(epoch, batch_id)`` with the loop's counters.

    ``rows``, ``real_tokens`` and ``scored_tokens`` (masked positions, redrawn
    per epoch), the 0-based ``global_step``, 1-based ``step_in_epoch``, the
    learning rate used by the update (``lr``) and the one logged after the
    scheduler step (``lr_logged``), the checkpoint milestone and its tag.

    Examples meet their numbers once, before epochs; of an example and epoch only (epoch,
    batch, two counts) go to the one exchange, which adds them up by batch.
    """
    x = scored_by_epoch(examples, cfg, special).join(train_numbers(split, n_examples - n_train, cfg), "example_id")
    x = with_slots(x.select("number", "real", "scored"), n_train, cfg)
    x = x.select("epoch", F.expr(f"slot div {cfg.batch_size}").alias("batch_id"), "real", F.get("scored", F.col("epoch").cast("int")).alias("scored"))
    g = x.groupBy("epoch", "batch_id").agg(
        F.count(F.lit(1)).cast("bigint").alias("rows"),
        F.sum("real").cast("bigint").alias("real_tokens"),
        F.sum("scored").cast("bigint").alias("scored_tokens"),
    )
    return with_schedule(g, n_train, cfg)


def schedule_steps(spark: SparkSession, n_train: int, cfg: PrepConfig = DEFAULT) -> DataFrame:
    """Train ``(epoch, batch_id)`` of the whole run, from the number of examples alone."""
    spe = steps_per_epoch(n_train, cfg)
    steps = spark.range(spe * cfg.num_epochs)
    return steps.select(F.expr(f"id div {max(1, spe)}").alias("epoch"), (F.col("id") % max(1, spe)).alias("batch_id"))


def with_schedule(steps: DataFrame, n_train: int, cfg: PrepConfig = DEFAULT) -> DataFrame:
    """Adds the loop's counters to rows keyed by train ``(epoch, batch_id)``:
    0-based ``global_step``, 1-based ``step_in_epoch``, the learning rate used
    by the update (``lr``) and the one logged after the scheduler step
    (``lr_logged``), the checkpoint milestone, its tag and stored step."""
    spe = steps_per_epoch(n_train, cfg)
    total = spe * cfg.num_epochs
    gs = F.col("epoch") * F.lit(spe) + F.col("batch_id")
    label = milestone_label(F.col("batch_id") + 1, F.lit(spe))
    return steps.select(
        *steps.columns,
        gs.cast("bigint").alias("global_step"),
        (F.col("batch_id") + 1).cast("bigint").alias("step_in_epoch"),
        (F.lit(cfg.learning_rate) * lr_multiplier(gs, cfg.warmup_steps, total)).alias("lr"),
        (F.lit(cfg.learning_rate) * lr_multiplier(gs + 1, cfg.warmup_steps, total)).alias("lr_logged"),
        label.alias("milestone"),
        checkpoint_tag(cfg.model_folder, cfg.model_prefix, F.col("epoch"), label).alias("checkpoint_tag"),
        F.when(label == "100q", F.lit(0)).when(label.isNotNull(), F.col("batch_id") + 1).cast("bigint").alias("checkpoint_step"),
    )

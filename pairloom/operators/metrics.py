"""Losses from logged classifier outputs and per-epoch averages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import IGNORE_INDEX
from ..functions.losses import cross_entropy_term, exp_sum, merged


def masked_cross_entropy(df: DataFrame, logits: str = "logits", label: str = "mlm_label", by: str = "batch_id") -> DataFrame:
    """Mean cross-entropy over scored rows per batch; NULL when none scored.  Only the
    ignore index is left out; any other label outside the logits raises."""
    scored = F.col(label) != F.lit(IGNORE_INDEX)
    term = F.when(scored, cross_entropy_term(F.col(logits), F.col(label)))
    return df.groupBy(by).agg(
        F.avg(term).alias("mlm_loss"),
        F.count_if(scored).cast("bigint").alias("n_scored"),
    )


def split_cross_entropy(parts: DataFrame, key: str, logits: str = "logits", first: str = "first", label: str = "mlm_label",
                        by: str = "batch_id") -> DataFrame:
    """``masked_cross_entropy`` for rows whose logits lie in several parts.

    ``parts`` holds for each part of a row its ``key``, batch and label, the number ``first`` of the
    part's first logit and the part's logits.  Each part becomes a maximum and a scaled
    sum before the shuffle, so no row of logits is put together.  The parts of a row
    must follow each other without gap or overlap and agree on the label, or the job ends
    with an error, as it does for a label outside the logits.  Rows with the ignore index only count as rows."""
    size, at = F.size(logits).cast("bigint"), F.col(first).cast("bigint")
    lb = F.col(label).cast("bigint")
    scored = lb != F.lit(IGNORE_INDEX)
    own = (lb >= at) & (lb < at + size)
    picked = F.when(own, F.try_element_at(F.col(logits), (lb - at + 1).cast("int")).cast("double"))
    small = parts.select(by, key, lb.alias("_label"), F.struct(at.alias("at"), size.alias("size"), F.when(scored, exp_sum(logits)).alias("e"), picked.alias("picked")).alias("_part"))
    rows = small.groupBy(by, key).agg(
        F.sort_array(F.collect_list("_part")).alias("_parts"), F.min("_label").alias("_label"), F.max("_label").alias("_other"),
        F.count_if(F.col("_label").isNull()).alias("_none"),
    )
    nothing = F.struct(F.lit(float("-inf")).alias("m"), F.lit(0.0).alias("s"))
    start = F.struct(nothing.alias("e"), F.lit(0).cast("bigint").alias("next"), F.lit(True).alias("whole"), F.lit(None).cast("double").alias("picked"))

    def add(a, x):
        return F.struct(
            F.when(x["e"].isNull(), a["e"]).otherwise(merged(a["e"], x["e"])).alias("e"), (a["next"] + x["size"]).alias("next"),
            (a["whole"] & (x["at"] == a["next"])).alias("whole"), F.coalesce(a["picked"], x["picked"]).alias("picked"))

    t = rows.select(by, "_label", "_other", "_none", F.aggregate("_parts", start, add).alias("t"))
    good = F.col("t.whole") & (F.col("_label") == F.col("_other")) & (F.col("_none") == 0)
    is_scored = F.col("_label") != F.lit(IGNORE_INDEX)
    term = F.log(F.col("t.e.s")) + (F.col("t.e.m") - F.col("t.picked"))
    wrong = F.raise_error(F.lit("parts of a row must tile its logits, with one label inside them")).cast("double")
    fits = F.coalesce(good & (~is_scored | F.col("t.picked").isNotNull()), F.lit(False))
    value = F.when(~fits, wrong).when(is_scored, term)
    return t.groupBy(by).agg(F.avg(value).alias("mlm_loss"), F.count_if(is_scored).cast("bigint").alias("n_scored"))


def pair_loss(df: DataFrame, logits: str = "nsp_logits", label: str = "nsp_label", by: str = "batch_id") -> DataFrame:
    """Mean two-class cross-entropy per batch (no ignored rows)."""
    return df.groupBy(by).agg(
        F.avg(cross_entropy_term(F.col(logits), F.col(label))).alias("nsp_loss"),
        F.count(F.lit(1)).cast("bigint").alias("n_rows"),
    )


def batch_losses(df: DataFrame, by: str = "batch_id") -> DataFrame:
    """``mlm_loss``, ``nsp_loss`` and ``loss = mlm + nsp`` per batch in one
    aggregate (no join between the two heads)."""
    scored = F.col("mlm_label") != F.lit(IGNORE_INDEX)
    g = df.groupBy(by).agg(
        F.avg(F.when(scored, cross_entropy_term(F.col("logits"), F.col("mlm_label")))).alias("mlm_loss"),
        F.avg(cross_entropy_term(F.col("nsp_logits"), F.col("nsp_label"))).alias("nsp_loss"),
        F.count_if(scored).cast("bigint").alias("n_scored"),
        F.count(F.lit(1)).cast("bigint").alias("n_rows"),
    )
    return g.select(by, "mlm_loss", "nsp_loss", (F.col("mlm_loss") + F.col("nsp_loss")).alias("loss"), "n_scored", "n_rows")


def epoch_averages(scalars: DataFrame, keys=("split", "epoch", "tag"), denominator: int | None = None) -> DataFrame:
    """Mean of per-batch values per epoch (not weighted by tokens).

    ``denominator`` = None divides by the batches actually logged; passing
    the full batch count reproduces a loop that divides a resumed (partial)
    epoch's sum by all its batches.  Batches with a NULL value (nothing
    scored) are counted in ``n_missing`` and left out of the mean.
    """
    v = F.col("value")
    denom = F.count(v) if denominator is None else F.lit(float(denominator))
    return scalars.groupBy(*keys).agg(
        (F.sum(v) / denom).alias("mean_value"),
        F.count(v).cast("bigint").alias("n_batches"),
        F.count_if(v.isNull()).cast("bigint").alias("n_missing"),
    )


LOSS_TAGS = (("loss", "loss"), ("mlm_loss", "mlm_loss"), ("nsp_loss", "nsp_loss"))


def scalar_rows(losses: DataFrame, split: str = "train", step_col: str = "batch_id") -> DataFrame:
    """Long form ``(tag, step, value)`` of per-batch losses, as a summary
    writer records them (``train/loss`` ...)."""
    arr = F.array(
        *[F.struct(F.lit(f"{split}/{tag}").alias("tag"), F.col(c).cast("double").alias("value")) for c, tag in LOSS_TAGS]
    )
    return losses.select(F.col(step_col).cast("bigint").alias("step"), F.inline(arr)).select("tag", "step", "value")


def log_rows(scalars: DataFrame, split: str, epoch) -> DataFrame:
    """Scalar rows with the ``split`` and ``epoch`` that the log keeps of each."""
    ep = epoch if isinstance(epoch, Column) else F.lit(epoch)
    return scalars.select(F.lit(split).alias("split"), ep.cast("bigint").alias("epoch"), "tag", "step", "value")


def lr_rows(manifest: DataFrame) -> DataFrame:
    """``train/lr`` rows of the scalar log: the rate logged after each step."""
    return manifest.select(
        F.lit("train/lr").alias("tag"), F.col("global_step").cast("bigint").alias("step"),
        F.col("lr_logged").cast("double").alias("value"),
    )


def epoch_rows(averages: DataFrame, name_col: str = "tag") -> DataFrame:
    """Per-epoch rows ``epoch/{split}_{name}`` with ``step = epoch``, from
    ``epoch_averages`` over per-batch loss scalars."""
    return averages.select(
        F.concat(F.lit("epoch/"), F.col("split"), F.lit("_"), F.col(name_col)).alias("tag"),
        F.col("epoch").cast("bigint").alias("step"),
        F.col("mean_value").cast("double").alias("value"),
    )

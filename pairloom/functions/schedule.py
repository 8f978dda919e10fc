"""Step counters, learning-rate schedule and checkpoint milestones."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


def lr_multiplier(step, warmup_steps: int, total_steps: int) -> Column:
    """Linear warm-up to 1, then linear decay to 0 at ``total_steps``."""
    s = _c(step).cast("double")
    warm = s / F.lit(float(max(1, warmup_steps)))
    decay = F.greatest(
        F.lit(0.0),
        F.lit(1.0) - (s - F.lit(float(warmup_steps))) / F.lit(float(max(1, total_steps - warmup_steps))),
    )
    return F.when(s < F.lit(float(warmup_steps)), warm).otherwise(decay)


def milestone_label(step_in_epoch, steps_per_epoch) -> Column:
    """Checkpoint label after a batch (1-based ``step_in_epoch``).

    The quarter steps are ``int(n*0.25)``, ``int(n*0.5)``, ``int(n*0.75)``;
    when two coincide the later quarter names it; step 0 never fires.  The
    last batch of the epoch is the ``100q`` checkpoint.
    """
    s, n = _c(step_in_epoch), _c(steps_per_epoch)
    q = lambda f: F.floor(n.cast("double") * F.lit(f)).cast("bigint")
    return (
        F.when(s == n, F.lit("100q"))
        .when(s == q(0.75), F.lit("75q"))
        .when(s == q(0.50), F.lit("50q"))
        .when(s == q(0.25), F.lit("25q"))
    )


def checkpoint_tag(folder: str, prefix: str, epoch, label) -> Column:
    """``{folder}/{prefix}{epoch}_{label}.pt``; NULL when no checkpoint."""
    return F.concat(F.lit(f"{folder}/{prefix}"), _c(epoch).cast("string"), F.lit("_"), _c(label), F.lit(".pt"))


def tag_position(tag: str, steps_per_epoch: int) -> tuple[int, int]:
    """``(epoch, stored step)`` of a checkpoint named ``"3_50q"`` or by its file.

    The step is the batch after which the quarter's checkpoint is written, and 0 for the
    end of the epoch.  A tag of another form, or of a quarter that an epoch of so few
    steps never reaches, raises.
    """
    m = re.search(r"(\d+)_(25|50|75|100)q(?:\.pt)?$", tag)
    if not m:
        raise ValueError(f"not a checkpoint tag: {tag!r}")
    epoch, quarter = int(m[1]), int(m[2])
    if quarter == 100:
        return epoch, 0
    step = steps_per_epoch * quarter // 100
    if step == 0:
        raise ValueError(f"an epoch of {steps_per_epoch} steps has no checkpoint {tag!r}")
    return epoch, step

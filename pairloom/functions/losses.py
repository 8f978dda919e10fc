"""Cross-entropy row terms on ``array<float>`` logits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def exp_sum(logits) -> Column:
    """``(m, s)``: the maximum m of some logits and the sum s of ``exp(x - m)`` over them.  Such
    pairs of parts of a row can be merged (``merged``) in any grouping, without overflow."""
    lg = _c(logits)
    m = F.array_max(lg).cast("double")
    s = F.aggregate(lg, F.lit(0.0).cast("double"), lambda acc, x: acc + F.exp(x.cast("double") - m))
    # logits that are all -infinity add nothing
    return F.struct(m.alias("m"), F.when(m == float("-inf"), F.lit(0.0)).otherwise(s).alias("s"))


def merged(a: Column, b: Column) -> Column:
    """The pair of two parts together; (-infinity, 0) is the pair of nothing."""
    m = F.greatest(a["m"], b["m"])
    part = lambda x: F.when(x["s"] == 0, F.lit(0.0)).otherwise(x["s"] * F.exp(x["m"] - m))
    return F.struct(m.alias("m"), (part(a) + part(b)).alias("s"))


def cross_entropy_term(logits, label) -> Column:
    """``logsumexp(logits) - logits[label]`` with the max subtracted first.

    ``label`` is 0-based.  A label outside the array, or NULL, ends the job with an
    error; callers leave out what is to be ignored.
    """
    lg, lb = _c(logits), _c(label)
    m = F.array_max(lg).cast("double")
    lse = F.log(F.aggregate(lg, F.lit(0.0).cast("double"), lambda acc, x: acc + F.exp(x.cast("double") - m))) + m
    picked = F.try_element_at(lg, (lb + 1).cast("int")).cast("double")
    valid = (lb >= 0) & (lb < F.size(lg))
    bad = F.raise_error(F.concat(F.lit("label out of range: "), F.coalesce(lb.cast("string"), F.lit("NULL")))).cast("double")
    return F.when(F.coalesce(valid, F.lit(False)), lse - picked).otherwise(bad)

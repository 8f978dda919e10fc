"""Sequence-pair expressions: truncation, assembly, segments, padding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import SpecialIds


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


def _long(v: int) -> Column:
    return F.lit(v).cast("bigint")


def truncated_lengths(len_a, len_b, budget: int) -> tuple[Column, Column]:
    """Kept lengths after "drop the last token of the longer side, b on ties".

    Closed form of the pop loop: when both sides are long they meet at
    ``ceil(B/2)`` and ``floor(B/2)``; a short side keeps everything and the
    other side gets the rest of the budget ``B``.
    """
    la, lb = _c(len_a), _c(len_b)
    half_up = (budget + 1) // 2
    half_down = budget // 2
    na = F.least(la, F.greatest(F.lit(half_up), F.lit(budget) - lb))
    nb = F.least(lb, F.greatest(F.lit(half_down), F.lit(budget) - la))
    return na.cast("int"), nb.cast("int")


def assemble(ids_a, ids_b, na, nb, seq_len: int, special: SpecialIds = SpecialIds()) -> dict[str, Column]:
    """``[CLS] a [SEP] b [SEP]`` plus padding, segment ids and attention mask."""
    na, nb = _c(na), _c(nb)
    real = na + nb + 3
    pad = (F.lit(seq_len) - real).cast("int")
    input_ids = F.concat(
        F.array(_long(special.cls)),
        F.slice(_c(ids_a), 1, na),
        F.array(_long(special.sep)),
        F.slice(_c(ids_b), 1, nb),
        F.array(_long(special.sep)),
        F.array_repeat(_long(special.pad), pad),
    )
    token_type_ids = F.concat(
        F.array_repeat(_long(0), (na + 2).cast("int")),
        F.array_repeat(_long(1), (nb + 1).cast("int")),
        F.array_repeat(_long(0), pad),
    )
    attention_mask = F.concat(
        F.array_repeat(_long(1), real.cast("int")),
        F.array_repeat(_long(0), pad),
    )
    return {
        "input_ids": input_ids,
        "token_type_ids": token_type_ids,
        "attention_mask": attention_mask,
    }

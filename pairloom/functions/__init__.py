"""Column expressions (JVM-side, codegen friendly; masks and epoch orders on Arrow batches)."""

from .hashing import digest, hex_fraction, key64, mix32, uniform, uniform_index
from .losses import cross_entropy_term
from .masking import mask_key, masked_and_labels, position_draw
from .schedule import checkpoint_tag, lr_multiplier, milestone_label
from .sequences import assemble, truncated_lengths
from .text import is_boundary, split_words, strip_text

__all__ = [
    "assemble",
    "checkpoint_tag",
    "cross_entropy_term",
    "digest",
    "hex_fraction",
    "key64",
    "mix32",
    "is_boundary",
    "lr_multiplier",
    "mask_key",
    "masked_and_labels",
    "milestone_label",
    "position_draw",
    "split_words",
    "strip_text",
    "truncated_lengths",
    "uniform",
    "uniform_index",
]

"""Parameters of the data preparation.

The values under "fixed values" must equal the defaults of the training
setup being reproduced, otherwise vocabularies, examples and schedules
differ.  Everything else is a choice of this library.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# --- fixed values (must match the reproduced training setup) -------------
SPECIAL_TOKENS = ("[UNK]", "[PAD]", "[CLS]", "[SEP]", "[MASK]")
IGNORE_INDEX = -100
BATCH_SIZE = 8
NUM_EPOCHS = 20
SEQ_LEN = 128
LEARNING_RATE = 1e-4
WARMUP_STEPS = 10_000
MLM_PROBABILITY = 0.15
MASK_SHARE = 0.80  # selected positions replaced by [MASK]
RANDOM_SHARE = 0.10  # selected positions replaced by a random id
MIN_FREQUENCY = 2
VOCAB_SIZE = 30_000  # word-level trainer default, specials included
VALIDATION_FRACTION = 0.1
NSP_POSITIVE_PROBABILITY = 0.5
MODEL_FOLDER = "weights"
MODEL_PREFIX = "bmodel_"
# --- end of fixed values ---------------------------------------------------

# Smallest stride of the conversations adapter: conv_id * stride + turn + 1.
# A longer conversation widens it.
ROW_ID_STRIDE = 1 << 20

# Target number of rows per bucket of the two-level scans and ranks.
SCAN_BUCKET_ROWS = 1 << 20
# Largest small table (bucket offsets, document index, file offsets) that is
# broadcast; larger ones fall back to a shuffle join.
BROADCAST_MAX_ROWS = 1_000_000
# ... and largest size, from its counted rows and bytes.
BROADCAST_MAX_BYTES = 64 << 20


@dataclass(frozen=True)
class SpecialIds:
    """Ids of the special tokens in the vocabulary in use."""

    unk: int = 0
    pad: int = 1
    cls: int = 2
    sep: int = 3
    mask: int = 4

    @property
    def never_masked(self) -> tuple[int, int, int]:
        return self.cls, self.sep, self.pad


@dataclass(frozen=True)
class PrepConfig:
    """All knobs of one preparation run.

    ``seed`` feeds every hashed draw, so the same seed and corpus always give
    the same pairs, masks, split and batch order, whatever the partitioning.
    """

    seed: int = 42
    seq_len: int = SEQ_LEN
    # positions the model to be trained can embed; None: not checked
    max_position_embeddings: int | None = None
    batch_size: int = BATCH_SIZE
    num_epochs: int = NUM_EPOCHS
    learning_rate: float = LEARNING_RATE
    warmup_steps: int = WARMUP_STEPS
    mlm_probability: float = MLM_PROBABILITY
    mask_share: float = MASK_SHARE
    random_share: float = RANDOM_SHARE
    min_frequency: int = MIN_FREQUENCY
    vocab_size: int = VOCAB_SIZE
    special_tokens: tuple = field(default=SPECIAL_TOKENS)
    validation_fraction: float = VALIDATION_FRACTION
    # "example": exact size, one document may feed both sides (the reference's
    # behaviour); "document": whole documents go to validation until it holds
    # at least the target number of examples, so no document is on both sides.
    split_by: str = "example"
    nsp_positive_probability: float = NSP_POSITIVE_PROBABILITY
    min_sentences: int = 2
    model_folder: str = MODEL_FOLDER
    model_prefix: str = MODEL_PREFIX
    scan_bucket_rows: int = SCAN_BUCKET_ROWS
    broadcast_max_rows: int = BROADCAST_MAX_ROWS

    def __post_init__(self):
        if self.seq_len < 3:
            raise ValueError("seq_len must be at least 3 ([CLS] a [SEP] b [SEP])")
        if self.max_position_embeddings is not None and self.seq_len > self.max_position_embeddings:
            raise ValueError("seq_len must not exceed max_position_embeddings")
        if self.batch_size < 1:
            raise ValueError("batch_size must be positive")
        if self.split_by not in ("example", "document"):
            raise ValueError("split_by must be 'example' or 'document'")
        if self.vocab_size <= len(self.special_tokens):
            raise ValueError("vocab_size must exceed the number of special tokens")

    @property
    def pair_budget(self) -> int:
        """Tokens left for both sentences after [CLS], [SEP], [SEP]."""
        return self.seq_len - 3

    def with_(self, **kw) -> "PrepConfig":
        return replace(self, **kw)


DEFAULT = PrepConfig()

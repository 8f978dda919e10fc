"""pairloom: masked-language-model pre-training data preparation on Spark."""

from .config import DEFAULT, PrepConfig
from .plans.pretraining import Preparation
from .session import build_session, ensure_checkpoint_dir, materialize

__all__ = ["DEFAULT", "PrepConfig", "Preparation", "build_session", "ensure_checkpoint_dir", "materialize"]

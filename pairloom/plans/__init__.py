"""Composite jobs."""

from .pretraining import Preparation

__all__ = ["Preparation"]

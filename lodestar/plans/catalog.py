"""Imports every query module so the registry is complete."""

from lodestar.plans import q_cache, q_corpus, q_eval, q_model  # noqa: F401
from lodestar.plans.registry import ORACLES, QUERIES  # noqa: F401

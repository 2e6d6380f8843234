"""All queries of this subpackage, by importing the modules that register them."""

from skylag.llm import disclosure, exact_dedup, fingerprints, hard_negatives, language_model, licenses, mixing, near_join, secret_scan, sentencepiece_matching, substring_dedup, toxicity, whitening  # noqa: F401
from skylag.llm.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]

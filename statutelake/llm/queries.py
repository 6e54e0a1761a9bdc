"""All queries of the package; importing this module registers them."""

from __future__ import annotations

from . import q_corpus_statistics, q_decontamination, q_filters, q_links, q_quality, q_sharding, q_tokens
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "q_corpus_statistics", "q_decontamination", "q_filters", "q_links", "q_quality", "q_sharding", "q_tokens"]

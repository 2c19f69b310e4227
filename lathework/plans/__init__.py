"""Registered queries. Importing this package registers all of them."""

from lathework.plans import batch_queries, extra_queries, inventory_queries, rule_queries, selection_queries, session_queries, source_queries, text_queries, trial_queries, volume_queries
from lathework.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "batch_queries", "extra_queries", "inventory_queries", "rule_queries", "selection_queries", "session_queries", "source_queries", "text_queries", "trial_queries", "volume_queries"]

"""Imports every proof-query module so the registry is complete."""
from . import q_flagship, q_functions, q_messages, q_relational, q_increments, q_text, q_graph, q_sinks, q_feeds, q_jobs, q_streaming, q_articles, q_profiles, q_feeds2, q_platform_pages  # noqa: F401
from .registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]

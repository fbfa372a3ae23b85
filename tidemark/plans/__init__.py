"""Registered queries of the library, each with DuckDB SQL for the same rows where SQL can express it."""

from tidemark.plans import feature_queries, ingest_queries, model_queries, stream_queries  # noqa: F401
from tidemark.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

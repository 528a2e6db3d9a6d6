"""All registered queries."""

from knotwork.plans import graph_queries, ingest_queries, partition_queries, profile_queries, similarity_queries
from knotwork.plans.registry import ORACLES, QUERIES

__all__ = [
    "ORACLES", "QUERIES",
    "graph_queries", "ingest_queries", "partition_queries", "profile_queries", "similarity_queries",
]

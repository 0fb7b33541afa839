"""Operators for preparing training text."""

from . import bpe_queries, cluster_queries, decontaminate_queries, divergence_queries, line_queries, near_queries, neighbour_queries, pii_queries, piece_queries, shard_queries, topk_queries, toxicity_queries, url_queries
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "bpe_queries", "cluster_queries", "decontaminate_queries", "divergence_queries", "line_queries", "near_queries", "neighbour_queries", "pii_queries", "piece_queries", "shard_queries", "topk_queries", "toxicity_queries", "url_queries"]

"""Registered queries (one per operator) and their DuckDB oracles."""

from riskloom.catalog.registry import REGISTRY  # noqa: F401

# importing the modules registers their queries
from riskloom.catalog import q_quality, q_features, q_eda, q_metrics, q_impute, q_split, q_models, q_io  # noqa: F401,E402

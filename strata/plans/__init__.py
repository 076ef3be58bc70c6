"""Composed plans over the operators and the registered query set."""

from . import q_dist, q_features, q_io, q_quality, q_rollup, q_series, q_sketch  # noqa: F401  (registers queries)
from . import q_dashboard  # noqa: F401  (of the queries above)
from .registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]

"""Registered queries; importing a module of this package fills the registry."""
from importlib import import_module

from netkpi.plans.registry import COVERS, ORACLES, QUERIES

_ALL = (
    "source_queries", "expression_queries", "kpi_queries", "order_queries",
    "series_queries", "curve_queries", "feature_queries", "model_queries", "stream_queries", "version_queries",
)
for _name in _ALL:
    import_module(f"netkpi.plans.{_name}")

__all__ = ["COVERS", "ORACLES", "QUERIES"]

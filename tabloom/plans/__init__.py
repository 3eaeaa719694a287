"""Query registry and composed plans."""

from importlib import import_module

GROUPS = [
    "profiling", "cleaning_queries", "aggregate_queries", "imputation_queries", "outlier_queries",
    "encoding_queries", "selection_queries", "model_queries", "sink_queries",
]


def load_all() -> None:
    """Import every module that registers queries."""
    for name in GROUPS:
        import_module(f"tabloom.plans.{name}")

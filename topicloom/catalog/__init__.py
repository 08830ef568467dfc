"""Registered queries with their SQL twins, one module per operator family."""

from importlib import import_module

FAMILIES = ("text_queries", "feature_queries", "evaluation_queries", "report_queries", "source_queries", "model_queries")


def load_queries():
    """All queries and oracles by name."""
    base = import_module("topicloom.catalog.base")
    for family in FAMILIES:
        import_module(f"topicloom.catalog.{family}")
    return base.QUERIES, base.ORACLES

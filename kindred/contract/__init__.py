"""The registered queries, each next to the SQL that must give the same rows."""

from importlib import import_module

MODULES = ("index_queries", "search_queries", "similarity_queries", "relational_queries", "function_queries", "streaming_queries", "job_queries", "ml_queries")


def load() -> None:
    """Import every module that registers queries."""
    for name in MODULES:
        import_module(f"kindred.contract.{name}")

"""Transit views over the sample tables, and the queries registered on them."""

from importlib import import_module

from headway.catalog.registry import QUERIES, Query

_MODULES = ["occupancy_queries", "report_queries", "message_queries", "model_queries"]


def all_queries() -> dict[str, Query]:
    for module in _MODULES:
        import_module(f"{__name__}.{module}")
    return QUERIES

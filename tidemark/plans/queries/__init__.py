"""The query catalogue."""

from importlib import import_module

MODULES = ("flows", "series", "status", "links", "texts", "landing", "ordered", "themes")


def load_all():
    """All registered queries by name."""
    for name in MODULES:
        import_module(f"tidemark.plans.queries.{name}")
    from tidemark.plans.queries.registry import REGISTRY

    return REGISTRY

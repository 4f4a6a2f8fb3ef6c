"""The queries, by name, with their SQL."""

from importlib import import_module


def load() -> tuple[dict, dict]:
    """All queries and the SQL of those that have any."""
    for name in ("records", "parts", "shapes", "meshes", "bodies", "files"):
        import_module(f"facetforge.plans.{name}")
    from facetforge.plans.registry import ORACLES, QUERIES

    return QUERIES, ORACLES

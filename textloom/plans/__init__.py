"""Named queries over the fixture tables, with their oracle SQL."""

from importlib import import_module

MODULES = (
    "scans",
    "filters",
    "joins",
    "aggregates",
    "windows",
    "texts",
    "prompts",
    "tokens",
    "labels",
    "splits",
    "vectors",
    "topics",
    "models",
    "metrics",
    "streams",
    "flagship",
)


def load_all() -> None:
    for name in MODULES:
        import_module(f"textloom.plans.{name}")

"""Registered queries, one module per operator family."""

from importlib import import_module

FAMILIES = (
    "tables", "features", "quality", "metrics", "splits", "prep", "diagnostics", "ranking", "monitoring", "modeling", "boosted", "streams", "odd_names",
)


def load_all() -> None:
    for family in FAMILIES:
        import_module(f"{__name__}.{family}")

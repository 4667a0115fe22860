"""Queries over the driver's tables, each with its SQL where SQL can express it."""


def load() -> None:
    """Import all modules that register queries."""
    import importlib

    for name in MODULES:
        importlib.import_module(f"stemma.plans.{name}")


MODULES = ["merging", "identity", "annotation", "structure", "setops", "stream", "upkeep", "sourcing"]

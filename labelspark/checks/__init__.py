"""Registered queries over the driver's tables, each with its SQL twin where SQL can say it."""


def load():
    """(queries, oracles), filled by importing every module of registrations."""
    from importlib import import_module
    from pathlib import Path

    from .common import ORACLES, QUERIES

    for path in sorted(Path(__file__).parent.glob("*.py")):
        if path.stem not in ("__init__", "common"):
            import_module(f"{__name__}.{path.stem}")
    return QUERIES, ORACLES

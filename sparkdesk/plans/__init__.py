"""Runnable queries over the given tables; importing :func:`load_all` fills the registry."""

from importlib import import_module

_MODULES = ("demand", "panels", "companies", "corpus", "datasets", "retrieval", "clusters", "hypotheses", "files", "streams")


def load_all() -> None:
    for name in _MODULES:
        import_module(f"sparkdesk.plans.{name}")

"""Inputs derived from the test tables, and the registered queries with their SQL."""

from . import imagery, registry, training

__all__ = ["imagery", "registry", "training"]

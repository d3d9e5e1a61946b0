"""All queries and oracles of the linkage engine."""

from __future__ import annotations

from kindred.plans.oracles import oracles
from kindred.plans.queries import queries

__all__ = ["oracles", "queries"]

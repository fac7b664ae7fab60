"""Registered queries and their SQL twins over the given tables."""

from __future__ import annotations

from catalog import aggregates, extras, features, flows, keyed, pages, places, scalars, shape, sources, streams  # noqa: F401
from catalog.base import ORACLES, QUERIES  # noqa: F401

"""Everything registered."""

from __future__ import annotations

from tagmill.plans import evaluation, incremental, pairs, registry, tagging, vectors  # noqa: F401

QUERIES, ORACLES = registry.QUERIES, registry.ORACLES

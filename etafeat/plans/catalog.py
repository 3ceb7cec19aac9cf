"""Imports every query module so that the registry is complete."""

from __future__ import annotations

from etafeat.plans import (q_clean, q_demand, q_features, q_quality, q_routes, q_sampling,  # noqa: F401
                           q_windows)
from etafeat.plans.registry import REGISTRY, Query


def all_queries() -> dict[str, Query]:
    return dict(REGISTRY)

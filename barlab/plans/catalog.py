"""Imports every query module so that the registry is complete."""

from __future__ import annotations

from barlab.plans.registry import REGISTRY, Query


def all_queries() -> dict[str, Query]:
    from barlab.plans import q_backtest, q_goals, q_indicators, q_lake, q_metrics, q_stream, q_swings  # noqa: F401
    return dict(REGISTRY)

"""Import every query module so the catalog is complete."""

from __future__ import annotations

from . import q_analytics, q_batch, q_core, q_joins, q_streaming, q_windows  # noqa: F401
from .catalog import DESCRIPTIONS, ORACLE, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLE)


def descriptions():
    return dict(DESCRIPTIONS)

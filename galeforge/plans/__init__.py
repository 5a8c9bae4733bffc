"""One registered query for each operator, with its SQL twin."""

from __future__ import annotations

from . import field_plans, river_plans, serving_plans, track_plans  # noqa: F401
from .base import QUERIES, SQL


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)

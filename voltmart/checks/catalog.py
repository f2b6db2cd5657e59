"""All registered queries."""

from __future__ import annotations

from voltmart.checks import (  # noqa: F401
    billing_checks,
    capture_checks,
    monitoring_checks,
    rental_checks,
    streaming_checks,
    warehouse_checks,
)
from voltmart.checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

"""Imports every query module so that the registry is complete."""

from lacuna.plans import acquisition, blocks, echoes, exports, kept, masks, monitoring, scaling, streams, texts, transforms  # noqa: F401
from lacuna.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]

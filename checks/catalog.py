"""Loads every module that registers queries."""

from . import gold, jobs, marts, quality, silver, snapshots, storage, streams, upkeep  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

"""Imports every module that registers queries."""

from bindings import columns, jobs, lifecycle, models, relational  # noqa: F401
from bindings.registry import ENTRIES

__all__ = ["ENTRIES"]

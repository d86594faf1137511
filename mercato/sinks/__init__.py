"""Sinks of the warehouse's jobs."""

from .keyed import KeyedLog
from .outputs import Outputs

__all__ = ["KeyedLog", "Outputs"]

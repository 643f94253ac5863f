"""Whole queries built from the operators, and the registry of runnable ones."""

import importlib

_MODULES = [
    "planning_queries",
    "record_queries",
    "log_queries",
    "file_queries",
    "folder_queries",
    "stream_queries",
]


def load_all() -> None:
    """Import every module that registers queries."""
    for name in _MODULES:
        importlib.import_module(f"tallyloom.plans.{name}")

"""Registered queries and the daily flow."""

import importlib

from sensorlake.plans.registry import QUERIES, Query

MODULES = ("landing", "readings", "files", "columns", "joined", "grouped", "ordered", "reshaped", "texts", "clocks", "numbers", "custom")


def all_queries() -> dict[str, Query]:
    for name in MODULES:
        importlib.import_module(f"sensorlake.plans.{name}")
    return dict(QUERIES)

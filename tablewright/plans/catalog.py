"""All registered queries; importing the modules registers them."""

from __future__ import annotations

import importlib

from tablewright.plans.registry import ORACLES, QUERIES

MODULES = (
    "columns",
    "joining",
    "grouping",
    "windowing",
    "versions",
    "shaping",
    "cookbook",
    "files",
    "everyday",
    "streams",
    "batches",
    "scale",
    "graphs",
)

for _name in MODULES:
    importlib.import_module(f"tablewright.plans.{_name}")

__all__ = ["ORACLES", "QUERIES"]

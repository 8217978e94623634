"""All registered queries and the SQL that checks them."""

from __future__ import annotations

from importlib import import_module

GROUPS = (
    "catalogue",
    "collaborative",
    "content",
    "serving",
    "sessions",
    "models",
)

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

for _group in GROUPS:
    _module = import_module(f"starloom.plans.{_group}")
    QUERIES.update(_module.QUERIES)
    ORACLES.update(_module.ORACLES)

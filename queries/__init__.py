"""Queries over the driver tables, each with the SQL an oracle runs on the same files."""

from __future__ import annotations

import importlib
import importlib.util
from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}

FAMILIES = [
    "predicates",
    "scalars",
    "sources",
    "joins",
    "aggregates",
    "windows",
    "sets",
    "rules",
    "contracts",
    "repairs",
    "detection",
    "linkage",
    "drift",
    "injection",
    "streams",
    "learning",
    "extensions",
]


def query(name: str, sql: str | None = None):
    """Register a function (spark, directory) -> DataFrame and its oracle."""

    def wrap(function):
        if name in QUERIES:
            raise KeyError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return wrap


def load_all() -> None:
    for family in FAMILIES:
        if importlib.util.find_spec(f"queries.{family}"):
            importlib.import_module(f"queries.{family}")

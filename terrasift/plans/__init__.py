"""Registered queries: one module per family of operators."""

import importlib

MODULES = ("flagship", "attributes", "builds", "geo", "packs", "profiles", "provenance", "readers", "shapes", "statepacks", "tables")


def load() -> None:
    for name in MODULES:
        importlib.import_module(f"terrasift.plans.{name}")

"""Every operator bound to the input tables; importing the modules fills the registry."""

from __future__ import annotations

import importlib
import re

from attesta.plans.registry import PLANS, SQL, as_query

MODULES = ("scalars", "scans", "filters", "joins", "aggregates", "sequences", "ordering", "evidence", "lifecycle",
           "gates", "streams")

for _name in MODULES:
    try:
        importlib.import_module(f"attesta.plans.{_name}")
    except ModuleNotFoundError as e:
        if e.name != f"attesta.plans.{_name}":
            raise


def _order(name: str):
    family, number = re.match(r"([a-z]+)(\d+)", name).groups()
    return family, int(number), name


def queries():
    return {name: as_query(PLANS[name]) for name in sorted(PLANS, key=_order)}


def oracle_sql():
    return dict(SQL)


def flagship(t):
    return PLANS["a3_segments_residual"](t)

"""Registered queries: each area module exposes ``QUERIES`` (name ->
callable(spark, sf_dir) -> DataFrame) and ``ORACLE`` (name -> DuckDB SQL over
the driver's tables). Float outputs are rounded with SQL ``round`` on both
sides so sums taken in a different order compare equal."""

from __future__ import annotations

import importlib

# Model training is the heaviest work (and needs the most driver memory), so
# the forecasting area is registered last, its cheapest queries first.
AREAS = ["flagship", "cleaning", "features", "profile", "metrics",
         "anomaly", "drift", "rules", "streaming", "forecast"]


def _load():
    queries, oracle = {}, {}
    for area in AREAS:
        mod = importlib.import_module(f"ledgerline.plans.{area}")
        queries.update(mod.QUERIES)
        oracle.update(getattr(mod, "ORACLE", {}))
    return queries, oracle


def all_queries():
    return _load()[0]


def all_oracle():
    return _load()[1]

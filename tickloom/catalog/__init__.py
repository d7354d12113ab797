"""Registered queries over the given tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def all_queries() -> dict[str, Query]:
    from tickloom.catalog import detections, features, forecasts, manifests, sources, trials

    found: dict[str, Query] = {}
    for module in (sources, features, manifests, detections, forecasts, trials):
        found.update(module.QUERIES)
    return found


def all_oracles() -> dict[str, str]:
    from tickloom.catalog import detections, features, forecasts, manifests, sources, trials

    found: dict[str, str] = {}
    for module in (sources, features, manifests, detections, forecasts, trials):
        found.update(module.ORACLES)
    return found

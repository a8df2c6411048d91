"""Collects the queries of all subject areas."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from larkspur.session import configure

Plan = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    plan: Plan
    sql: str | None = None


def configured(plan: Plan) -> Plan:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plan(configure(spark), sf_dir)

    return run


def all_queries() -> dict[str, Query]:
    from larkspur.plans import catalog, graph, kv, language, rides, social, sources

    collected: dict[str, Query] = {}
    for area in (sources, catalog, social, graph, language, kv, rides):
        collected |= area.QUERIES
    return collected

"""The registered queries and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from cratelight.plans.views import with_views

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None
    covers: str


REGISTRY: dict[str, Query] = {}


def query(covers: str, views: str = "", sql: str | None = None, name: str | None = None) -> Callable[[Run], Run]:
    """Registers a query, by default under its function's name; ``covers`` lists the survey ids it exercises."""

    def register(run: Run) -> Run:
        key = name or run.__name__
        if key in REGISTRY:
            raise ValueError(f"query {key} is registered twice")
        REGISTRY[key] = Query(run, None if sql is None else (with_views(views, sql) if views else sql), covers)
        return run

    return register


def load() -> dict[str, Query]:
    """All queries, after importing the modules that register them."""
    from cratelight.plans import ingest, relational, scalars, scores, songs  # noqa: F401

    return REGISTRY

"""Every registered query against its SQL, and the others against invariants."""

import pytest

import __spark_entry__ as contract
from compare import connect, difference
from cratelight.plans.registry import load

REGISTRY = load()


@pytest.fixture(scope="module")
def db(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(n for n, q in REGISTRY.items() if q.sql is not None))
def test_equals_sql(spark, db, folder, name):
    assert difference(spark, db, name, REGISTRY[name], folder) is None


@pytest.mark.parametrize("name", sorted(n for n, q in REGISTRY.items() if q.sql is None))
def test_runs(spark, folder, name):
    assert REGISTRY[name].run(spark, folder).columns


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).columns[:3] == ["sid", "title", "artist"]


def test_map_has_ordered_variance(spark, folder):
    rows = REGISTRY["pca2"].run(spark, folder).collect()
    spread = [sum(getattr(r, c) ** 2 for r in rows) for c in ("component1", "component2")]
    assert spread[0] > spread[1] > 0

"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from salesloom.plans import propensity
from tests.compare import database, difference

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(SF)


# those that fit a model: here over a few rounds, registered over all of them
MODELS = {"propensity_scores", "oof_scores", "perm_importance", "fitted_metrics"}


def test_every_query_has_sql():
    assert set(entry.QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(set(entry.QUERIES) - MODELS))
def test_matches_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    assert difference(df, con, entry.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(MODELS))
def test_models_match_sql(spark, con, name, monkeypatch):
    assert propensity.ITERATIONS == 300
    monkeypatch.setattr(propensity, "ITERATIONS", 8)
    df = entry.queries()[name](spark, SF)
    assert difference(df, con, entry.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 1

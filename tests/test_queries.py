"""Every registered query against its SQL, at the smallest scale."""

import pytest

import __spark_entry__ as entry
from flowspark.catalog import QUERIES, SQL
from tests.compare import difference


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns[0] == "vec_id"


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf_dir, duck, name):
    assert difference(QUERIES[name](spark, sf_dir), duck, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, sf_dir, name):
    rows = QUERIES[name](spark, sf_dir).collect()
    assert rows
    if name == "reloaded_model":
        assert rows[0]["n_different"] == 0 and rows[0]["n"] > 0
    if name == "logistic_metrics":
        assert rows[0]["accuracy"] > 0.5
    if name == "random_forest_metrics":
        assert rows[0]["accuracy"] > 0.2
    if name == "tuning_trials":
        accuracies = [r["accuracy"] for r in sorted(rows)]
        assert accuracies == sorted(accuracies, reverse=True)


def test_twenty_tuning_trials(spark, sf_dir):
    rows = QUERIES["tuning_trials"](spark, sf_dir).collect()
    assert sorted(r["place"] for r in rows) == list(range(20))
    assert len({(r["reg_param"], r["max_iter"]) for r in rows}) == 20

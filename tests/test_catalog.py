"""Every registered query against its SQL on the smallest data."""

import pytest

import __spark_entry__ as entry
import parity
from fareloom.plans.catalog import QUERIES
from fareloom.plans.oracles import ORACLES

SLOW = {"fit_gbt", "fit_random_forest", "tune", "compare_models", "fit_boosted", "tune_boosted", "compare_families"}  # run by `tests/parity.py`
NO_SQL = ["latency_sketch", "bernoulli_sample", "fit_elastic_net", "score_gaps", "signature_sample"]


@pytest.fixture(scope="module")
def con(small):
    return parity.connect(small)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == {*NO_SQL, *SLOW}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, small, name):
    assert parity.compare(spark, con, small, QUERIES[name], ORACLES[name]) is None


@pytest.mark.parametrize("name", NO_SQL)
def test_query_without_sql_runs(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 3800

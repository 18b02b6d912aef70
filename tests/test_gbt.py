import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from fareloom.operators import gbt, models

X = ("a", "b", "c")


@pytest.fixture(scope="module")
def hills(spark):
    rng = np.random.default_rng(5)
    a, b, c = rng.uniform(0, 10, 2000), rng.integers(0, 20, 2000), rng.normal(size=2000)
    y = 5 * np.sin(a) + np.where(b > 12, 8.0, 0.0) + 2 * c + rng.normal(0, 0.5, 2000)
    rows = [(i, float(p), int(q), float(r), float(s)) for i, (p, q, r, s) in enumerate(zip(a, b, c, y))]
    df = spark.createDataFrame(rows, "id long, a double, b int, c double, fare_amount double")
    df = df.repartition(4, "id").cache()
    yield df
    df.unpersist()


def predictions(model, df):
    return {r["id"]: r["prediction"] for r in model.transform(df).collect()}


def in_passes(monkeypatch):
    """Several blocks and tasks, nodes in groups, residuals written."""
    for name, value in (("ALONE_ROWS", 0), ("BLOCK_ROWS", 300), ("PASS_NODES", 3), ("WRITE_EVERY", 2)):
        monkeypatch.setattr(gbt, name, value)


@pytest.mark.parametrize("passes", [False, True])
def test_the_trees_are_those_of_the_library(hills, monkeypatch, passes):
    if passes:
        in_passes(monkeypatch)
    flat = VectorAssembler(inputCols=list(X), outputCol="features").transform(hills)
    settings = {"labelCol": "fare_amount", "maxIter": 5, "maxDepth": 4, "stepSize": 0.2, "minInstancesPerNode": 15}
    theirs = predictions(GBTRegressor(**settings).fit(flat.where("id % 4 <> 0")), flat)
    ours = predictions(gbt.BoostedRegressor(**settings).fit(flat.where("id % 4 <> 0")), flat)
    assert len(ours) == 2000 and ours == pytest.approx(theirs, abs=1e-5)


def test_a_fit_on_few_rows_needs_no_job_per_level(hills):
    """Thirty trees are a few jobs: the time of a comparison was in starting them."""
    tracker = hills.sparkSession.sparkContext.statusTracker()
    hills.sparkSession.sparkContext.setJobGroup("few-rows", "")
    try:
        models.fit_gbt(hills, X, rounds=30)
        jobs = len(tracker.getJobIdsForGroup("few-rows"))
    finally:
        hills.sparkSession.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < jobs < 30


def test_trees_do_not_depend_on_partitions_and_are_kept(hills, monkeypatch, tmp_path):
    want = predictions(models.fit_gbt(hills, X, rounds=4), hills)
    in_passes(monkeypatch)
    model = models.fit_gbt(hills.repartition(7), X, rounds=4)
    assert predictions(model, hills) == want
    models.save_model(model, str(tmp_path / "model"))
    assert predictions(models.load_model(str(tmp_path / "model")), hills) == want


def test_bins_of_many_values(hills, monkeypatch):
    """Past VALUES a feature is cut at quantiles of all rows: as good as the rule on all values."""
    monkeypatch.setattr(gbt, "VALUES", 50)
    edges = gbt._edges(hills.select(*X), X)
    assert [len(e) for e in edges] == [31, 19, 31]
    assert models.holdout_rmse(models.fit_gbt(hills, X, rounds=30), hills) < 1.0


def test_odd_labels(spark):
    def fitted(labels):
        df = spark.createDataFrame([(float(i), y) for i, y in enumerate(labels)], "a double, fare_amount double")
        return predictions(models.fit_gbt(df, ("a",), rounds=3, min_child=1), df.selectExpr("*", "a AS id"))

    assert set(fitted([2.5] * 9).values()) == {2.5}
    assert set(fitted([1.0, float("inf"), None]).values()) == {float("inf")}
    # One label far off leaves the others their differences.
    near = fitted([0.0, 1.0] * 20 + [1e9])
    assert near[40.0] == pytest.approx(1e9) and abs(near[39.0]) < 1e3


def test_a_search_prepares_its_rows_once(hills, monkeypatch):
    prepared, begin = [], gbt._Prepared.__init__
    monkeypatch.setattr(gbt._Prepared, "__init__", lambda self, *a: prepared.append(1) or begin(self, *a))
    model, trials = models.tune(hills, X, rounds=2)
    assert len(prepared) == 2  # for all draws, and for the best one on all rows
    best = min(trials, key=lambda t: t["rmse"])
    assert model.stages[-1].getOrDefault("minInstancesPerNode") == best["min_child"]
    assert len(trials) == 4 and len({t["rmse"] for t in trials}) > 1

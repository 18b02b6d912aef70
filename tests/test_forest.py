import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from fareloom.operators import forest, models

X = ("a", "b", "c")


@pytest.fixture(scope="module")
def hills(spark):
    rng = np.random.default_rng(5)
    a, b, c = rng.uniform(0, 10, 3000), rng.integers(0, 20, 3000), rng.normal(size=3000)
    y = 5 * np.sin(a) + np.where(b > 12, 8.0, 0.0) + 2 * c + rng.normal(0, 0.5, 3000)
    rows = [(i, float(p), int(q), float(r), float(s)) for i, (p, q, r, s) in enumerate(zip(a, b, c, y))]
    df = spark.createDataFrame(rows, "id long, a double, b int, c double, fare_amount double")
    df = df.repartition(4, "id").cache()
    yield df.where("id % 4 <> 0"), df.where("id % 4 = 0")
    df.unpersist()


def predictions(model, df):
    return {r["id"]: r["prediction"] for r in model.transform(df).collect()}


def test_a_deep_forest_needs_no_pass_per_group_of_nodes(hills):
    """Thirty levels of small nodes are a few jobs, whatever the memory of a pass: a forest's time was in passes."""
    train, test = hills
    tracker = train.sparkSession.sparkContext.statusTracker()
    train.sparkSession.sparkContext.setJobGroup("deep-forest", "")
    try:
        model = models.fit_random_forest(train, X, trees=30, node_memory_mb=1)
        jobs = len(tracker.getJobIdsForGroup("deep-forest"))
    finally:
        train.sparkSession.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < jobs < 40
    grown = model.stages[-1].trees
    assert grown.count() == 30  # a row per tree, none on the driver
    deepest = max(len(r["feature"]) // 2 for r in grown.collect())
    assert deepest > 1000  # nodes: grown to few rows
    assert models.holdout_rmse(model, test) < 2.0


def test_as_good_as_the_library(hills):
    train, test = hills
    flat = VectorAssembler(inputCols=list(X), outputCol="features")
    library = RandomForestRegressor(labelCol="fare_amount", numTrees=40, maxDepth=12, seed=1, cacheNodeIds=True)
    theirs = library.fit(flat.transform(train)).transform(flat.transform(test))
    theirs = theirs.agg(F.sqrt(F.avg((F.col("prediction") - F.col("fare_amount")) ** 2))).first()[0]
    ours = models.holdout_rmse(models.fit_random_forest(train, X, trees=40, depth=12, seed=1), test)
    assert ours < 1.05 * theirs


def test_one_full_tree_of_distinct_rows_knows_its_labels():
    rng = np.random.default_rng(1)
    x = np.array([(i, j) for i in range(1, 21) for j in range(1, 21)], dtype=np.uint8)
    y, w = rng.normal(size=400) + 1e6 * (np.arange(400) == 7), np.ones(400)
    tree = forest._grown(x, y, w, 0, 1, 30, 1, 2, 33, 3)
    assert np.allclose(forest._scored(x, *tree), y, rtol=0, atol=1e-8)
    feature = tree[0]
    assert (feature >= 0).sum() == 399 and len(tree[2]) == 400
    shallow = forest._grown(x, y, w, 0, 1, 3, 1, 2, 33, 3)
    assert len(shallow[2]) <= 8
    large = forest._grown(x, y, w, 0, 1, 30, 25, 2, 33, 3)
    leaf = forest._scored(x, *large)
    assert min(np.unique(leaf, return_counts=True)[1]) >= 25
    # Rows that nothing tells apart, and labels that are all the same, are leaves.
    assert len(forest._grown(x[:1].repeat(50, 0), y[:50], w[:50], 0, 1, 30, 1, 2, 33, 3)[0]) == 1
    assert len(forest._grown(x, np.full(400, 0.1), w, 0, 1, 30, 1, 2, 33, 3)[0]) == 1


def test_small_nodes_cost_what_their_rows_cost(monkeypatch):
    """Most nodes have few rows; looking at all bins of each was most of a tree's time."""
    rng, looked_at, best = np.random.default_rng(6), [], forest._best_splits
    x, y = rng.integers(1, 33, (6000, 7)).astype(np.uint8), rng.normal(size=6000)
    monkeypatch.setattr(forest, "_best_splits", lambda n, *a: looked_at.append(n.size) or best(n, *a))
    feature, _, values = forest._grown(x, y, np.ones(6000), 0, 1, 30, 1, 3, 33, 3)
    assert 5900 < len(values) == (feature < 0).sum()
    assert sum(looked_at) < 300_000  # with all bins of every node 1.2 million


def test_nodes_grown_one_after_the_other_make_the_same_tree(monkeypatch):
    rng = np.random.default_rng(12)
    x, y, w = rng.integers(1, 12, (2000, 4)).astype(np.uint8), rng.normal(size=2000), rng.integers(1, 4, 2000) * 1.0
    sizes, real = [], forest._compact_splits
    monkeypatch.setattr(forest, "_compact_splits", lambda bins, *a: sizes.append(bins.shape[1]) or real(bins, *a))
    for depth, min_child in ((30, 1), (7, 1), (30, 5)):
        monkeypatch.setattr(forest, "NEAR_ROWS", 1 << 17)
        whole = forest._grown(x, y, w, 2, 3, depth, min_child, 2, 33, 3)
        monkeypatch.setattr(forest, "NEAR_ROWS", 60)
        sizes.clear()
        parts = forest._grown(x, y, w, 2, 3, depth, min_child, 2, 33, 3)
        assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(whole, parts))
        assert max(sizes) < 64  # rows of a step, or of one node


def test_empty_bins_change_no_split():
    rng = np.random.default_rng(7)
    for most, width, values in ((3, 33, 2), (1, 33, 1000), (2, 2, 3), (3, 34, 5)):
        sizes = rng.integers(2, 60, 500)
        node = np.repeat(np.arange(500), sizes)
        bins = rng.integers(0, width, (most, len(node))) * (rng.random((most, len(node))) < 0.7)
        w, y = rng.integers(1, 4, len(node)).astype(float), rng.integers(0, values, len(node)) * 0.1
        starts = np.cumsum(sizes) - sizes
        spread, off = np.add.reduceat(w * y * y, starts), w * y
        for min_child in (1, 9):
            want = forest._full_splits(bins, node, w, off, spread, min_child, width)
            got = forest._compact_splits(bins, node, w, off, starts, spread, min_child)
            found = want[0]
            assert (got[0] == found).all() and 0 < found.sum() or values == 1
            assert all((a[found] == b[found]).all() for a, b in zip(want[1:], got[1:]))


def test_first_split_is_the_best_one():
    rng = np.random.default_rng(2)
    x = rng.integers(1, 9, (300, 2)).astype(np.uint8)
    y, w = rng.normal(size=300) + 3 * (x[:, 1] > 5), rng.integers(1, 4, 300).astype(float)

    def left_over(f, cut):
        right = x[:, f] > cut
        return sum(
            (w[s] * (y[s] - np.average(y[s], weights=w[s])) ** 2).sum() for s in (right, ~right) if s.any()
        )

    feature, cut, value = forest._grown(x, y, w, 0, 1, 1, 1, 2, 33, 3)
    best = min(((f, c) for f in (0, 1) for c in range(1, 8)), key=lambda s: left_over(*s))
    assert (feature[0], cut[0]) == best
    right = x[:, best[0]] > best[1]
    assert value == pytest.approx([np.average(y[s], weights=w[s]) for s in (~right, right)])


def test_large_nodes_are_split_by_passes_into_the_same_trees(hills, monkeypatch):
    train, test = hills
    whole = models.fit_random_forest(train, X, trees=5, depth=9)
    monkeypatch.setattr(forest, "TASK_ROWS", 150)
    parts = models.fit_random_forest(train, X, trees=5, depth=9, node_memory_mb=1)
    assert max(len(t["heap"]) for t in parts.stages[-1].tops) > 20
    a = predictions(whole, test)
    monkeypatch.setattr(forest, "SCORE_ROWS", 64)
    monkeypatch.setattr(forest, "SCORE_BLOCKS", 3)
    b = predictions(parts, test)
    assert a.keys() == b.keys() and all(a[i] == pytest.approx(b[i]) for i in a)
    # A pass that has no room but for one node changes nothing.
    monkeypatch.setattr(forest, "TASK_ROWS", 1200)
    few = models.fit_random_forest(train, X, trees=2, depth=4, node_memory_mb=0)
    monkeypatch.setattr(forest, "TASK_ROWS", 1 << 17)
    all_ = models.fit_random_forest(train, X, trees=2, depth=4)
    a, b = predictions(few, test), predictions(all_, test)
    assert all(a[i] == pytest.approx(b[i]) for i in a)


def test_large_leaves_and_depth(spark, monkeypatch):
    """A node of many rows that cannot be split, and one at the last level."""
    monkeypatch.setattr(forest, "TASK_ROWS", 10)
    rows = [(i, float(i % 2), float(i % 2)) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, a double, fare_amount double")
    assert models.holdout_rmse(models.fit_random_forest(df, ("a",), trees=3), df) < 1e-9
    flat = models.fit_random_forest(df, ("a",), trees=3, depth=0)
    assert all(len(t["heap"]) == 1 for t in flat.stages[-1].tops)
    assert models.holdout_rmse(flat, df) == pytest.approx(0.5, abs=0.05)


def test_saved_and_read_again_and_rerun(hills, tmp_path):
    train, test = hills
    model = models.fit_random_forest(train, X, trees=4, depth=6)
    models.save_model(model, str(tmp_path / "forest"))
    models.save_model(model, str(tmp_path / "forest"))
    again = models.load_model(str(tmp_path / "forest"))
    want = predictions(model, test)
    assert predictions(again, test) == want
    assert predictions(models.fit_random_forest(train, X, trees=4, depth=6), test) == want
    other = predictions(models.fit_random_forest(train, X, trees=4, depth=6, seed=9), test)
    assert other != want


def test_odd_rows(spark):
    rows = [(1, None, 2.0), (2, 3.0, None), (3, float("nan"), 4.0), (3, float("nan"), 4.0), (4, float("inf"), 6.0)]
    df = spark.createDataFrame(rows, "id long, a double, fare_amount double")
    model = models.fit_random_forest(df, ("a",), trees=25)
    out = models.apply_model(df, model, ("a",)).collect()
    assert len(out) == 5 and all(2.0 <= r["prediction"] <= 6.0 for r in out)
    one = df.where("id = 1")
    assert models.fit_random_forest(one, ("a",), trees=2).transform(one).first()["prediction"] == 2.0
    assert model.transform(df.limit(0)).count() == 0
    with pytest.raises(Exception):
        models.fit_random_forest(df.where("id = 2"), ("a",), trees=2)


def test_comparison_takes_the_forest(hills):
    train, test = hills
    params = {"random_forest": {"trees": 10}, "gbt": {"rounds": 3}}
    rows = models.compare_models(train, test, X, params=params).collect()
    assert {r["model"] for r in rows} == set(models.MODELS)
    assert rows[0]["model"] == "random_forest" and rows[0]["rmse"] < 2.0
    assert isinstance(models.MODELS["random_forest"](), forest.ForestRegressor)

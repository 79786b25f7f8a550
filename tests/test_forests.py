"""Forests grown tree by tree in tasks: splits by brute force, scores against Spark's reading of the same forest."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from verbatide.operators import forests as R
from verbatide.operators import models as M
from workload import ALL


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i, p in enumerate(rng.normal(0, 1, (160, 3)).round(3)):
        label = float((p[0] > 0) + 2 * (p[1] > 0.3))
        rows.append((i, p.tolist(), label, 0.5 if label else 2.0))
    df = spark.createDataFrame(rows, f"vec_id long, x array<double>, {M.LABEL} double, w double")
    return df.withColumn(M.FEATURES, array_to_vector("x")).persist()


def test_thresholds_are_sparks():
    assert R.thresholds(np.array([3.0, 1.0, 1.0, 2.0]), np.ones(4), 32).tolist() == [1.5, 2.5]
    rng = np.random.default_rng(1)
    values, weights = rng.integers(0, 90, 500).astype(float), rng.integers(1, 4, 500).astype(float)
    met = sorted(set(values))
    sizes = [weights[values == v].sum() for v in met]
    stride, target, current, want = sum(sizes) / 8, sum(sizes) / 8, sizes[0], []
    for i in range(1, len(met)):
        before, current = current, current + sizes[i]
        if abs(before - target) < abs(current - target):
            want.append((met[i - 1] + met[i]) / 2)
            target += stride
    assert R.thresholds(values, weights, 8).tolist() == want and len(want) == 7
    assert R.thresholds(np.full(9, 4.0), np.ones(9), 8).tolist() == []


def test_best_splits_are_the_brute_force_s(monkeypatch):
    rng = np.random.default_rng(2)
    x, y, w = rng.integers(0, 5, (60, 4)).astype(np.uint8), rng.integers(0, 3, 60), rng.integers(1, 4, 60).astype(float)
    node, bins, subsets = np.sort(rng.integers(0, 4, 60)), np.array([5, 5, 5, 5]), np.array([[0, 2], [3, 1], [1, 0], [2, 3]])
    stats = np.bincount(node * 3 + y, w, 12).reshape(4, 3)
    gini = lambda at: 1 - sum((w[at][y[at] == c].sum() / w[at].sum()) ** 2 for c in range(3))
    for cells in (1 << 21, 1):  # all nodes together, and one at a time
        monkeypatch.setattr(R, "CELLS", cells)
        gains, _, _ = R._best_splits(x, y, w, node, stats, subsets, bins)
        for k in range(4):
            own, best = node == k, 0.0
            for f in subsets[k]:
                for b in range(4):
                    low, high = own & (x[:, f] <= b), own & (x[:, f] > b)
                    if low.any() and high.any():
                        best = max(best, gini(own) - (w[low].sum() * gini(low) + w[high].sum() * gini(high)) / w[own].sum())
            assert gains[k] == pytest.approx(best)


def test_spark_reads_and_scores_the_same_forest(spark, points, monkeypatch):
    """Also where rows are scored a few at a time, and under any partitioning."""
    forest = M.random_forest(trees=5, depth=6, weight="w", seed=4, grown=True)
    ours = forest.fit(points)
    assert isinstance(ours, M.ForestModel)
    theirs = RandomForestClassificationModel.load(M.save_trees(ours))
    assert theirs.getNumTrees == 5 and max(t.depth for t in theirs.trees) <= 6
    assert ours.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray())
    read = lambda model: {r[0]: (r[1], r[2].toArray().tolist()) for r in model.transform(points).select("vec_id", "prediction", "probability").collect()}
    want = read(theirs)
    monkeypatch.setattr(R, "BINNED_ROWS", 200)
    got = read(ours)
    monkeypatch.undo()
    assert len(got) == 160
    for key, (label, shares) in got.items():
        assert label == want[key][0] and shares == pytest.approx(want[key][1])
    nodes = lambda model: sorted(map(tuple, model.table.select("tree", "feature", "cut", "left").collect()))
    assert nodes(forest.fit(points.repartition(5))) == nodes(ours)
    assert M.accuracy_evaluator().evaluate(ours.transform(points)) > 0.95


def test_forest_grid_is_that_of_cut_forests(spark, points):
    """each point is scored in the walk through the whole trees, as the cut forest scores."""
    fitted = M.random_forest(6, 5, seed=42, grown=True).fit(points)
    path, grid = M.save_trees(fitted), [(2, 1), (2, 4), (6, 3), (6, 5)]
    right = (F.col("prediction") == F.col(M.LABEL)).cast("double")
    want = [M.cut_forest(path, *point).transform(points).agg(F.avg(right)).first()[0] for point in grid]
    assert M._point_scores(fitted, points, grid) == pytest.approx(want)


def _no_fit(self, rows):
    raise AssertionError("fitted as one model on the driver")


def test_elimination_grows_its_forests_in_tasks(spark, points, monkeypatch):
    """F3"""
    monkeypatch.setattr(R.SparkForest, "_fit", _no_fit)
    rounds = M.eliminate_features(points, 3, folds=2, trees=4, step=2).orderBy("round").collect()
    assert [r["features"] for r in rounds] == [3, 1] and rounds[0]["roc_auc"] > 0.8


def test_the_driver_holds_no_drawn_forest(spark, sf_dir, monkeypatch):
    """F4"""
    monkeypatch.setattr(R.SparkForest, "_fit", _no_fit)
    monkeypatch.setattr(M, "random_forest_draws", lambda: {"trees": [2, 3], "features": [2, 64]})
    assert ALL["rf_draws_cv"].run(spark, sf_dir).count() == 2


@pytest.mark.parametrize("name, value", [("w", "CAST(NULL AS double)"), (M.LABEL, "0.5D"), ("x", "array(1D, double('nan'), 0D)")])
def test_rows_that_spark_rejects_are_still_rejected(spark, points, name, value):
    bad = points.withColumn(name, F.expr(value)).withColumn(M.FEATURES, array_to_vector("x"))
    with pytest.raises(Exception):
        M.random_forest(trees=2, depth=2, weight="w", grown=True).fit(bad)


def test_wide_vectors_are_left_to_spark(spark, points, monkeypatch):
    monkeypatch.setattr(R, "MAX_WIDTH", 2)
    assert isinstance(M.random_forest(trees=2, depth=2, grown=True).fit(points), RandomForestClassificationModel)

"""Metrics against Spark's own RDD-based classes and hand-worked values."""

import pytest
from pyspark.mllib.evaluation import BinaryClassificationMetrics, MulticlassMetrics
from pyspark.sql import functions as F

from verbatide.operators import metrics as M

PAIRS = [(0, 0), (0, 1), (1, 1), (2, 1), (2, 2), (0, 2)]


@pytest.fixture(scope="module")
def small(spark):
    return spark.createDataFrame([(float(p), float(t)) for p, t in PAIRS], "prediction double, label double")


@pytest.fixture(scope="module")
def big(spark):
    score = F.round(F.rand(3), 3)
    rows = spark.range(4000).select(score.alias("score"), F.rand(5).alias("u"))
    return rows.select("score", (F.col("u") < F.col("score")).cast("double").alias("label"))


def test_by_class(spark, small):
    want = MulticlassMetrics(small.rdd.map(tuple))
    rows = {r["class"]: r for r in M.per_class(small).collect()}
    assert set(rows) == {0.0, 1.0, 2.0}
    for label, row in rows.items():
        assert row["precision"] == pytest.approx(want.precision(label))
        assert row["recall"] == pytest.approx(want.recall(label))
        assert row["fpr"] == pytest.approx(want.falsePositiveRate(label))
        assert row["f1"] == pytest.approx(want.fMeasure(label, 1.0))
    assert M.accuracy(small).first()[0] == pytest.approx(0.5)


def test_confusion_matrix(spark, small):
    rows = {r["label"]: list(r)[1:] for r in M.confusion_matrix(small, [0.0, 1.0, 2.0]).collect()}
    want = MulticlassMetrics(small.rdd.map(tuple)).confusionMatrix().toArray().astype(int).tolist()
    assert [rows[float(i)] for i in range(3)] == want


def test_never_predicted_class_has_zero_precision(spark):
    df = spark.createDataFrame([(0.0, 1.0), (0.0, 0.0), (5.0, 0.0)], "prediction double, label double")
    rows = {r["class"]: r for r in M.per_class(df).collect()}
    assert rows[1.0]["precision"] == 0.0 and rows[1.0]["f1"] == 0.0
    assert 5.0 not in rows  # predicted, but nobody's class
    report = {r["class"]: r for r in M.classification_report(df).collect()}
    assert report["5.0"]["support"] == 0 and report["accuracy"]["f1"] == pytest.approx(0.3333)
    assert report["weighted avg"]["support"] == 3


def test_areas(spark, big):
    want = BinaryClassificationMetrics(big.select("score", "label").rdd.map(tuple))
    table = M.threshold_table(big, "score", F.col("label") > 0.5)
    row = M.areas(table).first()
    assert row["area_under_roc"] == pytest.approx(want.areaUnderROC, abs=1e-9)
    assert row["area_under_pr"] == pytest.approx(want.areaUnderPR, abs=1e-9)


def test_curves(spark):
    rows = [(0.9, 1), (0.9, 0), (0.5, 1), (0.1, 0)]
    df = spark.createDataFrame(rows, "score double, label int")
    table = M.threshold_table(df, "score", F.col("label") == 1)
    got = {r["threshold"]: r for r in M.threshold_metrics(table).collect()}
    assert [got[0.9][c] for c in ("precision", "recall", "fpr")] == [0.5, 0.5, 0.5]
    assert got[0.5]["precision"] == pytest.approx(2 / 3) and got[0.5]["recall"] == 1.0
    # The two betas differ; a precision above the recall pulls the half one up.
    assert got[0.1]["f_beta_1_0"] == pytest.approx(2 / 3)
    assert got[0.1]["f_beta_0_5"] == pytest.approx(1.25 * 0.5 / (0.25 * 0.5 + 1))
    assert sorted(map(tuple, M.roc_curve(table).collect())) == [(0, 0), (0.5, 0.5), (0.5, 1), (1, 1), (1, 1)]
    assert (0.0, 0.5) in set(map(tuple, M.pr_curve(table).collect()))
    assert sorted(r[0] for r in M.thresholds(table).collect()) == [0.1, 0.5, 0.9]


def test_one_class_only(spark):
    df = spark.createDataFrame([(0.3, 1), (0.2, 1)], "score double, label int")
    table = M.threshold_table(df, "score", F.col("label") == 1)
    assert {r["fpr"] for r in M.threshold_metrics(table).collect()} == {0.0}
    assert M.areas(table).first()["area_under_pr"] == pytest.approx(1.0)

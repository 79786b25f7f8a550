"""Evaluation of predictions as aggregates over a (prediction, label) table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verbatide.operators.ordering import running_totals


def accuracy(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    return df.agg(F.avg((F.col(prediction) == F.col(label)).cast("double")).alias("accuracy"))


def pair_counts(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """(label, prediction, n): all class metrics come from this table of classes squared rows."""
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count("*").alias("n")
    )


def confusion_matrix(
    df: DataFrame, classes: Sequence, prediction: str = "prediction", label: str = "label"
) -> DataFrame:
    """One row per actual class, one ``predicted_<class>`` column per class."""
    pairs = pair_counts(df, prediction, label)
    cells = [
        F.sum(F.when(F.col("prediction") == c, F.col("n")).otherwise(0)).alias(f"predicted_{c}")
        for c in classes
    ]
    return pairs.groupBy("label").agg(*cells)


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(0.0)


def _class_totals(df: DataFrame, prediction: str, label: str) -> DataFrame:
    """Support, times predicted and true positives per class, plus the number of rows."""
    pairs = pair_counts(df, prediction, label)
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    zero = F.lit(0).cast("long")
    sides = F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("s"), zero.alias("p"), hit.alias("t")),
        F.struct(F.col("prediction").alias("class"), zero.alias("s"), F.col("n").alias("p"), zero.alias("t")),
    )
    totals = pairs.select(F.inline(sides)).groupBy("class").agg(
        F.sum("s").alias("support"), F.sum("p").alias("predicted"), F.sum("t").alias("tp")
    )
    return totals.withColumn("_rows", F.sum("support").over(Window.partitionBy()))  # one row per class


def per_class(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """Precision, recall, false-positive rate and F1 of each actual class."""
    totals = _class_totals(df, prediction, label).where(F.col("support") > 0)
    precision = _ratio(F.col("tp"), F.col("predicted"))
    recall = _ratio(F.col("tp"), F.col("support"))
    fpr = _ratio(F.col("predicted") - F.col("tp"), F.col("_rows") - F.col("support"))
    rates = totals.select(
        "class", precision.alias("precision"), recall.alias("recall"), fpr.alias("fpr"), "support"
    )
    return rates.withColumn("f1", _f_measure(1.0))


def _f_measure(beta: float) -> Column:
    p, r, b = F.col("precision"), F.col("recall"), beta * beta
    return F.when(p + r > 0, (1 + b) * p * r / (b * p + r)).otherwise(0.0)


def classification_report(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """Per-class rows and the rows ``accuracy``, ``macro avg`` and ``weighted avg``, four digits."""
    totals = _class_totals(df, prediction, label)
    rates = totals.select(
        F.col("class").cast("string").alias("class"),
        _ratio(F.col("tp"), F.col("predicted")).alias("precision"),
        _ratio(F.col("tp"), F.col("support")).alias("recall"),
        "support",
        "tp",
    ).withColumn("f1", _f_measure(1.0))
    names = ["precision", "recall", "f1"]
    none = F.lit(None).cast("double")
    support = F.sum("support").alias("support")
    overall = rates.agg(
        none.alias("precision"), none.alias("recall"), (F.sum("tp") / F.sum("support")).alias("f1"), support
    )
    macro = rates.agg(*[F.avg(n).alias(n) for n in names], support)
    weighted = rates.agg(*[(F.sum(F.col(n) * F.col("support")) / F.sum("support")).alias(n) for n in names], support)
    rows = rates.select("class", *names, "support")
    for name, table in (("accuracy", overall), ("macro avg", macro), ("weighted avg", weighted)):
        rows = rows.unionByName(table.withColumn("class", F.lit(name)))
    return rows.select("class", *[F.round(n, 4).alias(n) for n in names], "support")


# Threshold curves --------------------------------------------------------------------------------


def threshold_table(df: DataFrame, score: str, positive: Column) -> DataFrame:
    """One row per distinct score, from the highest: rows at or above it (``tp``, ``fp``), the
    score's own rows (``own_tp``, ``own_fp``), and all positives and negatives.

    The other curves and both areas are read off this table. With the predicted class as score
    and ``label > 0.5`` as positive it is the binary view of a multi-class prediction.
    """
    points = df.groupBy(F.col(score).alias("threshold")).agg(
        F.count_if(positive).alias("own_tp"), F.count_if(~positive).alias("own_fp")
    )
    totals = running_totals(points, [F.desc("threshold")], {"own_tp": "tp", "own_fp": "fp"})
    return totals.withColumnsRenamed({"tp_all": "positives", "fp_all": "negatives"})


def _rates(tp: Column, fp: Column) -> tuple[Column, Column, Column]:
    precision = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(1.0)
    return precision, _ratio(tp, F.col("positives")), _ratio(fp, F.col("negatives"))


def threshold_metrics(table: DataFrame, betas: Sequence[float] = (1.0, 0.5)) -> DataFrame:
    """Precision, recall, false-positive rate and F-beta by threshold."""
    precision, recall, fpr = _rates(F.col("tp"), F.col("fp"))
    rates = table.select("threshold", precision.alias("precision"), recall.alias("recall"), fpr.alias("fpr"))
    return rates.select("*", *[_f_measure(b).alias(f"f_beta_{b}".replace(".", "_")) for b in betas])


def thresholds(table: DataFrame) -> DataFrame:
    return table.select("threshold")


def roc_curve(table: DataFrame) -> DataFrame:
    """(fpr, tpr) points between the corners (0, 0) and (1, 1)."""
    _, recall, fpr = _rates(F.col("tp"), F.col("fp"))
    corners = table.sparkSession.createDataFrame([(0.0, 0.0), (1.0, 1.0)], "fpr double, tpr double")
    return table.select(fpr.alias("fpr"), recall.alias("tpr")).unionByName(corners)


def pr_curve(table: DataFrame) -> DataFrame:
    """(recall, precision) points, starting at recall 0 with the first threshold's precision."""
    precision, recall, _ = _rates(F.col("tp"), F.col("fp"))
    first = table.agg(F.max_by(precision, "threshold").alias("precision"))
    first = first.select(F.lit(0.0).alias("recall"), "precision")
    return table.select(recall.alias("recall"), precision.alias("precision")).unionByName(first)


def areas(table: DataFrame) -> DataFrame:
    """Areas under both curves by trapezoids.

    The point before a threshold is its running total less its own rows, so no row needs its
    neighbour and the sum runs in any order.
    """
    precision, recall, fpr = _rates(F.col("tp"), F.col("fp"))
    tp0, fp0 = F.col("tp") - F.col("own_tp"), F.col("fp") - F.col("own_fp")
    precision0, recall0, fpr0 = _rates(tp0, fp0)
    first = (tp0 + fp0) == 0
    pr0 = F.when(first, precision).otherwise(precision0)
    return table.agg(
        F.sum((fpr - fpr0) * (recall + recall0) / 2).alias("area_under_roc"),
        F.sum((recall - recall0) * (precision + pr0) / 2).alias("area_under_pr"),
    )

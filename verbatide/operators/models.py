"""Clustering, classification and tuning with Spark ML, and the parts that are plain aggregates."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LinearSVC,
    NaiveBayes,
    OneVsRest,
    RandomForestClassificationModel,
)
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import Evaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from verbatide.operators.forests import ForestModel, RandomForestClassifier, SparkForest, predicted
from verbatide.operators.frequency import class_distribution, term_counts
from verbatide.operators.rowsets import key_number
from verbatide.operators.sizing import small_rows
from verbatide.operators.skew import COMMON, common_entries, lookup_join
from verbatide.session import materialise, scratch_path

MAX_DEPTH = 30  # Spark's own limit
MAX_CLASSES = 1000
MAX_WEIGHTS = 2_000_000  # numbers of a model's common terms that are broadcast
BINNED = 512 << 20  # bytes of binned rows that a task of a tree's fit reads
NODE_MEMORY = 512  # MB of statistics that a task of a tree's fit holds: how many nodes one pass over the rows splits
LABEL, FEATURES = "indexedLabel", "rawFeatures"
TREES = (DecisionTreeClassifier, SparkForest)


# Estimators with the defaults of the analyses they serve -----------------------------------------


def naive_bayes(smoothing: float = 0.1, kind: str = "multinomial", features: str = FEATURES) -> NaiveBayes:
    return NaiveBayes(labelCol=LABEL, featuresCol=features, smoothing=smoothing, modelType=kind)


def decision_tree(
    bins: int = 200, depth: int = 30, impurity: str = "gini", min_leaf: int = 1, seed: int = 5043
) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(
        labelCol=LABEL, featuresCol=FEATURES, maxBins=bins, maxDepth=depth, impurity=impurity,
        minInstancesPerNode=min_leaf, seed=seed, maxMemoryInMB=NODE_MEMORY, cacheNodeIds=True,
    )


def random_forest(
    trees: int = 150, depth: int = 30, subset: str = "auto", weight: str | None = None, seed: int = 5043, grown: bool = False
) -> SparkForest:
    """Spark's forest; with ``grown`` whole trees are grown in tasks and stay a table, by other draws of the same kind."""
    if depth > MAX_DEPTH:
        raise ValueError(f"Spark's trees have a depth of at most {MAX_DEPTH}")
    kind = RandomForestClassifier if grown else SparkForest
    forest = kind(
        labelCol=LABEL, featuresCol=FEATURES, numTrees=trees, maxDepth=depth,
        impurity="gini", featureSubsetStrategy=subset, seed=seed, maxMemoryInMB=NODE_MEMORY, cacheNodeIds=True,
    )
    return forest.setWeightCol(weight) if weight else forest


def kmeans(k: int = 5, iterations: int = 50, features: str = FEATURES, seed: int = 5043) -> KMeans:
    return KMeans(k=k, maxIter=iterations, seed=seed, featuresCol=features, predictionCol="cluster")


def accuracy_evaluator(label: str = LABEL) -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction", metricName="accuracy")


class RestAreaEvaluator(Evaluator):
    """Area under the ROC curve; of several classes the mean of each against the rest.

    Classes without rows are left out; rows of one class alone have no area (nan).
    """

    def _evaluate(self, dataset: DataFrame) -> float:
        areas = rest_areas(dataset, LABEL, vector_to_array("probability")).collect()
        # Two classes have one curve: the second class against the first.
        if len(areas) == 2 and max(r["class"] for r in areas) <= 1:
            areas = [r for r in areas if r["class"] == 1]
        found = [r["area"] for r in areas if r["area"] is not None]
        return float(np.mean(found)) if found else float("nan")

    def isLargerBetter(self) -> bool:
        return True


def rest_areas(scored: DataFrame, label: str, scores: Column) -> DataFrame:
    """(class, area) for every class met: the exact area under its ROC curve against all other rows.

    ``scores`` is an array with a score per class number; a class beyond it has score 0. Equal scores are
    counted together first, and one window over them gives all classes; without other classes the area is null.
    """
    rows = scored.where(F.col(label).isNotNull()).select(F.col(label).cast("int").alias("_y"), scores.alias("_p"))
    met = rows.groupBy("_y").agg(F.count("*").alias("n")).select(F.col("_y").alias("class"))
    classes = F.array_sort(F.collect_set("class")).alias("classes")
    known = [int(c) for c in (met.agg(classes).first()["classes"] or [])]
    each = [
        F.struct(F.lit(c).alias("class"), F.coalesce(F.get("_p", F.lit(c)), F.lit(0.0)).alias("score"), (F.col("_y") == c).cast("long").alias("hit"))
        for c in known
    ]
    kinds = "array<struct<class:int,score:double,hit:bigint>>"
    cells = rows.select(F.inline(F.array(*each).cast(kinds)))
    steps = cells.groupBy("class", "score").agg(F.sum("hit").alias("hits"), (F.count("*") - F.sum("hit")).alias("misses"))
    below = Window.partitionBy("class").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    steps = steps.withColumn("below", F.coalesce(F.sum("misses").over(below), F.lit(0)))
    won = F.sum(F.col("hits") * (F.col("below") + F.col("misses") / 2))
    pairs = F.sum("hits").cast("double") * F.sum("misses")
    return steps.groupBy("class").agg(F.when(pairs > 0, won / pairs).alias("area"))


# Class weights -------------------------------------------------------------------------------------


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights n / (classes · n_class), one row per class."""
    everything = Window.partitionBy()  # over one row per class
    counts = class_distribution(df, label)
    weight = F.sum("n").over(everything) / (F.count("*").over(everything) * F.col("n"))
    return counts.select(label, "n", weight.alias("weight"))


def with_class_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Add each row's class weight, null for rows without a class. Rows of common classes are dealt
    over several tasks."""
    weights = class_weights(df, label)
    one = weights.select(label, F.col("weight").alias(name))
    return lookup_join(df.drop(name), one, label, weights.select(label, "n"), "left").select(*df.drop(name).columns, name)


# Rows of tree fits ---------------------------------------------------------------------------------


def dealt_for_trees(rows: DataFrame, width: int) -> DataFrame:
    """``rows`` (persisted), dealt anew where a task would read more than ``BINNED`` bytes.

    A tree's fit keeps four bytes for each of the ``width`` features of a row, however few are not zero, and reads
    them again at every level: a small partition of texts becomes a large one.
    """
    most = max(1, BINNED // (4 * max(width, 1)))
    sizes = rows.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"))
    largest, total = sizes.agg(F.max("n"), F.sum("n")).first()
    return rows.repartition(math.ceil(total / most)) if (largest or 0) > most else rows


# Naive Bayes as aggregates ---------------------------------------------------------------------------


def class_log_priors(df: DataFrame, label: str, smoothing: float = 0.1) -> DataFrame:
    """ln((n_class + s) / (n + s · classes)) per class."""
    everything = Window.partitionBy()  # over one row per class
    counts = class_distribution(df, label)
    total = F.sum("n").over(everything) + smoothing * F.count("*").over(everything)
    return counts.select(label, F.log((F.col("n") + smoothing) / total).alias("log_prior"), "n")


@dataclass(frozen=True)
class TermModel:
    """A linear text model: a class's score is its base plus, for each term of the text, the term's
    value times ``weights[class]``. ``terms(term, weights)`` stays a table however many terms there are."""

    classes: list[str]
    base: list[float]
    terms: DataFrame

    def log_weights(self, label: str) -> DataFrame:
        """(term, class, weight), one row for every term and class."""
        cells = [
            F.struct(F.lit(c).alias(label), F.col("weights")[i].alias("log_p"))
            for i, c in enumerate(self.classes)
        ]
        return self.terms.select("term", F.inline(F.array(*cells)))

    def predict(self, keys: DataFrame, key: str, values: DataFrame) -> DataFrame:
        """The best class of every row of ``keys``, from ``values(key, term, value)`` with no value below
        zero. Terms the model has not seen count nothing; ties go to the first class."""
        # The filter, which the join on the key would add to one use only, and the count through the
        # value keep both uses of ``values`` alike, so its shuffle runs once.
        values = values.where(F.col(key).isNotNull())
        counts = values.groupBy("term").agg(F.count_if(F.col("value") >= 0).alias("n"))
        size = len(self.classes)
        common = common_entries(self.terms, "term", counts, max(1, min(COMMON, MAX_WEIGHTS // max(size, 1))))
        # Common terms are summed where their text lies; what leaves is a row of these sums for each text
        # and a row for each of its other terms, which are looked up by shuffle.
        met = values.join(F.broadcast(common.withColumnRenamed("weights", "_near")), "term", "left")
        term = F.when(F.col("_common").isNull(), F.col("term")).alias("term")
        near = [F.sum(F.col("value") * F.col("_near")[i]).alias(f"_near{i}") for i in range(size)]
        left = met.groupBy(key, term).agg(F.sum("value").alias("value"), *near)
        others = counts.join(F.broadcast(common.select("term")), "term", "left_anti")
        joined = lookup_join(left, self.terms, "term", others, "left")
        both = [F.coalesce(F.col("value") * F.col("weights")[i], f"_near{i}") for i in range(size)]
        scored = keys.select(key).join(joined.groupBy(key).agg(*[F.sum(b).alias(f"_{i}") for i, b in enumerate(both)]), key, "left")
        options = [
            F.struct((F.coalesce(f"_{i}", F.lit(0.0)) + base).alias("score"), F.lit(-i), F.lit(c).alias("class"))
            for i, (c, base) in enumerate(zip(self.classes, self.base))
        ]
        return scored.select(key, F.array_max(F.array(*options))["class"].alias("prediction"))


def _class_rows(df: DataFrame, label: str, smoothing: float) -> list[Row]:
    rows = small_rows(class_log_priors(df, label, smoothing), MAX_CLASSES)
    if rows is None:
        raise ValueError(f"{label} has more than {MAX_CLASSES} classes")
    return sorted(rows, key=lambda row: row[label])


def _counts_by_class(counts: DataFrame, label: str, classes: list, n: Column) -> DataFrame:
    """One row per term, one count column ``_0, _1, …`` per class. Classes as columns give the zero
    counts without joining terms with classes."""
    cells = [F.sum(F.when(F.col(label) == c, n).otherwise(0)).alias(f"_{i}") for i, c in enumerate(classes)]
    return counts.groupBy("term").agg(*cells)


def fit_multinomial(df: DataFrame, label: str, words: Column, smoothing: float = 0.1) -> TermModel:
    """Multinomial naive Bayes over all terms: weights ln((n_term,class + s) / (n_class + s · terms)).

    Fitting is one pass over the texts; the counted terms are materialised, for scoring rereads them.
    """
    rows = _class_rows(df, label, smoothing)
    classes = [row[label] for row in rows]
    counts = term_counts(df.where(F.col(label).isNotNull()), words, "term", [label])
    return _multinomial(rows, _counts_by_class(counts, label, classes, F.col("n")), smoothing, classes)


def fit_multinomial_values(
    keys: DataFrame, key: str, label: str, values: DataFrame, smoothing: float = 1.0
) -> TermModel:
    """The same model on weights instead of counts, from ``values(key, term, value)``."""
    rows = _class_rows(keys, label, 0.0)
    classes = [row[label] for row in rows]
    joined = values.join(keys.select(key, label), key)
    return _multinomial(rows, _counts_by_class(joined, label, classes, F.col("value")), smoothing, classes)


def _multinomial(rows: list[Row], wide: DataFrame, smoothing: float, classes: list) -> TermModel:
    wide = materialise(wide)
    totals = wide.agg(F.count("*"), *[F.sum(f"_{i}") for i in range(len(classes))]).first()
    terms, sizes = totals[0], [n or 0 for n in totals[1:]]
    weights = [F.log((F.col(f"_{i}") + smoothing) / (n + smoothing * terms)) for i, n in enumerate(sizes)]
    return TermModel(classes, [row["log_prior"] for row in rows], wide.select("term", F.array(*weights).alias("weights")))


def fit_bernoulli(
    keys: DataFrame, key: str, label: str, values: DataFrame, threshold: float = 0.1, smoothing: float = 1.0
) -> TermModel:
    """Bernoulli naive Bayes on ``values(key, term, value)``, a term being present above ``threshold``.

    Absent terms count too: every term's ln(1 - p) is part of the base and a present term's weight
    is ln p - ln(1 - p), so a text needs only its own terms. Priors are plain class shares.
    """
    rows = _class_rows(keys, label, 0.0)
    classes, sizes = [row[label] for row in rows], [row["n"] for row in rows]
    present = F.when(F.col("value") > threshold, 1).otherwise(0)
    joined = values.join(keys.select(key, label), key)
    wide = materialise(_counts_by_class(joined, label, classes, present))
    share = [(F.col(f"_{i}") + smoothing) / (F.lit(n) + 2 * smoothing) for i, n in enumerate(sizes)]
    absent = wide.agg(*[F.sum(F.log(1 - p)) for p in share]).first()
    base = [row["log_prior"] + (absent[i] or 0.0) for i, row in enumerate(rows)]
    weights = F.array(*[F.log(p) - F.log(1 - p) for p in share]).alias("weights")
    return TermModel(classes, base, wide.select("term", weights))


# Clusters ----------------------------------------------------------------------------------------------


def cluster_terms(assigned: DataFrame, cluster: str, words: Column, k: int = 20) -> DataFrame:
    """The k terms with the largest coordinates in each cluster's centre.

    A centre is the mean of its members' counts, so a term's coordinate is its occurrences in the
    cluster over the cluster's size. Counting terms keeps their names, which hashed columns lose.
    """
    counts = term_counts(assigned, words, "term", [cluster])
    order = Window.partitionBy(cluster).orderBy(F.desc("n"), F.asc("term"))
    top = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    sizes = assigned.groupBy(cluster).agg(F.count("*").alias("size"))
    return top.join(sizes, cluster).select(
        cluster, "rank", "term", (F.col("n") / F.col("size")).alias("weight")
    )


# Tuning --------------------------------------------------------------------------------------------------


def grid(**values: tuple) -> list[dict]:
    """``grid(smoothing=(nb.smoothing, [0.1, 1.0]))`` as a list of param maps."""
    builder = ParamGridBuilder()
    for param, choices in values.values():
        builder = builder.addGrid(param, list(choices))
    return builder.build()


def cross_validate(
    estimator: Estimator,
    param_maps: list[dict],
    train: DataFrame,
    folds: int = 3,
    evaluator: Evaluator | None = None,
    seed: int = 5043,
    parallelism: int = 8,
    key: str | None = None,
) -> CrossValidatorModel:
    """With ``key`` a row's fold is a hash of that column: the same under any partitioning."""
    validator = CrossValidator(
        estimator=estimator, estimatorParamMaps=param_maps, evaluator=evaluator or accuracy_evaluator(),
        numFolds=folds, seed=seed, parallelism=parallelism,
    )
    if key:
        train = train.withColumn("fold", fold_of(key, folds, seed))
        validator = validator.setFoldCol("fold")
    return validator.fit(train)


def fold_of(key: str, folds: int, seed: int = 5043) -> Column:
    """The fold of a key."""
    return (key_number([key], seed) % folds).cast("int")


def term_model_cv(
    df: DataFrame, key: str, label: str, words: Column, smoothings: list[float], folds: int = 3, seed: int = 5043
) -> DataFrame:
    """(smoothing, fold, hits, rows) of the exact multinomial model, each fold scored by the others' fit.

    Texts are cut once. A term's counts by class and fold give every fold's model by subtraction, and one join
    scores each text with its fold's model at all grid points.
    """
    held = df.where(F.col(label).isNotNull()).withColumn("_fold", fold_of(key, folds, seed))
    sizes = held.groupBy(label, "_fold").agg(F.count("*").alias("n")).collect()  # classes times folds
    classes = sorted({r[label] for r in sizes})
    if len(classes) > MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} classes")
    places = [(c, f) for f in range(folds) for c in classes]
    members = {place: 0 for place in places} | {(r[label], r["_fold"]): r["n"] for r in sizes}

    tf = materialise(
        held.select(key, label, "_fold", F.explode(words).alias("term")).groupBy(key, label, "_fold", "term").agg(F.count("*").alias("tf"))
    )
    cells = [F.sum(F.when((F.col(label) == c) & (F.col("_fold") == f), F.col("tf")).otherwise(0)).alias(f"_{i}") for i, (c, f) in enumerate(places)]
    counts = materialise(tf.groupBy("term").agg(F.count("*").alias("n"), *cells))
    k = len(classes)
    rest = lambda f, j: sum((F.col(f"_{g * k + j}") for g in range(folds) if g != f), F.lit(0))  # noqa: E731  the other folds'
    facts = [F.sum(rest(f, j)) for f in range(folds) for j in range(k)]
    facts += [F.count_if(sum((rest(f, j) for j in range(k)), F.lit(0)) > 0) for f in range(folds)]
    found = [x or 0 for x in counts.agg(*facts).first()] if places else []
    totals, terms = found[: folds * k], found[folds * k :]

    # A term's counts in the other folds, by fold; null where none of them has the term.
    others = [F.array(*[rest(f, j) for j in range(k)]) for f in range(folds)]
    others = [F.when(F.aggregate(o, F.lit(0).cast("long"), lambda a, x: a + x) > 0, o) for o in others]
    lookup = counts.select("term", F.array(*others).alias("_others"))
    joined = lookup_join(tf, lookup, "term", counts.select("term", "n")).withColumn("_n", F.get("_others", F.col("_fold")))
    table = lambda values, kind: F.get(F.lit(values).cast(kind), F.col("_fold"))
    sums = []
    for i, s in enumerate(smoothings):
        for j in range(k):
            below = table([float(totals[f * k + j] + s * terms[f]) for f in range(folds)], "array<double>")
            sums.append(F.sum(F.col("tf") * F.log((F.col("_n")[j] + s) / below)).alias(f"_{i}_{j}"))
    scores = joined.where(F.col("_n").isNotNull()).groupBy(key).agg(*sums)
    scored = held.select(key, label, "_fold").join(scores, key, "left")
    hits = []
    for i, s in enumerate(smoothings):
        options = []
        for j, c in enumerate(classes):
            # A class that only this fold has is unknown to its model.
            taught = [[sum(members[x, g] for g in range(folds) if g != f) for x in classes] for f in range(folds)]
            prior = [
                math.log((t[j] + s) / (sum(t) + s * sum(n > 0 for n in t))) if t[j] else None for t in taught
            ]
            score = F.coalesce(f"_{i}_{j}", F.lit(0.0)) + table(prior, "array<double>")
            options.append(F.when(score.isNotNull(), F.struct(score.alias("score"), F.lit(-j), F.lit(c).alias("class"))))
        best = F.array_max(F.array(*options))["class"]
        hits.append(F.struct(F.lit(float(s)).alias("smoothing"), (best == F.col(label)).alias("hit")))
    each = scored.select("_fold", F.inline(F.array(*hits)))
    return each.groupBy("smoothing", F.col("_fold").alias("fold")).agg(F.count_if("hit").alias("hits"), F.count("*").alias("rows"))


def cv_table(model: CrossValidatorModel) -> DataFrame:
    """One row per grid point: its parameters, mean metric, and whether it won."""
    better = max if model.getEvaluator().isLargerBetter() else min
    best = model.avgMetrics.index(better(model.avgMetrics))
    rows = [
        (i, ", ".join(sorted(f"{p.name}={v}" for p, v in params.items())), float(metric), i == best)
        for i, (params, metric) in enumerate(zip(model.getEstimatorParamMaps(), model.avgMetrics))
    ]
    schema = "point long, params string, avg_metric double, is_best boolean"
    return SparkSession.active().createDataFrame(rows, schema)


def random_forest_draws(draws: int = 5, seed: int = 42) -> dict[str, list[int]]:
    """Forest settings drawn at random: trees uniform in [70, 80), features normal around 6 with a
    floor of one."""
    rng = np.random.default_rng(seed)
    trees = rng.uniform(70, 80, draws).astype(int)
    features = np.maximum(rng.normal(6, 3, draws).astype(int), 1)
    return {"trees": trees.tolist(), "features": features.tolist()}


def draw_grid(forest: RandomForestClassifier, drawn: dict[str, list[int]]) -> list[dict]:
    """Drawn settings, pairwise, as param maps."""
    return [
        {forest.numTrees: trees, forest.featureSubsetStrategy: str(features)}
        for trees, features in zip(drawn["trees"], drawn["features"])
    ]


# Kernel machine by random Fourier features ------------------------------------------------------------------

MAX_PROJECTION = 20_000_000  # entries of the projection that every task holds


def fourier_features(
    df: DataFrame, vector: str, size: int, gamma: float = 4.0, outputs: int = 512, seed: int = 69,
    to: str = FEATURES,
) -> DataFrame:
    """Random Fourier features whose inner products approximate exp(-gamma |x - y|²).

    Each task redraws the projection from the seed, once, so nothing is sent around; its size is
    set by the arguments and checked.
    """
    if size * outputs > MAX_PROJECTION:
        raise ValueError("projection too large: lower the vector size or the outputs")

    @F.pandas_udf("array<double>")
    def project(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        rng = np.random.default_rng(seed)
        directions = rng.normal(0.0, math.sqrt(2.0 * gamma), (size, outputs))
        phases = rng.uniform(0.0, 2.0 * math.pi, outputs)
        for rows in batches:
            x = np.stack(rows.to_numpy()) if len(rows) else np.zeros((0, size))
            yield pd.Series(list(math.sqrt(2.0 / outputs) * np.cos(x @ directions + phases)), dtype=object)

    is_vector = isinstance(df.schema[vector].dataType, VectorUDT)
    source = vector_to_array(F.col(vector)) if is_vector else F.col(vector).cast("array<double>")
    return df.withColumn(to, array_to_vector(project(source)))


def rbf_svm(
    cost: float = 10.0, rows: int = 1000, iterations: int = 100, features: str = FEATURES, parallelism: int = 8
) -> OneVsRest:
    """Linear one-against-rest machine on Fourier features: an approximate kernel machine.

    The cost C of the usual formulation becomes a regularisation of 1 / (C · rows).
    """
    svm = LinearSVC(labelCol=LABEL, featuresCol=features, regParam=1.0 / (cost * rows), maxIter=iterations)
    return OneVsRest(classifier=svm, labelCol=LABEL, featuresCol=features, parallelism=parallelism)


# Feature elimination -------------------------------------------------------------------------------------------


LEDGER = "round int, fold int, roc_auc double, columns array<int>, importance array<double>"


def eliminate_features(
    train: DataFrame, size: int, keep: int = 1, step: float = 1, folds: int = 5, trees: int = 30, seed: int = 42,
    key: str | None = None, ledger: str | None = None, parallelism: int = 6,
) -> DataFrame:
    """Recursive elimination: cross-validate a forest with balanced class weights, drop the ``step`` least
    important columns (a share of them, below one), repeat down to ``keep``. One row per round with its
    columns and the mean over the folds of the area under the ROC curve.

    Each finished fit is a row of the table in the folder ``ledger``: (round, fold, area), or with fold -1 the
    importances of a round's columns in a forest over all rows. A run with the ledger of one that was ended goes on after
    its last finished fit. The fits of a round run side by side.
    """
    spark = train.sparkSession
    ledger = ledger or scratch_path(spark, "elimination")
    weighted = with_class_weights(train, LABEL, "_weight")
    fold = fold_of(key, folds, seed) if key else F.pmod(F.xxhash64(F.lit(seed), FEATURES), F.lit(folds)).cast("int")
    weighted = weighted.withColumn("_fold", fold).persist()
    evaluator = RestAreaEvaluator()

    def fit(number: int, fold: int, columns: list[int]) -> tuple:
        slicer = VectorSlicer(inputCol=FEATURES, outputCol="_kept", indices=columns)
        forest = random_forest(trees, weight="_weight", seed=seed, grown=True).setFeaturesCol("_kept")
        pipeline = Pipeline(stages=[slicer, forest])
        fitted = pipeline.fit(weighted.where(F.col("_fold") != fold))
        if fold < 0:
            return number, fold, None, columns, [float(x) for x in fitted.stages[-1].featureImportances.toArray()]
        area = evaluator.evaluate(fitted.transform(weighted.where(F.col("_fold") == fold)))
        return number, fold, area, columns, None

    def done(number: int) -> dict[int, Row]:
        return {r["fold"]: r for r in _ledger_rows(spark, ledger).where(F.col("round") == number).collect()}

    columns, number, rows = list(range(size)), 0, []
    with ThreadPool(parallelism) as pool:
        while True:
            last = len(columns) <= keep
            missing = [f for f in [*range(folds), *([] if last else [-1])] if f not in done(number)]
            for made in pool.imap_unordered(inheritable_thread_target(spark)(lambda f: fit(number, f, columns)), missing):
                spark.createDataFrame([made], LEDGER).write.mode("append").parquet(ledger)
            found = done(number)
            areas = [found[f]["roc_auc"] for f in range(folds)]
            rows.append((number, len(columns), float(np.mean(areas)), columns))
            if last:
                break
            importance = found[-1]["importance"]
            drop = step if step >= 1 else max(1, math.ceil(len(columns) * step))
            left = max(keep, len(columns) - int(drop))
            order = sorted(range(len(columns)), key=lambda i: (-importance[i], columns[i]))
            columns, number = sorted(columns[i] for i in order[:left]), number + 1
    weighted.unpersist()
    return spark.createDataFrame(rows, "round long, features long, roc_auc double, columns array<int>")


def _ledger_rows(spark: SparkSession, ledger: str) -> DataFrame:
    try:
        return spark.read.schema(LEDGER).parquet(ledger)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


# Fitted models -----------------------------------------------------------------------------------------------


def save_trees(model: Model) -> str:
    """Save a fitted tree or forest in the shared folder; executors write and read its nodes."""
    path = scratch_path(SparkSession.active(), "trees")
    if isinstance(model, ForestModel):
        model.save(path)
    else:
        model.write().save(path)
    return path


def _saved_nodes(path: str) -> DataFrame:
    """(tree, node struct) of a saved tree or forest."""
    saved = SparkSession.active().read.parquet(f"{path}/data")
    if "nodeData" in saved.columns:
        return saved.select(F.col("treeID").alias("tree"), F.col("nodeData").alias("node"))
    return saved.select(F.lit(0).alias("tree"), F.struct(*saved.columns).alias("node"))


def nodes_of(path: str) -> DataFrame:
    """(tree, node, prediction, impurity, rows, gain, left, right, feature, threshold, stats) of a saved
    tree or forest. Leaves have feature and children -1; ``stats`` are the weighted rows of each class."""
    cut = F.col("node.split.leftCategoriesOrThreshold")
    return _saved_nodes(path).select(
        "tree", F.col("node.id").alias("node"), "node.prediction", F.round("node.impurity", 6).alias("impurity"),
        F.col("node.rawCount").cast("long").alias("rows"), "node.gain", F.col("node.leftChild").alias("left"),
        F.col("node.rightChild").alias("right"), F.col("node.split.featureIndex").alias("feature"),
        F.when(F.size(cut) > 0, F.get(cut, F.lit(0))).alias("threshold"), F.col("node.impurityStats").alias("stats"),
    )


def tree_nodes(model: Model) -> DataFrame:
    """(node, prediction, impurity, rows, gain, left, right, feature, threshold) of a fitted tree."""
    return nodes_of(save_trees(model)).drop("tree", "stats")


def tree_paths(nodes: DataFrame) -> DataFrame:
    """(tree, node, depth, path) for every node: its depth and the tests on the way to it, outermost first.

    ``path`` lists (feature, threshold, below), ``below`` being true where the value is at most the threshold. One
    recursive query over the node table, a step per level.
    """
    spark = nodes.sparkSession
    inner = nodes.where(F.col("left") >= 0)
    sides = [
        inner.select("tree", F.col("node").alias("parent"), F.col(child).alias("node"), "feature", "threshold", F.lit(below).alias("below"))
        for child, below in (("left", True), ("right", False))
    ]
    steps = materialise(sides[0].unionByName(sides[1]))
    roots = materialise(nodes.where(F.col("node") == 0).select("tree"))
    most = spark.conf.get("spark.sql.cteRecursionRowLimit")
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")  # a forest has as many rows as nodes
    try:
        found = spark.sql(
            """
            WITH RECURSIVE walked(tree, node, depth, path) AS (
              SELECT tree, 0, 0, CAST(array() AS array<struct<feature:int,threshold:double,below:boolean>>) FROM {roots}
              UNION ALL
              SELECT s.tree, s.node, w.depth + 1, array_append(w.path, named_struct('feature', s.feature, 'threshold', s.threshold, 'below', s.below))
              FROM walked w JOIN {steps} s ON s.tree = w.tree AND s.parent = w.node)
            SELECT * FROM walked""",
            roots=roots, steps=steps,
        )
        return materialise(found)
    finally:
        spark.conf.set("spark.sql.cteRecursionRowLimit", most)


def tree_rules(nodes: DataFrame) -> DataFrame:
    """(tree, leaf, depth, rule, prediction, rows): each leaf as a sentence, such as ``f3 <= 0.5 and f1 > 2.0``."""
    test = lambda t: F.concat(F.lit("f"), t["feature"], F.when(t["below"], " <= ").otherwise(" > "), t["threshold"])
    rule = F.when(F.size("path") == 0, F.lit("always")).otherwise(F.array_join(F.transform("path", test), " and "))
    leaves = nodes.where(F.col("left") < 0).join(tree_paths(nodes), ["tree", "node"])
    return leaves.select("tree", F.col("node").alias("leaf"), "depth", rule.alias("rule"), "prediction", "rows")


def walk_tree(x: Column, nodes: list[Row], depth: int = MAX_DEPTH) -> Column:
    """The node that the array ``x`` comes to in at most ``depth`` steps through one tree, a leaf by default; ``nodes``
    are its collected nodes (a model that fits the driver)."""
    ordered = sorted(nodes, key=lambda r: r["node"])
    column = lambda name, kind: F.lit([r[name] for r in ordered]).cast(f"array<{kind}>")
    left, right, feature = (column(name, "int") for name in ("left", "right", "feature"))
    cuts = F.lit([r["threshold"] if r["threshold"] is not None else 0.0 for r in ordered]).cast("array<double>")

    def step(node: Column, _: Column) -> Column:
        below = F.get(x, F.get(feature, node)) <= F.get(cuts, node)
        return F.when(F.get(left, node) < 0, node).when(below, F.get(left, node)).otherwise(F.get(right, node))

    return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), step)


def cut_forest(path: str, trees: int, depth: int = MAX_DEPTH, paths: DataFrame | None = None) -> RandomForestClassificationModel:
    """The forest saved in ``path``, with only its first ``trees`` trees and no node deeper than ``depth``.

    Trees are drawn one after the other and grown from the root, so a forest holds the smaller ones of the same draws.
    ``paths`` are its ``tree_paths``, where they are at hand.
    """
    spark = SparkSession.active()
    paths = tree_paths(nodes_of(path)) if paths is None else paths
    kept = paths.where((F.col("tree") < trees) & (F.col("depth") <= depth)).select("tree", F.col("node").alias("id"), "depth")
    # Nodes are numbered without gaps within a tree.
    numbered = kept.withColumn("new", F.row_number().over(Window.partitionBy("tree").orderBy("id")) - 1)
    nodes = _saved_nodes(path).withColumn("id", F.col("node.id")).join(numbered, ["tree", "id"])
    for child in ("leftChild", "rightChild"):
        renamed = numbered.select("tree", F.col("id").alias(f"_{child}"), F.col("new").alias(child))
        nodes = nodes.withColumn(f"_{child}", F.col(f"node.{child}")).join(renamed, ["tree", f"_{child}"], "left")
    leaf = F.coalesce("leftChild", F.lit(-1)) < 0
    split = F.col("node.split")
    none = F.struct(
        F.lit(-1).alias("featureIndex"), F.array().cast("array<double>").alias("leftCategoriesOrThreshold"), F.lit(-1).alias("numCategories")
    )
    changed = {
        "id": F.col("new"),
        "leftChild": F.coalesce("leftChild", F.lit(-1)),
        "rightChild": F.coalesce("rightChild", F.lit(-1)),
        "gain": F.when(leaf, -1.0).otherwise(F.col("node.gain")),
        "split": F.when(leaf, none).otherwise(split),
    }
    fields = [f.name for f in nodes.schema["node"].dataType]
    data = F.struct(*[changed.get(f, F.col(f"node.{f}")).alias(f) for f in fields])
    target = scratch_path(spark, "trees")
    nodes.select(F.col("tree").alias("treeID"), data.alias("nodeData")).write.parquet(f"{target}/data")
    each = spark.read.parquet(f"{path}/treesMetadata")  # (number of the tree, its metadata, its weight)
    each.where(F.col(each.columns[0]) < trees).write.parquet(f"{target}/treesMetadata")
    facts = json.loads(spark.read.text(f"{path}/metadata").first()[0])
    facts["numTrees"] = trees
    facts.get("paramMap", {}).update({k: v for k, v in (("numTrees", trees), ("maxDepth", depth)) if k in facts.get("paramMap", {})})
    spark.createDataFrame([(json.dumps(facts),)], "value string").coalesce(1).write.text(f"{target}/metadata")
    return RandomForestClassificationModel.load(target)


def forest_cv(
    train: DataFrame, trees: list[int], depths: list[int], folds: int = 3, key: str = "vec_id", seed: int = 42, parallelism: int = 3
) -> DataFrame:
    """(trees, depth, avg_metric, is_best): cross-validated accuracy of forests of all sizes and depths.

    The largest and deepest forest is fitted once per fold; every other point is a part of it: its first trees, cut at a depth.
    """
    spark = train.sparkSession
    dealt = train.withColumn("_fold", fold_of(key, folds, seed))
    points = [(t, d) for t in trees for d in depths]

    def scores(fold: int) -> list[float]:
        fitted = random_forest(max(trees), max(depths), seed=seed, grown=True).fit(dealt.where(F.col("_fold") != fold))
        held = dealt.where(F.col("_fold") == fold)
        if isinstance(fitted, ForestModel):
            return _point_scores(fitted, held, points)
        path = save_trees(fitted)
        paths = tree_paths(nodes_of(path))
        deepest = paths.agg(F.max("depth")).first()[0]
        right: dict[tuple[int, int], float] = {}
        for t, d in points:
            point = t, min(d, deepest)  # depths beyond the deepest tree are one point
            if point not in right:
                model = fitted if point == (max(trees), deepest) else cut_forest(path, *point, paths)
                hit = (F.col("prediction") == F.col(LABEL)).cast("double")
                right[point] = model.transform(held).agg(F.avg(hit)).first()[0]
        return [right[t, min(d, deepest)] for t, d in points]

    with ThreadPool(parallelism) as pool:
        found = np.array(pool.map(inheritable_thread_target(spark)(scores), range(folds)), float)
    means = [float(x) for x in np.nanmean(found, axis=0)]
    best = means.index(max(means))
    rows = [(t, d, m, i == best) for i, ((t, d), m) in enumerate(zip(points, means))]
    return spark.createDataFrame(rows, "trees int, depth int, avg_metric double, is_best boolean")


def _point_scores(fitted: ForestModel, held: DataFrame, points: list[tuple[int, int]]) -> list[float]:
    """The accuracy at every point; all are scored in one walk through each tree."""
    rows = materialise(held.select(LABEL, FEATURES).withColumn("_row", F.monotonically_increasing_id()))
    votes = fitted.votes(rows, F.col(FEATURES), points).join(rows.select("_row", LABEL), "_row")
    hit = (predicted(F.col("_votes")) == F.col(LABEL)).cast("double")
    found = {r["_point"]: r["share"] for r in votes.groupBy("_point").agg(F.avg(hit).alias("share")).collect()}
    return [found.get(place) for place in range(len(points))]


def best_params(model: CrossValidatorModel) -> DataFrame:
    """(stage, param, value) of the refitted winner: a row per parameter."""
    best = model.bestModel
    stages = best.stages if isinstance(best, PipelineModel) else [best]
    rows = [
        (type(stage).__name__, param.name, str(stage.getOrDefault(param)))
        for stage in stages
        for param in stage.params
        if stage.isDefined(param)
    ]
    return SparkSession.active().createDataFrame(rows, "stage string, param string, value string")

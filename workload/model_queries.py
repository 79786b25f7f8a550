"""Clustering, classification and tuning. Fits use the labelled documents or all embeddings; scores
are given for all rows."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.feature import Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from verbatide.operators import features as X
from verbatide.operators import models as M
from verbatide.operators.rowsets import keyed_split
from verbatide.plans import cluster
from verbatide.plans.classify import add_words, fit_and_score, index_labels, text_pipeline, with_labels
from verbatide.plans.explore import content_words
from verbatide.session import materialise
from workload import sql as S
from workload.feature_queries import FITTED
from workload.tables import Query, classed, documents, labelled, lexicon, table


def _words():
    return content_words(F.col("text"))


# Exact: naive Bayes as joins and aggregates -------------------------------------------------------


def class_weights(spark, d):
    weights = M.class_weights(classed(spark, d), "Sentiments")
    return weights.select("Sentiments", "n", F.round("weight", 6).alias("weight"))


def weighted_rows(spark, d):
    rows = M.with_class_weights(classed(spark, d).select("doc_id", "Sentiments"), "Sentiments")
    return rows.select("doc_id", F.round("weight", 6).alias("weight"))


WEIGHTS = f"""{S.CLASSED},
weights AS (
  SELECT Sentiments, count(*) AS n, round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6) AS weight
  FROM classed GROUP BY Sentiments)"""


def nb_log_priors(spark, d):
    priors = M.class_log_priors(labelled(spark, d), "Sentiments")
    return priors.select("Sentiments", F.round("log_prior", 6).alias("log_prior"))


def nb_log_probs(spark, d):
    model = M.fit_multinomial(labelled(spark, d), "Sentiments", _words())
    return model.log_weights("Sentiments").withColumn("log_p", F.round("log_p", 6))


def nb_predict(spark, d):
    """Fitted on the labelled documents, applied to all."""
    model = M.fit_multinomial(labelled(spark, d), "Sentiments", _words())
    docs = documents(spark, d)
    values = X.term_frequencies(docs, "doc_id", _words()).withColumnRenamed("tf", "value")
    return model.predict(docs, "doc_id", values)


MULTINOMIAL = f"""{S.LABELLED},
words AS (SELECT Sentiments, unnest({S.content('text')}) AS term FROM labelled),
counts AS (SELECT Sentiments, term, count(*) AS n FROM words GROUP BY Sentiments, term),
sizes AS (SELECT Sentiments, sum(n) AS total FROM counts GROUP BY Sentiments),
vocabulary AS (SELECT DISTINCT term FROM counts),
priors AS (
  SELECT Sentiments, ln((count(*) + 0.1::DOUBLE) / (sum(count(*)) OVER () + 0.1::DOUBLE * count(*) OVER ())) AS log_prior
  FROM labelled GROUP BY Sentiments),
theta AS (
  SELECT v.term, s.Sentiments,
         ln((coalesce(c.n, 0) + 0.1::DOUBLE) / (s.total + 0.1::DOUBLE * (SELECT count(*) FROM vocabulary))) AS log_p
  FROM vocabulary v CROSS JOIN sizes s LEFT JOIN counts c ON c.term = v.term AND c.Sentiments = s.Sentiments)"""


def bernoulli_predict(spark, d):
    """Present means a tf-idf weight above 0.1; fitted on the labelled documents, applied to all."""
    values = _weights(spark, d)
    values = values.withColumn("value", F.when(F.round("value", 9) > 0.1, 1.0).otherwise(0.0))
    model = M.fit_bernoulli(labelled(spark, d), "doc_id", "Sentiments", values)
    return model.predict(documents(spark, d), "doc_id", values)


def _weights(spark, d):
    """TF-IDF of all documents, fitted on the labelled ones. Written: fits and predictions reread it."""
    train = labelled(spark, d)
    fitted = X.TfIdf.fit(X.term_frequencies(train, "doc_id", _words()), train.count())
    weights = fitted.apply(X.term_frequencies(documents(spark, d), "doc_id", _words()), "doc_id")
    return materialise(weights.select("doc_id", "term", F.col("tfidf").alias("value")))


def nb_tfidf_predict(spark, d):
    """Multinomial with smoothing one on TF-IDF weights."""
    values, rows = _weights(spark, d), labelled(spark, d)
    model = M.fit_multinomial_values(rows, "doc_id", "Sentiments", values, 1.0)
    return model.predict(documents(spark, d), "doc_id", values)


NB_TFIDF_SQL = f"""
WITH {FITTED},
sizes AS (SELECT Sentiments, ln(count(*) / sum(count(*)) OVER ()) AS log_prior FROM labelled GROUP BY Sentiments),
sums AS (SELECT term, Sentiments, sum(tfidf) AS s FROM weighted JOIN labelled USING (doc_id) GROUP BY term, Sentiments),
totals AS (SELECT Sentiments, sum(s) AS total FROM sums GROUP BY Sentiments),
theta AS (
  SELECT d.term, t.Sentiments, ln((coalesce(s, 0) + 1) / (total + (SELECT count(*) FROM df))) AS log_p
  FROM df d CROSS JOIN totals t LEFT JOIN sums ON sums.term = d.term AND sums.Sentiments = t.Sentiments),
scored AS (SELECT doc_id, Sentiments, sum(tfidf * log_p) AS s FROM weighted JOIN theta USING (term) GROUP BY doc_id, Sentiments),
scores AS (
  SELECT d.doc_id, p.Sentiments AS prediction, log_prior + coalesce(s, 0) AS score
  FROM documents d CROSS JOIN sizes p LEFT JOIN scored s ON s.doc_id = d.doc_id AND s.Sentiments = p.Sentiments)
SELECT doc_id, prediction FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, prediction) AS r FROM scores) WHERE r = 1"""


def nb_cv_exact(spark, d):
    """Cross-validation of the exact model in keyed folds."""
    return M.term_model_cv(labelled(spark, d), "doc_id", "Sentiments", _words(), [0.01, 0.1, 0.3, 0.8, 1.0, 2.0], 3)


NB_CV_SQL = f"""
WITH {S.LABELLED},
grid(smoothing) AS (VALUES (0.01::DOUBLE), (0.1), (0.3), (0.8), (1.0), (2.0)), folds(fold) AS (VALUES (0), (1), (2)),
rows AS (SELECT *, (('0x' || substr(md5('5043:' || doc_id), 1, 8))::BIGINT % 3)::INT AS own FROM labelled),
words AS (SELECT doc_id, own, Sentiments, unnest({S.content('text')}) AS term FROM rows),
counts AS (SELECT fold, Sentiments, term, count(*) AS n FROM words JOIN folds ON own <> fold GROUP BY ALL),
sizes AS (SELECT fold, Sentiments, sum(n) AS total FROM counts GROUP BY ALL),
vocabulary AS (SELECT DISTINCT fold, term FROM counts),
terms AS (SELECT fold, count(*) AS v FROM vocabulary GROUP BY fold),
members AS (SELECT fold, Sentiments, count(*) AS n FROM rows JOIN folds ON own <> fold GROUP BY ALL),
priors AS (
  SELECT fold, Sentiments, smoothing, ln((n + smoothing) / (sum(n) OVER w + smoothing * count(*) OVER w)) AS log_prior
  FROM members CROSS JOIN grid WINDOW w AS (PARTITION BY fold, smoothing)),
theta AS (
  SELECT v.fold, v.term, s.Sentiments, smoothing, ln((coalesce(c.n, 0) + smoothing) / (s.total + smoothing * t.v)) AS log_p
  FROM vocabulary v JOIN sizes s USING (fold) JOIN terms t USING (fold) CROSS JOIN grid
  LEFT JOIN counts c ON c.fold = v.fold AND c.term = v.term AND c.Sentiments = s.Sentiments),
sums AS (
  SELECT w.doc_id, t.fold, t.Sentiments, smoothing, sum(log_p) AS s
  FROM words w JOIN theta t ON t.term = w.term AND t.fold = w.own GROUP BY ALL),
scores AS (
  SELECT r.doc_id, r.own AS fold, r.Sentiments AS truth, p.Sentiments AS prediction, p.smoothing, log_prior + coalesce(s, 0) AS score
  FROM rows r JOIN priors p ON p.fold = r.own
  LEFT JOIN sums x ON x.doc_id = r.doc_id AND x.Sentiments = p.Sentiments AND x.smoothing = p.smoothing),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id, smoothing ORDER BY score DESC, prediction) AS r FROM scores)
SELECT smoothing, fold, count(*) FILTER (WHERE truth = prediction) AS hits, count(*) AS rows
FROM best WHERE r = 1 GROUP BY smoothing, fold"""


def _lemma_rows(spark, d):
    rows = materialise(add_words(classed(spark, d), "text", lexicon(spark, d)).select("doc_id", "Sentiments", "words"))
    return rows, rows.join(table(spark, d, "labels", "doc_id"), "doc_id", "left_semi")


def nb_lemma_predict(spark, d):
    """Lemmas without stop words, fitted on the labelled documents, applied to all."""
    rows, train = _lemma_rows(spark, d)
    model = M.fit_multinomial(train, "Sentiments", F.col("words"))
    values = X.term_frequencies(rows, "doc_id", F.col("words")).withColumnRenamed("tf", "value")
    return model.predict(rows, "doc_id", values)


def nb_lemma_report(spark, d):
    """Counts of label against prediction: the model's own output evaluated."""
    truth = classed(spark, d).select("doc_id", F.col("Sentiments").alias("label"))
    pairs = nb_lemma_predict(spark, d).join(truth, "doc_id").groupBy("label", "prediction")
    return pairs.agg(F.count("*").alias("n"))


def _lemma_nb_sql(final: str) -> str:
    return f"""
WITH {S.CLASSED}, {S.LEXICON},
lists AS (SELECT doc_id, {S.plain('text')} AS w FROM documents),
raw AS (SELECT doc_id, unnest(w) AS token FROM lists),
vocabulary0 AS (SELECT DISTINCT token FROM raw),
{S.lemma_ctes('vocabulary0', 'v', False)},
words AS (
  SELECT doc_id, coalesce(lemma, token) AS term FROM raw LEFT JOIN lemmas USING (token)
  WHERE lower(coalesce(lemma, token)) NOT IN {S.STOP}),
labelled AS (SELECT * FROM classed WHERE doc_id IN (SELECT doc_id FROM labels)),
counts AS (SELECT Sentiments, term, count(*) AS n FROM words JOIN labelled USING (doc_id) GROUP BY ALL),
sizes AS (SELECT Sentiments, sum(n) AS total FROM counts GROUP BY Sentiments),
vocabulary AS (SELECT DISTINCT term FROM counts),
priors AS (
  SELECT Sentiments, ln((count(*) + 0.1::DOUBLE) / (sum(count(*)) OVER () + 0.1::DOUBLE * count(*) OVER ())) AS log_prior
  FROM labelled GROUP BY Sentiments),
theta AS (
  SELECT v.term, s.Sentiments,
         ln((coalesce(c.n, 0) + 0.1::DOUBLE) / (s.total + 0.1::DOUBLE * (SELECT count(*) FROM vocabulary))) AS log_p
  FROM vocabulary v CROSS JOIN sizes s LEFT JOIN counts c ON c.term = v.term AND c.Sentiments = s.Sentiments),
sums AS (SELECT doc_id, Sentiments, sum(log_p) AS s FROM words JOIN theta USING (term) GROUP BY doc_id, Sentiments),
scores AS (
  SELECT d.doc_id, p.Sentiments AS prediction, p.log_prior + coalesce(s, 0) AS score
  FROM documents d CROSS JOIN priors p LEFT JOIN sums ON sums.doc_id = d.doc_id AND sums.Sentiments = p.Sentiments),
best AS (
  SELECT doc_id, prediction FROM (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, prediction) AS r FROM scores) WHERE r = 1)
{final}"""


BERNOULLI_SQL = f"""
WITH {FITTED},
present AS (SELECT doc_id, term, round(tfidf, 9) > 0.1 AS there FROM weighted),
sizes AS (SELECT Sentiments, count(*) AS n, ln(count(*) / sum(count(*)) OVER ()) AS log_prior FROM labelled GROUP BY Sentiments),
seen AS (
  SELECT term, Sentiments, count(*) FILTER (WHERE there) AS k FROM present JOIN labelled USING (doc_id)
  GROUP BY term, Sentiments),
share AS (
  SELECT d.term, s.Sentiments, (coalesce(k, 0) + 1) / (s.n + 2) AS p
  FROM df d CROSS JOIN sizes s LEFT JOIN seen ON seen.term = d.term AND seen.Sentiments = s.Sentiments),
base AS (
  SELECT Sentiments, any_value(log_prior) + sum(ln(1 - p)) AS base FROM share JOIN sizes USING (Sentiments)
  GROUP BY Sentiments),
hits AS (
  SELECT doc_id, Sentiments, sum(ln(p) - ln(1 - p)) AS hit
  FROM present JOIN share USING (term) WHERE there GROUP BY doc_id, Sentiments),
scores AS (
  SELECT l.doc_id, b.Sentiments AS prediction, b.base + coalesce(hit, 0) AS score
  FROM documents l CROSS JOIN base b LEFT JOIN hits h ON h.doc_id = l.doc_id AND h.Sentiments = b.Sentiments)
SELECT doc_id, prediction FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, prediction) AS r FROM scores) WHERE r = 1"""


# Spark ML: fitted iteratively or on hashed features --------------------------------------------------


def _words_and_classes(spark, d):
    return add_words(labelled(spark, d), "text").select("doc_id", "words", "Feelings")


def _train(spark, d):
    rows = _words_and_classes(spark, d)
    return with_labels(rows, index_labels(rows))


def _score_all(model, spark, d):
    """Apply a text pipeline to all documents."""
    return model.transform(add_words(documents(spark, d), "text")).select("doc_id", "prediction")


def scored_rows(spark, d):
    """A class that training never saw, and rows without a label: every document gets one of the two
    trained classes."""
    rows = _words_and_classes(spark, d).where(F.col("Feelings") != "1")
    model = text_pipeline(M.naive_bayes(), 6000).fit(with_labels(rows, index_labels(rows)))
    return _score_all(model, spark, d).select("doc_id", F.col("prediction").isin(0.0, 1.0).alias("known"))


def _fit(spark, d, classifier, width, grams=1):
    train = _train(spark, d)
    with X.cached(train) as (rows,):
        return text_pipeline(classifier, width, grams).fit(_for_fit(rows, classifier, width))


def _for_fit(rows, classifier, width):
    return M.dealt_for_trees(rows, width) if isinstance(classifier, M.TREES) else rows


def nb_hashed(spark, d):
    return _score_all(_fit(spark, d, M.naive_bayes(0.1), 90_000), spark, d)


def dt_predict(spark, d):
    return _score_all(_fit(spark, d, M.decision_tree(), 15_000, grams=3), spark, d)


def rf_predict(spark, d):
    return _score_all(_fit(spark, d, M.random_forest(), 15_000), spark, d)


def tree_dump(spark, d):
    model = _fit(spark, d, M.decision_tree(bins=40, depth=20), 2000)
    return M.tree_nodes(model.stages[-1])


def dt_stump(spark, d):
    """A tree of depth one on two small counts: the split is the one of least impurity."""
    rows = table(spark, d, "lineitem", "l_linenumber", "l_quantity")
    label = F.when(F.col("l_quantity") + 3 * F.col("l_linenumber") > 40, 1.0).otherwise(0.0)
    rows = rows.withColumns({M.LABEL: label, "quantity": F.col("l_quantity").cast("double")})
    rows = X.assembler(["l_linenumber", "quantity"], M.FEATURES).transform(rows)
    with X.cached(rows.select(M.LABEL, M.FEATURES)) as (train,):
        model = M.decision_tree(depth=1).fit(train)
    return M.tree_nodes(model).select("feature", "impurity", "rows")


STUMP_SQL = """
WITH rows AS (
  SELECT l_linenumber::DOUBLE AS f0, l_quantity::DOUBLE AS f1, (l_quantity + 3 * l_linenumber > 40)::INT AS y FROM lineitem),
long AS (SELECT 0 AS feature, f0 AS x, y FROM rows UNION ALL SELECT 1, f1, y FROM rows),
steps AS (SELECT feature, x, count(*) AS n, sum(y) AS p FROM long GROUP BY ALL),
cuts AS (
  SELECT feature, sum(n) OVER w AS ln, sum(p) OVER w AS lp, sum(n) OVER (PARTITION BY feature) AS n,
         sum(p) OVER (PARTITION BY feature) AS p
  FROM steps WINDOW w AS (PARTITION BY feature ORDER BY x)),
best AS (
  SELECT feature, n, p, ln, lp, 2 * (p / n) * (1 - p / n) AS g,
         2 * (lp / ln) * (1 - lp / ln) AS lg, 2 * ((p - lp) / (n - ln)) * (1 - (p - lp) / (n - ln)) AS rg
  FROM cuts WHERE n > ln
  ORDER BY ln / n * lg + (n - ln) / n * rg LIMIT 1)
SELECT feature::INT AS feature, round(g, 6) AS impurity, n::BIGINT AS rows FROM best
UNION ALL SELECT -1, round(lg, 6), ln::BIGINT FROM best UNION ALL SELECT -1, round(rg, 6), (n - ln)::BIGINT FROM best"""


def kmeans_nearest(spark, d):
    """Every vector is in the cluster whose centre is nearest; distances are taken apart from the model."""
    vectors = _embeddings(spark, d)
    with X.cached(vectors.select(M.FEATURES)) as (rows,):
        model = M.kmeans(5, 50).fit(rows)
    x = vector_to_array(F.col(M.FEATURES))
    far = []
    for centre in model.clusterCenters():
        c = F.array(*[F.lit(float(v)) for v in centre])
        far.append(F.aggregate(F.zip_with(x, c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda a, v: a + v))
    own = F.element_at(F.array(*far), F.col("cluster") + 1)
    nearest = own <= F.array_min(F.array(*far)) + 1e-9
    return model.transform(vectors).select("vec_id", nearest.alias("nearest"))


def bernoulli_stage(spark, d):
    """The same model as ML stages: hashed counts, idf, length one, present above 0.1."""
    train = _train(spark, d)
    stages = [
        X.hashing_tf(6000),
        X.idf("rawFeatures", "weighted"),
        Normalizer(p=2.0, inputCol="weighted", outputCol="features"),
        X.binarizer(),
        M.naive_bayes(1.0, "bernoulli", "present"),
    ]
    return _score_all(Pipeline(stages=stages).fit(train), spark, d)


def holdout_report(spark, d):
    """Two labelled tables, the nested hold-out, and the report on the final test part."""
    rows = _words_and_classes(spark, d)
    train, test = keyed_split(rows, "doc_id", [0.7, 0.3], 1)
    return fit_and_score(M.naive_bayes(0.1), train, test, "doc_id", 6000).report()


def _cross_validated(spark, d, estimator_of, folds):
    train = _train(spark, d)
    with X.cached(train) as (rows,):
        estimator, grid = estimator_of()
        hashing, classifier = estimator.getStages()
        rows = _for_fit(rows, classifier, hashing.getNumFeatures())
        return M.cv_table(M.cross_validate(estimator, grid, rows, folds, key="doc_id"))


def nb_cv(spark, d):
    def setup():
        nb = M.naive_bayes()
        return text_pipeline(nb, 2000), M.grid(smoothing=(nb.smoothing, [0.8, 0.3, 1.0]))

    return _cross_validated(spark, d, setup, 2)


def nb_cv_fine(spark, d):
    def setup():
        nb = M.naive_bayes()
        return text_pipeline(nb, 2000), M.grid(smoothing=(nb.smoothing, [0.8, 0.1, 0.5, 0.01, 2.0, 0.05]))

    return _cross_validated(spark, d, setup, 3)


def nb_width_cv(spark, d):
    def setup():
        pipeline = text_pipeline(M.naive_bayes(), 2000)
        hashing = pipeline.getStages()[0]
        return pipeline, M.grid(width=(hashing.numFeatures, [1000, 5000, 10_000, 15_000]))

    return _cross_validated(spark, d, setup, 2)


def dt_cv(spark, d):
    def setup():
        tree = M.decision_tree()
        grid = M.grid(bins=(tree.maxBins, [40, 60]), depth=(tree.maxDepth, [20, 30]))
        return text_pipeline(tree, 2000), grid

    return _cross_validated(spark, d, setup, 3)


def dt_leaf_cv(spark, d):
    def setup():
        tree = M.decision_tree(bins=32)
        grid = M.grid(impurity=(tree.impurity, ["gini", "entropy"]), leaf=(tree.minInstancesPerNode, [30, 20]))
        return text_pipeline(tree, 2000), grid

    return _cross_validated(spark, d, setup, 2)


def _embeddings(spark, d):
    rows = table(spark, d, "embeddings", "vec_id", "embedding", "label")
    vector = array_to_vector(F.col("embedding").cast("array<double>"))
    return rows.select("vec_id", F.col("label").cast("double").alias(M.LABEL), vector.alias(M.FEATURES))


def rf_small(spark, d):
    with X.cached(_embeddings(spark, d)) as (rows,):
        model = M.random_forest(trees=5, seed=82).fit(rows)
    return model.transform(_embeddings(spark, d)).select("vec_id", "prediction")


def rf_balanced_cv(spark, d):
    """Balanced class weights; the depths of the analysis lie beyond Spark's limit, so the grid ends there."""
    weighted = M.with_class_weights(_embeddings(spark, d), M.LABEL)
    with X.cached(weighted) as (rows,):
        forest = M.random_forest(trees=5, weight="weight", seed=42)
        model = M.cross_validate(forest, M.grid(depth=(forest.maxDepth, [20, 25, 30])), rows, 2, key="vec_id")
        return M.cv_table(model)


def rf_cv(spark, d):
    with X.cached(_embeddings(spark, d)) as (rows,):
        return M.forest_cv(rows, [200, 500], [10, 20, 30], folds=3, key="vec_id", seed=42)


def _by_tree(nodes):
    """The nodes of a fitted model by tree, in order; the driver holds the model anyway."""
    by_tree = {}
    for node in sorted(nodes.collect(), key=lambda n: (n["tree"], n["node"])):
        by_tree.setdefault(node["tree"], []).append(node)
    return list(by_tree.values())


def forest_prefix(spark, d):
    """The first trees of a forest, cut at a depth: the cut model predicts the mean vote of walks through
    the node table of the whole forest that stop at that depth."""
    with X.cached(_embeddings(spark, d)) as (rows,):
        path = M.save_trees(M.random_forest(trees=12, depth=10, seed=42).fit(rows))
    walked, votes = _embeddings(spark, d).withColumn("_x", vector_to_array(M.FEATURES)), []
    for nodes in _by_tree(M.nodes_of(path))[:5]:
        shares = F.lit([[float(x) / sum(n["stats"]) for x in n["stats"]] for n in nodes]).cast("array<array<double>>")
        votes.append(F.get(shares, M.walk_tree(F.col("_x"), nodes, depth=4)))
    total = reduce(lambda a, b: F.zip_with(a, b, lambda x, y: x + y), votes)
    walked = walked.withColumn("_want", (F.array_position(total, F.array_max(total)) - 1).cast("double"))
    scored = M.cut_forest(path, 5, 4).transform(walked)
    return scored.select("vec_id", (F.col("prediction") == F.col("_want")).alias("same"))


def _leaf(rows, nodes):
    """``rows`` with the leaf that each comes to in the one tree of ``nodes``."""
    (tree,) = _by_tree(nodes)
    return rows.withColumn("_x", vector_to_array(M.FEATURES)).withColumn("leaf", M.walk_tree(F.col("_x"), tree)).drop("_x")


def tree_rules(spark, d):
    """A fitted tree as rules: every document fits exactly one, and it predicts what the tree predicts."""
    model = _fit(spark, d, M.decision_tree(bins=40, depth=20), 2000)
    nodes = M.nodes_of(M.save_trees(model.stages[-1]))
    scored = model.transform(add_words(documents(spark, d), "text"))
    leaves = _leaf(scored, nodes).select("doc_id", "leaf", F.col("prediction").alias("_model"))
    joined = leaves.join(M.tree_rules(nodes), "leaf", "left")
    return joined.groupBy("doc_id").agg(F.count("rule").alias("rules"), F.bool_and(F.col("prediction") == F.col("_model")).alias("same"))


def rule_counts(spark, d):
    """The rows of each rule: a tree of depth two on two small counts, its leaves as filters over the table."""
    rows = table(spark, d, "lineitem", "l_linenumber", "l_quantity")
    label = F.when(F.col("l_quantity") + 3 * F.col("l_linenumber") > 40, 1.0).otherwise(0.0)
    rows = rows.withColumns({M.LABEL: label, "quantity": F.col("l_quantity").cast("double")})
    rows = X.assembler(["l_linenumber", "quantity"], M.FEATURES).transform(rows)
    with X.cached(rows.select(M.LABEL, M.FEATURES)) as (train,):
        nodes = M.nodes_of(M.save_trees(M.decision_tree(depth=3).fit(train)))
        met = _leaf(train, nodes).groupBy("leaf").agg(F.count("*").alias("met"))
        sized = M.tree_rules(nodes).join(met, "leaf")
        facts = sized.agg(F.sum("met").alias("rows"), F.bool_and(F.col("met") == F.col("rows")).alias("same")).collect()
    return spark.createDataFrame(facts, "rows long, same boolean")


def rf_draws_cv(spark, d):
    with X.cached(_embeddings(spark, d)) as (rows,):
        forest = M.random_forest(seed=42, grown=True)
        draws = M.draw_grid(forest, M.random_forest_draws())
        # One at a time: where Spark fits a forest, the driver holds it.
        return M.cv_table(M.cross_validate(forest, draws, rows, 2, key="vec_id", parallelism=1))


def svm_rff_predict(spark, d):
    rows = table(spark, d, "embeddings", "vec_id", "embedding", "label")
    size = rows.agg(F.max(F.size("embedding"))).first()[0]
    labels = rows.withColumn(M.LABEL, F.col("label").cast("double"))
    features = M.fourier_features(labels, "embedding", size).select("vec_id", M.LABEL, M.FEATURES)
    with X.cached(features) as (cached,):
        model = M.rbf_svm(rows=cached.count()).fit(cached)
    return model.transform(features).select("vec_id", "prediction")


def eliminate_features(spark, d):
    vectors = _embeddings(spark, d)
    size = table(spark, d, "embeddings", "embedding").agg(F.max(F.size("embedding"))).first()[0]
    with X.cached(vectors) as (rows,):
        return M.eliminate_features(rows, size, step=8, key="vec_id").drop("columns")


def best_params(spark, d):
    train = _train(spark, d)
    with X.cached(train) as (rows,):
        nb = M.naive_bayes()
        model = M.cross_validate(text_pipeline(nb, 2000), M.grid(smoothing=(nb.smoothing, [0.8, 0.3, 1.0])), rows, 2, key="doc_id")
        return M.best_params(model)


def kmeans_assign(spark, d):
    return cluster.trigram_clusters(documents(spark, d), "text").select("doc_id", "cluster")


def cluster_terms(spark, d):
    return cluster.trigram_cluster_terms(documents(spark, d), "text")


def class_terms(spark, d):
    """The centre terms of given groups, here the classes: what cluster_terms does after k-means."""
    rows = classed(spark, d).select(F.col("Sentiments").alias("cluster"), _words().alias("words"))
    return M.cluster_terms(rows, "cluster", F.col("words")).withColumn("weight", F.round("weight", 6))


CLASS_TERMS_SQL = f"""
WITH {S.CLASSED},
words AS (SELECT Sentiments, unnest({S.content('text')}) AS term FROM classed),
ranked AS (
  SELECT Sentiments, term, count(*) AS n, row_number() OVER (PARTITION BY Sentiments ORDER BY count(*) DESC, term) AS r
  FROM words GROUP BY Sentiments, term),
sizes AS (SELECT Sentiments, count(*) AS size FROM classed GROUP BY Sentiments)
SELECT Sentiments AS cluster, r::INTEGER AS rank, term, round(n / size, 6) AS weight
FROM ranked JOIN sizes USING (Sentiments) WHERE r <= 20"""


QUERIES = {
    "class_weights": Query(class_weights, f"WITH {WEIGHTS} SELECT Sentiments, n, weight FROM weights"),
    "weighted_rows": Query(
        weighted_rows, f"WITH {WEIGHTS} SELECT doc_id, weight FROM classed JOIN weights USING (Sentiments)"
    ),
    "nb_log_priors": Query(
        nb_log_priors, f"WITH {MULTINOMIAL} SELECT Sentiments, round(log_prior, 6) AS log_prior FROM priors"
    ),
    "nb_log_probs": Query(
        nb_log_probs, f"WITH {MULTINOMIAL} SELECT term, Sentiments, round(log_p, 6) AS log_p FROM theta"
    ),
    "nb_predict": Query(
        nb_predict,
        f"""WITH {MULTINOMIAL},
            tf AS (
              SELECT doc_id, term, count(*) AS tf
              FROM (SELECT doc_id, unnest({S.content('text')}) AS term FROM documents) GROUP BY doc_id, term),
            sums AS (
              SELECT doc_id, Sentiments, sum(tf * log_p) AS s FROM tf JOIN theta USING (term) GROUP BY doc_id, Sentiments),
            scores AS (
              SELECT d.doc_id, p.Sentiments AS prediction, p.log_prior + coalesce(s, 0) AS score
              FROM documents d CROSS JOIN priors p
              LEFT JOIN sums ON sums.doc_id = d.doc_id AND sums.Sentiments = p.Sentiments)
            SELECT doc_id, prediction FROM (
              SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, prediction) AS r FROM scores)
            WHERE r = 1""",
    ),
    "bernoulli_predict": Query(bernoulli_predict, BERNOULLI_SQL),
    "class_terms": Query(class_terms, CLASS_TERMS_SQL),
    "nb_hashed": Query(nb_hashed),
    "bernoulli_stage": Query(bernoulli_stage),
    "holdout_report": Query(holdout_report),
    "nb_cv": Query(nb_cv),
    "nb_cv_fine": Query(nb_cv_fine),
    "nb_width_cv": Query(nb_width_cv),
    "dt_predict": Query(dt_predict),
    "dt_cv": Query(dt_cv),
    "dt_leaf_cv": Query(dt_leaf_cv),
    "tree_dump": Query(tree_dump),
    "rf_predict": Query(rf_predict),
    "rf_small": Query(rf_small),
    "rf_balanced_cv": Query(rf_balanced_cv),
    "rf_cv": Query(rf_cv),
    "forest_prefix": Query(forest_prefix, "SELECT vec_id, TRUE AS same FROM embeddings"),
    "tree_rules": Query(tree_rules, "SELECT doc_id, 1::BIGINT AS rules, TRUE AS same FROM documents"),
    "rule_counts": Query(rule_counts, "SELECT count(*)::BIGINT AS rows, TRUE AS same FROM lineitem"),
    "rf_draws_cv": Query(rf_draws_cv),
    "svm_rff_predict": Query(svm_rff_predict),
    "eliminate_features": Query(eliminate_features),
    "best_params": Query(best_params),
    "kmeans_assign": Query(kmeans_assign),
    "kmeans_nearest": Query(kmeans_nearest, "SELECT vec_id, true AS nearest FROM embeddings"),
    "dt_stump": Query(dt_stump, STUMP_SQL),
    "scored_rows": Query(scored_rows, "SELECT doc_id, true AS known FROM documents"),
    "nb_cv_exact": Query(nb_cv_exact, NB_CV_SQL),
    "nb_tfidf_predict": Query(nb_tfidf_predict, NB_TFIDF_SQL),
    "nb_lemma_predict": Query(nb_lemma_predict, _lemma_nb_sql("SELECT doc_id, prediction FROM best")),
    "nb_lemma_report": Query(
        nb_lemma_report,
        _lemma_nb_sql(
            """SELECT c.Sentiments AS label, prediction, count(*) AS n FROM best JOIN classed c USING (doc_id)
               GROUP BY c.Sentiments, prediction"""
        ),
    ),
    "cluster_terms": Query(cluster_terms),
}

import math
import threading
import time

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import SparseVector, Vectors
from pyspark.sql import functions as F

from verbatide.operators import features as X
from verbatide.operators import lexicon as L
from verbatide.operators import models as M
from verbatide.plans import classify, cluster
from workload import ALL

TEXTS = [
    (0, "good nice good", "pos"), (1, "nice day good", "pos"), (2, "bad awful", "neg"),
    (3, "awful bad bad day", "neg"), (4, "bus bus stop", "neu"), (5, "good bus", "pos"),
]


@pytest.fixture(scope="module")
def texts(spark):
    df = spark.createDataFrame(TEXTS, "id int, text string, Feelings string")
    return df.withColumn("words", F.split("text", " "))


def test_multinomial_is_sparks_model(spark, texts):
    """The aggregates give the ML stage's priors, weights and predictions."""
    stages = [X.label_indexer(), X.count_vectorizer(X.vocabulary(texts, F.col("words"))), M.naive_bayes(0.1)]
    pipeline = Pipeline(stages=stages).fit(texts)
    labels, terms, nb = pipeline.stages[0].labels, pipeline.stages[1].vocabulary, pipeline.stages[2]
    ours = M.fit_multinomial(texts, "Feelings", F.col("words"))
    theta = nb.theta.toArray()
    for row in ours.log_weights("Feelings").collect():
        want = theta[labels.index(row["Feelings"])][terms.index(row["term"])]
        assert row["log_p"] == pytest.approx(want)
    for name, base in zip(ours.classes, ours.base):
        assert base == pytest.approx(nb.pi.toArray()[labels.index(name)])
    values = X.term_frequencies(texts, "id", F.col("words")).withColumnRenamed("tf", "value")
    got = dict(map(tuple, ours.predict(texts, "id", values).collect()))
    want = {r["id"]: labels[int(r["prediction"])] for r in pipeline.transform(texts).collect()}
    assert got == want


def test_unseen_words_fall_back_on_the_prior(spark, texts):
    model = M.fit_multinomial(texts, "Feelings", F.col("words"))
    new = spark.createDataFrame([(9, ["zzz"]), (8, [])], "id int, words array<string>")
    values = X.term_frequencies(new, "id", F.col("words")).withColumnRenamed("tf", "value")
    assert {tuple(r) for r in model.predict(new, "id", values).collect()} == {(9, "pos"), (8, "pos")}


@pytest.mark.parametrize("common", [1, 3, 1000])
def test_common_terms_are_scored_where_their_text_lies(spark, monkeypatch, common):
    """However many terms are common, seen or not: scores are the same, and only the other terms' rows and a row for
    each text meet the lookup."""
    rows = [(1, ["a", "b", "b", "z"]), (2, ["a", "c"]), (3, []), (4, ["z", "z"]), (2, ["a", "d"]), (None, ["a"])]
    texts = spark.createDataFrame(rows, "id int, words array<string>")
    terms = [("a", [-1.0, -2.0]), ("b", [-3.0, -1.0]), ("c", [-1.0, -4.0]), ("d", [-1.0, -6.5])]
    model = M.TermModel(["x", "y"], [-2.5, -2.0], spark.createDataFrame(terms, "term string, weights array<double>"))
    met, join = [], M.lookup_join

    def watched(facts, *more):
        met.append(facts.count())
        return join(facts, *more)

    monkeypatch.setattr(M, "COMMON", common)
    monkeypatch.setattr(M, "lookup_join", watched)
    values = X.term_frequencies(texts, "id", F.col("words")).withColumnRenamed("tf", "value")
    got = sorted(tuple(r) for r in model.predict(texts.where("id IS NOT NULL").distinct(), "id", values).collect())
    assert got == [(1, "y"), (2, "x"), (2, "x"), (3, "y"), (4, "y")]
    assert met == [{1: 7, 3: 5, 1000: 3}[common]]  # a, z and b come first; three texts have words


def test_word_lists_are_dealt_by_key(spark, texts):
    plan = X.term_frequencies(texts, "id", F.col("words"))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(id" in plan and "term" not in plan.partition("hashpartitioning(")[2].partition(")")[0]
    assert plan.count("Exchange") == 1


def test_bernoulli_by_brute_force(spark, texts):
    values = X.term_frequencies(texts, "id", F.col("words")).select("id", "term", (F.col("tf") / 10.0).alias("value"))
    model = M.fit_bernoulli(texts, "id", "Feelings", values, threshold=0.1)
    got = dict(map(tuple, model.predict(texts, "id", values.withColumn("value", (F.col("value") > 0.1).cast("double"))).collect()))
    vocabulary = sorted({w for _, t, _ in TEXTS for w in t.split()})
    present = {i: {w for w in t.split() if t.split().count(w) / 10 > 0.1} for i, t, _ in TEXTS}
    classes = sorted({c for _, _, c in TEXTS})
    for i, _, _ in TEXTS:
        scores = {}
        for c in classes:
            members = [j for j, _, k in TEXTS if k == c]
            score = math.log(len(members) / len(TEXTS))
            for w in vocabulary:
                p = (sum(w in present[j] for j in members) + 1) / (len(members) + 2)
                score += math.log(p) if w in present[i] else math.log(1 - p)
            scores[c] = score
        assert got[i] == max(classes, key=lambda c: scores[c])


def test_idf_stage_has_the_tables_closed_form(spark, texts):
    fitted = Pipeline(stages=[X.count_vectorizer(X.vocabulary(texts, F.col("words"))), X.idf()]).fit(texts)
    terms, weights = fitted.stages[0].vocabulary, fitted.stages[1].idf.toArray()
    tf = X.term_frequencies(texts, "id", F.col("words"))
    table = {r["term"]: r["idf"] for r in X.idf_table(tf, F.lit(len(TEXTS))).collect()}
    assert table == pytest.approx(dict(zip(terms, weights)))


def test_tfidf_rows_have_length_one(spark, texts):
    tf = X.term_frequencies(texts, "id", F.col("words"))
    rows = X.tfidf(tf, "id", F.lit(len(TEXTS))).groupBy("id").agg(F.sum(F.col("tfidf") ** 2).alias("s")).collect()
    assert [r["s"] for r in rows] == pytest.approx([1.0] * len(TEXTS))


def test_weights_are_made_after_the_shuffle(spark):
    """What travels to a text's other words is the term's count, not a weight; texts without a key are one text."""
    rows = [(1, "a", 2), (1, "b", 1), (2, "a", 1), (None, "a", 1), (None, "c", 3)]
    tf = spark.createDataFrame(rows, "id int, term string, tf bigint")
    weights = X.tfidf(tf, "id", F.lit(3))
    df = {t: sum(r[1] == t for r in rows) for t in "abc"}
    raw = {(i, t): n * (math.log(4 / (df[t] + 1)) + 1) for i, t, n in rows}
    norm = {i: math.sqrt(sum(w * w for (j, _), w in raw.items() if i == j)) for i, _ in raw}
    got = {(r["id"], r["term"]): r["tfidf"] for r in weights.collect()}
    assert got == pytest.approx({(i, t): w / norm[i] for (i, t), w in raw.items()})
    before = weights._jdf.queryExecution().optimizedPlan().toString().partition("RepartitionByExpression")[2]
    assert before and "ln(" not in before.lower() and "log(" not in before.lower()


def test_labels_are_indexed_once(spark):
    """Train and test share one code per class, although their commonest classes differ."""
    train = spark.createDataFrame([(["a"], "x")] * 5 + [(["b"], "y")] * 3 + [(["c"], "z")] * 2, "words array<string>, Feelings string")
    test = spark.createDataFrame([(["b"], "y")] * 5 + [(["a"], "x")] * 2, "words array<string>, Feelings string")
    index = classify.index_labels(train)
    codes = {r["Feelings"]: r["indexedLabel"] for r in classify.with_labels(test, index).collect()}
    assert codes == {"x": 0.0, "y": 1.0}


def test_every_row_is_scored(spark):
    """With classes that training never saw, with missing classes, and without a label column."""
    kind = "words array<string>, Feelings string"
    train = spark.createDataFrame([(["a"], "1")] * 5 + [(["b"], "2")] * 3, kind)
    index = classify.index_labels(train)
    model = classify.text_pipeline(M.naive_bayes(), 64).fit(classify.with_labels(train, index))
    rows = spark.createDataFrame([(["a"], "1"), (["b"], "0"), (["c"], None), ([], "9")], kind)
    assert model.transform(rows).count() == 4 and model.transform(rows.drop("Feelings")).count() == 4
    codes = classify.with_labels(rows, index)
    assert [r["indexedLabel"] for r in codes.collect()] == [0.0, 2.0, 2.0, 2.0]
    hits = model.transform(codes).where("prediction = indexedLabel").count()
    assert hits == 1


def test_rows_of_tree_fits_are_dealt_by_their_binned_size(spark, monkeypatch):
    rows = spark.range(100).withColumn("words", F.array(F.col("id").cast("string"))).coalesce(1)
    assert M.dealt_for_trees(rows, 1000) is rows
    monkeypatch.setattr(M, "BINNED", 40_000)  # ten rows of a thousand features
    dealt = M.dealt_for_trees(rows, 1000)
    sizes = [r["n"] for r in dealt.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 100 and max(sizes) <= 20
    assert sorted(r["id"] for r in dealt.collect()) == list(range(100))
    assert M.dealt_for_trees(rows.where("id < 0"), 1000).count() == 0


def test_tree_queries_deal_their_rows(spark, sf_dir, monkeypatch):
    seen = []
    monkeypatch.setattr(M, "dealt_for_trees", lambda rows, width: seen.append(width) or rows)
    ALL["tree_dump"].run(spark, sf_dir)
    assert seen == [2000]


@pytest.mark.parametrize("make", [lambda: M.decision_tree(bins=8, depth=12), lambda: M.random_forest(trees=4, depth=12)])
def test_trees_keep_node_ids_and_are_those_of_spark_s_defaults(spark, make):
    rng = np.random.default_rng(5)
    rows = [(float(rng.integers(3)), Vectors.dense(rng.normal(size=4).tolist())) for _ in range(200)]
    df = spark.createDataFrame(rows, [M.LABEL, M.FEATURES]).coalesce(2)
    assert make().getCacheNodeIds() and make().getMaxMemoryInMB() == M.NODE_MEMORY > 256
    plain = make().setCacheNodeIds(False).setMaxMemoryInMB(256)
    assert make().fit(df).toDebugString.split("\n")[1:] == plain.fit(df).toDebugString.split("\n")[1:]


def test_deep_forests_raise():
    with pytest.raises(ValueError, match="30"):
        M.random_forest(depth=160)


def test_sequences_and_padding(spark):
    train = spark.createDataFrame([("b a a",), ("c b a",)], "t string").select(F.split("t", " ").alias("w"))
    counts = train.select(F.explode("w").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    index = X.word_index(counts)
    assert {r["word"]: r["id"] for r in index.collect()} == {"a": 1, "b": 2, "c": 3}
    texts = spark.createDataFrame([(1, ["c", "zz", "a"]), (2, ["zz"]), (3, []), (4, ["a", "b", "c", "a"])], "id int, w array<string>")
    rows = X.word_sequences(texts, "id", F.col("w"), index)
    padded = rows.select("id", "sequence", X.pad(F.col("sequence"), 3).alias("p")).collect()
    assert {r["id"]: r["sequence"] for r in padded} == {1: [3, 1], 2: [], 3: [], 4: [1, 2, 3, 1]}
    assert {r["id"]: r["p"] for r in padded} == {1: [3, 1, 0], 2: [0, 0, 0], 3: [0, 0, 0], 4: [2, 3, 1]}


LEXICON = [("run", "v"), ("make", "v"), ("study", "v"), ("go", "v"), ("pass", "v"), ("box", "n"), ("church", "n"), ("man", "n"), ("bus", "n")]


def test_lemmas(spark):
    lexicon = spark.createDataFrame(LEXICON, "lemma string, pos string")
    exceptions = spark.createDataFrame([("went", "v", "go"), ("geese", "n", "goose")], "form string, pos string, lemma string")
    words = ["makes", "making", "studies", "went", "passed", "running", "blah", "run", "pass", "boxes", "geese"]
    vocabulary = spark.createDataFrame([(w,) for w in words], "token string")
    verbs = dict(map(tuple, L.lemma_map(vocabulary, lexicon, "v", exceptions).collect()))
    assert verbs == {"makes": "make", "making": "make", "studies": "study", "went": "go", "passed": "pass"}
    nouns = spark.createDataFrame([(w,) for w in ["boxes", "churches", "men", "bus", "geese"]], "token string")
    # "goose" is not in the lexicon, so its exception does not apply.
    assert dict(map(tuple, L.lemma_map(nouns, lexicon, "n", exceptions).collect())) == {
        "boxes": "box", "churches": "church", "men": "man",
    }


@pytest.mark.parametrize("more", [0, 3000])
def test_mapping_is_one_way_for_all_sizes(spark, more):
    rows = [(1, ["idk", "why", "idk"]), (2, []), (3, None), (4, ["u", "you", "amp"]), (None, ["u"]), (1, ["idk"])]
    df = spark.createDataFrame(rows, "id int, w array<string>")
    entries = [("idk", "i do not know"), ("idk", "z"), ("u", "you"), ("you", "WRONG"), ("amp", None), (None, "x")]
    entries += [(f"word{i}", f"other{i}") for i in range(more)]
    mapping = spark.createDataFrame(entries, "word string, replacement string")
    got = sorted(map(tuple, L.map_words(df, "w", mapping).collect()), key=repr)
    know = "i do not know"
    want = [(1, [know, "why", know]), (1, [know]), (2, []), (3, []), (4, ["you", "WRONG", "amp"]), (None, ["you"])]
    assert got == sorted(want, key=repr)
    got = sorted(map(tuple, L.map_words(df.where("id = 4"), "w", mapping, "NN").collect()))
    assert got == [(4, ["you", "WRONG", "NN"])]


def test_small_dictionary_moves_no_rows(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a"])], "id int, w array<string>")
    mapping = spark.createDataFrame([("a", "x")], "word string, replacement string")
    mapped = L.map_words(df, "w", mapping)
    assert "Exchange" not in mapped._jdf.queryExecution().executedPlan().toString()
    assert mapped.first()["w"] == ["x", "b", "x"]


@pytest.mark.parametrize("default", [None, "NN"])
def test_words_beyond_the_common_ones_find_their_places(spark, monkeypatch, default):
    monkeypatch.setattr(L, "COMMON", 2)
    words = [["a", "b", "c", None, "q", "a"], [], None, ["c"], ["a", "a"], ["d", "q", "e", "d"], ["e", "c", "b", "a"]]
    df = spark.createDataFrame([(i // 2, w) for i, w in enumerate(words * 3)], "id int, w array<string>")
    known = {"a": "A a", "c": "", "d": "a", "e": "d"}
    mapping = spark.createDataFrame([*known.items(), ("never", "met")], "word string, replacement string")
    got = sorted(map(tuple, L.map_words(df, "w", mapping, default).collect()), key=repr)
    want = [(i // 2, [known.get(x, x if default is None else default) for x in w or []]) for i, w in enumerate(words * 3)]
    assert got == sorted(want, key=repr)


def test_abbreviation_table(spark):
    dictionary = spark.createDataFrame([("amp", ""), ("€", " euro ")], "abbrev string, expansion string")
    df = spark.createDataFrame([(1, "Prices up &amp; 5 €")], "id int, text string")
    assert L.expand_abbreviations(df, "text", dictionary).first()["ctext"] == "prices up  5  euro"


def test_tagger(spark):
    tagged = spark.createDataFrame([("a", "DT")] * 2 + [("a", "NN"), ("b", "VB"), ("b", "NN")], "token string, tag string")
    tags = L.most_frequent_tags(L.tag_table(tagged))
    assert dict(map(tuple, tags.collect())) == {"a": "DT", "b": "NN"}
    df = spark.createDataFrame([(1, ["a", "x", "b"])], "id int, w array<string>")
    row = L.tag_words(df, "w", tags).first()
    assert row["pos"] == ["DT", "NN", "NN"] and row["w"] == ["a", "x", "b"]


def test_class_weights(spark):
    df = spark.createDataFrame([("a",)] * 6 + [("b",)] * 2, "c string")
    assert {r["c"]: r["weight"] for r in M.class_weights(df, "c").collect()} == pytest.approx({"a": 8 / 12, "b": 2.0})
    assert {r["c"]: r["weight"] for r in M.with_class_weights(df, "c").collect()} == pytest.approx({"a": 8 / 12, "b": 2.0})


def test_fourier_features_approximate_the_kernel(spark):
    rng = np.random.default_rng(0)
    points = rng.normal(0, 0.3, (20, 5))
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    df = spark.createDataFrame(rows, "i int, x array<double>")
    out = M.fourier_features(df, "x", 5, gamma=1.0, outputs=4000).select("i", vector_to_array(M.FEATURES).alias("z"))
    z = np.array([r["z"] for r in out.orderBy("i").collect()])
    distances = ((points[:, None] - points[None]) ** 2).sum(-1)
    assert np.abs(z @ z.T - np.exp(-distances)).max() < 0.12
    with pytest.raises(ValueError):
        M.fourier_features(df, "x", 10**6, outputs=10**3)


def _rings(spark, n=300):
    """Two classes that no straight line separates."""
    rng = np.random.default_rng(1)
    angle, radius = rng.uniform(0, 2 * math.pi, n), np.where(np.arange(n) % 2 == 0, 0.3, 1.0)
    rows = [([float(r * math.cos(a)), float(r * math.sin(a))], float(i % 2)) for i, (a, r) in enumerate(zip(angle, radius))]
    return spark.createDataFrame(rows, f"x array<double>, {M.LABEL} double")


def test_kernel_machine_learns_rings(spark):
    features = M.fourier_features(_rings(spark), "x", 2, gamma=4.0, outputs=64)
    model = M.rbf_svm(rows=300, iterations=20, parallelism=2).fit(features)
    assert M.accuracy_evaluator().evaluate(model.transform(features)) > 0.95


def test_trees_and_tuning_table(spark):
    df = _rings(spark).select(array_to_vector("x").alias(M.FEATURES), M.LABEL)
    tree = M.decision_tree(bins=32, depth=8)
    fitted = M.cross_validate(tree, M.grid(depth=(tree.maxDepth, [1, 8])), df, folds=2, parallelism=2)
    table = {r["params"]: r for r in M.cv_table(fitted).collect()}
    assert table["maxDepth=8"]["is_best"] and not table["maxDepth=1"]["is_best"]
    assert table["maxDepth=8"]["avg_metric"] > 0.9
    nodes = M.tree_nodes(fitted.bestModel).collect()
    assert {r["feature"] for r in nodes} == {-1, 0, 1} and sum(r["left"] == -1 for r in nodes) == (len(nodes) + 1) // 2
    assert {r["value"] for r in M.best_params(fitted).collect() if r["param"] == "maxDepth"} == {"8"}


def test_feature_elimination_keeps_the_useful_columns(spark):
    rows = spark.range(200).select(
        (F.col("id") % 2).cast("double").alias(M.LABEL),
        array_to_vector(F.array((F.col("id") % 2).cast("double"), F.rand(1), F.rand(2), F.rand(3))).alias(M.FEATURES),
    )
    rounds = M.eliminate_features(rows, 4, folds=2, trees=5).orderBy("round").collect()
    assert [r["features"] for r in rounds] == [4, 3, 2, 1] and rounds[-1]["columns"] == [0]


def test_area_against_the_rest(spark):
    rng = np.random.default_rng(4)
    for classes in (2, 3):
        rows = [(float(rng.integers(0, classes)), (rng.integers(0, 6, classes) / 10).tolist()) for _ in range(80)]
        df = spark.createDataFrame(rows, f"{M.LABEL} double, p array<double>")
        areas = []
        for k in range(classes) if classes > 2 else [1]:
            pos, neg = ([p[k] for y, p in rows if (y == k) == side] for side in (True, False))
            areas.append(np.mean([(a > b) + (a == b) / 2 for a in pos for b in neg]))
        got = M.RestAreaEvaluator().evaluate(df.select(M.LABEL, array_to_vector("p").alias("probability")))
        assert got == pytest.approx(np.mean(areas))


def test_feature_elimination_weighs_classes_and_grows_full_trees(spark, monkeypatch):
    """On skewed classes without a signal the area is about one half, where accuracy is 0.9."""
    made, weights = [], []
    forest, weigh = M.random_forest, M.with_class_weights
    monkeypatch.setattr(M, "random_forest", lambda *a, **k: made.append(forest(*a, **k)) or made[-1])

    def see(df, label, name):
        weighted = weigh(df, label, name)
        weights.append({r[0]: r[1] for r in weighted.select(label, name).distinct().collect()})
        return weighted

    monkeypatch.setattr(M, "with_class_weights", see)
    rows = spark.range(300).select(
        (F.col("id") % 10 == 0).cast("double").alias(M.LABEL),
        array_to_vector(F.array(F.rand(5), F.rand(6))).alias(M.FEATURES),
    )
    got = M.eliminate_features(rows, 2, folds=2, trees=5).collect()
    assert all(0.25 < r["roc_auc"] < 0.75 for r in got)
    assert {(f.getMaxDepth(), f.getWeightCol()) for f in made} == {(30, "_weight")}
    assert weights == [pytest.approx({1.0: 5.0, 0.0: 5 / 9})]


def test_feature_elimination_goes_on_where_it_was_ended(spark, monkeypatch, tmp_path):
    rows = spark.range(120).select(
        (F.col("id") % 2).cast("double").alias(M.LABEL),
        array_to_vector(F.array((F.col("id") % 2).cast("double"), F.rand(1), F.rand(2))).alias(M.FEATURES),
    ).persist()
    made, forest, ledger = [], M.random_forest, str(tmp_path / "ledger")

    def ends_after(most):
        def fit(*a, **k):
            if len(made) == most:
                raise RuntimeError("ended")
            made.append(1)
            return forest(*a, **k)

        monkeypatch.setattr(M, "random_forest", fit)

    ends_after(4)  # in the second round
    with pytest.raises(RuntimeError, match="ended"):
        M.eliminate_features(rows, 3, folds=2, trees=3, ledger=ledger, parallelism=1)
    finished = spark.read.parquet(ledger).count()
    assert 3 <= finished <= 4
    made.clear()
    ends_after(99)
    got = M.eliminate_features(rows, 3, folds=2, trees=3, ledger=ledger, parallelism=1).collect()
    assert [r["features"] for r in got] == [3, 2, 1] and len(made) == 8 - finished  # three fits a round, two in the last
    made.clear()
    assert M.eliminate_features(rows, 3, folds=2, trees=3, ledger=ledger).collect() == got and not made


def test_forest_grid_is_cut_from_one_fit(spark):
    rng = np.random.default_rng(2)
    points = [(i, [float(x) for x in p], float((p[0] > 0) != (p[1] > 0))) for i, p in enumerate(rng.normal(0, 1, (150, 2)))]
    df = spark.createDataFrame(points, f"vec_id long, x array<double>, {M.LABEL} double").withColumn(M.FEATURES, array_to_vector("x")).persist()
    table = M.forest_cv(df, [2, 6], [1, 5], folds=2).collect()
    assert [(r["trees"], r["depth"]) for r in table] == [(2, 1), (2, 5), (6, 1), (6, 5)] and sum(r["is_best"] for r in table) == 1
    assert table[3]["avg_metric"] > 0.75 > table[0]["avg_metric"]
    path = M.save_trees(M.random_forest(6, 5, seed=42).fit(df))
    whole, cut = M.nodes_of(path), M.cut_forest(path, 2, 3)
    assert cut.getNumTrees == 2 and max(t.depth for t in cut.trees) <= 3 and cut.numFeatures == 2
    paths = {(r["tree"], r["node"]): r for r in M.tree_paths(whole).collect()}
    assert len(paths) == whole.count() and all(len(r["path"]) == r["depth"] for r in paths.values())
    rules = [r for r in M.tree_rules(whole).collect() if r["tree"] == 0]
    for _, x, _ in points[:40]:
        met = [r for r in rules if r["rule"] == "always" or eval(r["rule"], {"f0": x[0], "f1": x[1]})]
        assert len(met) == 1


def test_forest_draws_are_repeatable_and_valid():
    drawn = M.random_forest_draws(50, seed=1)
    assert drawn == M.random_forest_draws(50, seed=1)
    assert all(70 <= t < 80 for t in drawn["trees"]) and min(drawn["features"]) >= 1


def test_trigram_clusters(spark):
    rows = [(i, t) for i, t in enumerate(["red fox runs far", "red fox runs home", "blue sea calm day", "blue sea calm night"] * 5)]
    df = spark.createDataFrame(rows, "id int, text string")
    got = cluster.trigram_clusters(df, "text", k=2, width=512).collect()
    groups = {r["text"].split()[0]: r["cluster"] for r in got}
    assert len(got) == 20 and groups["red"] != groups["blue"]
    terms = cluster.trigram_cluster_terms(df, "text", k=2, terms=1, width=512).collect()
    assert {(r["term"], r["weight"]) for r in terms} == {("red fox runs", 1.0), ("blue sea calm", 1.0)}


def test_fit_and_score_reports_the_test_part(spark):
    rows = [(i, ["good"] if i % 2 else ["bad"], "1" if i % 2 else "0") for i in range(400)]
    df = spark.createDataFrame(rows, "id int, words array<string>, Feelings string")
    result = classify.fit_and_score(M.naive_bayes(), df.where("id < 300"), df.where("id >= 300"), "id", 128)
    report = {r["class"]: r for r in result.report().collect()}
    assert report["accuracy"]["f1"] == 1.0
    assert report["accuracy"]["support"] == result.test.count() != result.validation.count()


def test_vector_total_of_wide_vectors(spark):
    """Whole arrays of these vectors would be 8 GB a row."""
    wide = SparseVector(1_000_000_000, {3: 1.5, 999_999_999: 2.0})
    rows = spark.createDataFrame([(1, wide), (2, Vectors.dense([1.0, -3.0])), (3, Vectors.sparse(9, {}))], ["i", "v"])
    assert dict(rows.select("i", X.vector_total("v")).collect()) == {1: 3.5, 2: -2.0, 3: 0.0}


def test_count_vectorizer_takes_a_large_vocabulary(spark):
    """Handed over singly, these terms take over half a minute."""
    terms = [f"w{i}" for i in range(400_000)]
    start = time.time()
    model = X.count_vectorizer(terms)
    assert time.time() - start < 20
    assert model.vocabulary[-1] == "w399999" and model.getVocabSize() == 400_000
    rows = spark.createDataFrame([(["w399999", "w1", "w1", "other"],), ([],)], "words array<string>")
    assert [r[0] for r in model.transform(rows).select("rawFeatures").collect()] == [
        SparseVector(400_000, {1: 2.0, 399_999: 1.0}), SparseVector(400_000, {})
    ]


def test_drawn_forests_are_fitted_one_at_a_time(spark, sf_dir, monkeypatch):
    """The driver holds every forest that is being fitted; five side by side were too much for it."""
    fit, lock, state = M.RandomForestClassifier._fit, threading.Lock(), {"now": 0, "most": 0, "fits": 0}

    def counted(self, rows):
        with lock:
            state["now"] += 1
            state["fits"] += 1
            state["most"] = max(state["most"], state["now"])
        try:
            return fit(self.copy({self.numTrees: 1, self.maxDepth: 1}), rows)
        finally:
            with lock:
                state["now"] -= 1

    monkeypatch.setattr(M.RandomForestClassifier, "_fit", counted)
    assert ALL["rf_draws_cv"].run(spark, sf_dir).count() == 5
    assert state["fits"] == 11 and state["most"] == 1  # five draws in two folds, and the winner


def test_wide_vocabularies_stay_tables(spark, sf_dir, monkeypatch):
    """More terms than the driver may hold raised; as tables they give the vectors and weights of the ML stages."""
    rows = [(1, ["b", "a", "b"]), (2, ["c", "a"]), (3, ["a"]), (2, ["c", "a"]), (None, ["d", "d", "a"])]
    df = spark.createDataFrame(rows, "id int, words array<string>")

    def stages():
        counts = X.count_vectorizer(X.vocabulary(df, F.col("words")))
        model = Pipeline(stages=[counts, X.idf()]).fit(df)
        new = spark.createDataFrame([(9, ["a", "x"]), (8, ["x"])], df.schema)
        weighed = [model.transform(df), model.transform(new)]
        return [sorted(map(str, w.select("id", "words", "rawFeatures", "features").collect())) for w in weighed]

    total = lambda: sorted(map(tuple, ALL["idf_stage"].run(spark, sf_dir).collect()))
    want, totals = stages(), total()
    monkeypatch.setattr(X, "MAX_VOCABULARY", 3)
    assert isinstance(X.count_vectorizer(X.vocabulary(df, F.col("words"))), X.TermVectorizer)
    assert stages() == want
    assert total() == totals and len(totals) == 200

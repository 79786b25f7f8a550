"""Reading, appending, CSV extracts, row numbers and saved models."""

from __future__ import annotations

from pyspark.sql import functions as F

from verbatide.operators import features, models
from verbatide.operators.rowsets import with_row_index
from verbatide.plans.classify import add_words, index_labels, text_pipeline, with_labels
from verbatide.session import scratch_path
from verbatide.plans.explore import content_words
from verbatide.sources import append_once, append_rows, drop_table, load_model, load_term_model, read_source, save_csv, save_model, save_term_model
from workload.tables import Query, documents, labelled, table


def csv_round_trip(spark, sf_dir):
    """Whole texts, with their quotes and line breaks, through a CSV and back."""
    docs = documents(spark, sf_dir, "source")
    path = scratch_path(spark, "csv")
    save_csv(docs, ["doc_id", "source", "text"], path)
    schema = docs.select("doc_id", "source", "text").schema
    return read_source(spark, "csv", path, schema)


def catalog_table(spark, sf_dir):
    table(spark, sf_dir, "customer").createOrReplaceTempView("verbatide_customers")
    return read_source(spark, "table", "verbatide_customers").select("c_custkey", "c_name", "c_acctbal")


def append_twice(spark, sf_dir):
    """Two appends to one place, the second with a dense row index."""
    path = scratch_path(spark, "append")
    nations = table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    parts = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("int").alias("n_nationkey"), F.col("s_name").alias("n_name")
    )
    append_rows(nations.withColumn("index", F.col("n_nationkey").cast("long")), "parquet", path)
    append_rows(parts, "parquet", path, index_by="n_nationkey")
    return read_source(spark, "parquet", path).select("n_nationkey", "n_name", "index")


def append_retried(spark, sf_dir):
    """Two batches; the first was ended after half of its rows, then retried twice under its name."""
    path = scratch_path(spark, "append")
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_totalprice")
    early, late = orders.where("o_orderkey % 3 = 0"), orders.where("o_orderkey % 3 > 0")
    append_rows(early.where("o_orderkey % 2 = 0").withColumn("batch", F.lit("early")), "parquet", path)
    for rows, batch in ((early, "early"), (late, "late"), (early, "early")):
        append_once(rows, "parquet", path, batch, "o_orderkey")
    return read_source(spark, "parquet", path)


def json_round_trip(spark, sf_dir):
    rows = table(spark, sf_dir, "orders", "o_orderkey", "o_orderpriority", "o_totalprice")
    path = scratch_path(spark, "json")
    append_rows(rows, "json", path)
    return read_source(spark, "json", path, rows.schema)


def row_index(spark, sf_dir):
    rows = table(spark, sf_dir, "orders", "o_orderkey", "o_totalprice")
    return with_row_index(rows, ["o_totalprice", "o_orderkey"])


def drop_then_recreate(spark, sf_dir):
    """A table is written, dropped with its data, and written anew at the same place: were the
    first rows still there, each would count twice."""
    path, rows = scratch_path(spark, "regions"), table(spark, sf_dir, "customer", "c_custkey", "c_mktsegment")
    drop_table(spark, "verbatide_regions")
    append_rows(rows, "table", "verbatide_regions", options={"path": path})
    drop_table(spark, "verbatide_regions")
    append_rows(rows, "parquet", path)
    return read_source(spark, "parquet", path).groupBy("c_mktsegment").agg(F.count("*").alias("n"))


def model_round_trip(spark, sf_dir):
    """A saved and reloaded pipeline scores all documents as the one that was saved."""
    train = add_words(labelled(spark, sf_dir), "text")
    index = index_labels(train)
    model = text_pipeline(models.naive_bayes(), 2000).fit(with_labels(train, index))
    path = scratch_path(spark, "model")
    save_model(model, path)
    rows = add_words(documents(spark, sf_dir), "text").select("doc_id", "words")
    names = features.label_names(index)
    saved = names.transform(model.transform(rows)).select("doc_id", F.col("predictedLabel").alias("saved"))
    loaded = names.transform(load_model(path).transform(rows)).select("doc_id", "predictedLabel")
    same = (F.col("saved") == F.col("predictedLabel")).alias("same")
    return loaded.join(saved, "doc_id").select("doc_id", same)


def term_model_round_trip(spark, sf_dir):
    """A saved and reloaded exact model predicts for all documents what the one that was saved predicts."""
    words = content_words(F.col("text"))
    model = models.fit_multinomial(labelled(spark, sf_dir), "Sentiments", words)
    path = scratch_path(spark, "model")
    save_term_model(model, path)
    docs = documents(spark, sf_dir)
    values = features.term_frequencies(docs, "doc_id", words).withColumnRenamed("tf", "value")
    saved, loaded = (m.predict(docs, "doc_id", values) for m in (model, load_term_model(spark, path)))
    both = saved.join(loaded.withColumnRenamed("prediction", "again"), "doc_id")
    return both.select("doc_id", (F.col("prediction") == F.col("again")).alias("same"))


QUERIES = {
    "csv_round_trip": Query(csv_round_trip, "SELECT doc_id, source, text FROM documents"),
    "catalog_table": Query(catalog_table, "SELECT c_custkey, c_name, c_acctbal FROM customer"),
    "append_twice": Query(
        append_twice,
        """SELECT n_nationkey, n_name, n_nationkey::BIGINT AS "index" FROM nation
           UNION ALL
           SELECT s_suppkey::INTEGER, s_name, row_number() OVER (ORDER BY s_suppkey) - 1 FROM supplier""",
    ),
    "append_retried": Query(
        append_retried,
        """SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 3 = 0 THEN 'early' ELSE 'late' END AS batch FROM orders""",
    ),
    "json_round_trip": Query(json_round_trip, "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders"),
    "row_index": Query(
        row_index,
        """SELECT o_orderkey, o_totalprice,
                  row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS "index" FROM orders""",
    ),
    "drop_then_recreate": Query(
        drop_then_recreate, "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY c_mktsegment"
    ),
    "term_model_round_trip": Query(term_model_round_trip, "SELECT doc_id, true AS same FROM documents"),
    "model_round_trip": Query(model_round_trip, "SELECT doc_id, true AS same FROM documents"),
}

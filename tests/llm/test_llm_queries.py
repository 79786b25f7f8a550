"""Registered queries against their SQL, and the pipeline against brute force, stage by stage."""

import corpus_pipeline
import pytest
from oracle import database, differences
from pyspark.sql import functions as F
from test_llm_operators import VOCABULARY, brute_components, brute_leaks, brute_lines

from fractions import Fraction
from verbatide.llm.queries import QUERIES


@pytest.fixture(scope="module")
def connection(sf_dir):
    return database(sf_dir)


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_same_as_sql(spark, sf_dir, connection, name):
    assert differences(QUERIES[name].run(spark, sf_dir), connection, QUERIES[name].sql) == []


@pytest.mark.parametrize("name", ["op6_fingerprint", "op8_decontaminate", "op9_line_dedup"])
def test_native_queries_need_no_python(spark, sf_dir, name):
    plan = QUERIES[name].run(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_language_accuracy_on_held_out_texts(spark, sf_dir):
    named = QUERIES["op3_language_id"].run(spark, sf_dir)
    truth = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    held = named.where("held_out").join(truth, "doc_id")
    right = held.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.98


def test_every_row_is_in_every_result(spark, sf_dir):
    n = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for name in ("op2_suffix_dedup", "op5_token_counts", "op7_lm_score", "op10_bpe_codec"):
        assert QUERIES[name].run(spark, sf_dir).count() == n


def test_pipeline_by_brute_force(spark, sf_dir):
    from tokenizers import Tokenizer

    source = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").limit(60).toPandas()
    rows = list(zip(source["doc_id"].tolist(), source["text"].tolist()))
    rows += [(1000, rows[0][1]), (1001, "12 ?"), (1002, None)]
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    rows.append((1003, rows[1][1] + " " + bench[0]["text"]))
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    stages = dict(corpus_pipeline.STAGES)
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language ID", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "BPE encoding and decoding"
    ]
    one = stages["language ID"](spark, docs, sf_dir)
    assert {r["doc_id"] for r in one.collect()} == {i for i, _ in rows} - {1001, 1002} and one.columns == docs.columns
    rows = [(i, t) for i, t in rows if i not in (1001, 1002)]
    two = stages["line dedup"](spark, one, sf_dir)
    rows = [(i, t) for i, _, _, t in brute_lines(rows)]
    assert sorted((r["doc_id"], r["text"]) for r in two.collect()) == sorted(rows)
    assert all(r["n_chars"] == len(r["text"]) for r in two.collect())
    three = stages["n-gram Jaccard join"](spark, two, sf_dir)
    rows = [(i, t) for i, t in rows if i in {d for d, _, c in brute_components(rows, 5, Fraction(4, 5)) if d == c}]
    assert {r["doc_id"] for r in three.collect()} == {i for i, _ in rows}
    four = stages["benchmark decontamination"](spark, three, sf_dir)
    leaks = {d for d, *_ in brute_leaks(rows, [(b["item_id"], b["text"]) for b in bench])}
    rows = [(i, t) for i, t in rows if i not in leaks]
    assert {r["doc_id"] for r in four.collect()} == {i for i, _ in rows} and four.columns == docs.columns
    last = stages["BPE encoding and decoding"](spark, four, sf_dir)
    library = Tokenizer.from_file(VOCABULARY)
    want = {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in rows}
    assert {r["doc_id"]: r["n_tokens"] for r in last.collect()} == want


def test_run_writes_every_stage(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

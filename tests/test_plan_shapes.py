"""Physical plans: what reaches the scan, what is broadcast, what never happens."""

import pytest
from pyspark.sql import functions as F

from workload import ALL
from workload import tables


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_read_only_the_columns_used(spark, sf_dir):
    text = plan(ALL["term_topk"].run(spark, sf_dir))
    assert "ReadSchema: struct<text:string>" in text
    assert "TakeOrderedAndProject" in text


def test_class_filter_reaches_the_scan(spark, sf_dir):
    rows = tables.table(spark, sf_dir, "events").where(F.col("event_type") == "error").select("event_id")
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,error)]" in plan(rows)


def test_rank_limits_apply_before_the_shuffle(spark, sf_dir):
    text = plan(ALL["common_words_per_class"].run(spark, sf_dir))
    assert text.count("WindowGroupLimit") == 2  # partial and final


def test_texts_are_split_once_per_use(spark, sf_dir):
    """The outer explode keeps the optimizer from copying the split into a filter."""
    text = plan(ALL["term_counts"].run(spark, sf_dir))
    assert text.count("split(") == 1


@pytest.mark.parametrize(
    "name", ["tfidf_l2", "text_to_seq", "nb_predict", "areas", "charlen_hist", "lemma_join", "expand_abbrev"]
)
def test_no_cross_joins(spark, sf_dir, name):
    text = plan(ALL[name].run(spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["clean_a", "clean_b", "strip_html", "polarity", "dates", "hashtags"])
def test_row_functions_need_no_python_and_no_keyed_shuffle(spark, sf_dir, name):
    text = plan(ALL[name].run(spark, sf_dir))
    assert "Python" not in text and "hashpartitioning" not in text


def test_counts_are_combined_before_the_shuffle(spark, sf_dir):
    text = plan(ALL["drop_duplicates_keep_first"].run(spark, sf_dir))
    assert "partial_min" in text and "Window" not in text

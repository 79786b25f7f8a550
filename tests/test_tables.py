"""Profiles, recoding, row sets, orderings and joins on small literal tables."""

import math

import pytest
from pyspark.sql import functions as F

from verbatide.functions import recode as R
from verbatide.operators import frequency, ordering, profile, rowsets, sizing
from verbatide.operators.skew import lookup_join


def test_polarity(column):
    scores = [-0.5, 0.0, 0.5, None, math.nan]
    assert column(R.polarity, scores, "double") == ["Negative", "Neutral", "Positive", "Neutral", "Neutral"]


def test_codes(column):
    names = ["Negative", "Neutral", "Positive", "other", None]
    assert column(R.class_code, names) == ["1", "0", "2", "0", "0"]
    assert column(R.map_codes, names) == [2, 0, 1, None, None]
    levels = ["Extremely Negative", "Extremely Positive", "?", None]
    assert column(R.collapse_levels, levels) == ["Negative", "Positive", "Neutral", "Neutral"]


def test_numbers(column):
    assert column(lambda c: R.to_number(c, strict=False), ["1.5", "x", None]) == [1.5, None, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        column(R.to_number, ["x"])


def test_rename_missing_column_raises(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert R.rename(df, a="b").columns == ["b"]
    with pytest.raises(ValueError):
        R.rename(df, text="b")


def test_missing_values(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, math.nan), (4, 4.0)], "id int, x double")
    assert {r["column"]: r["nulls"] for r in profile.null_counts(df).collect()} == {"id": 0, "x": 2}
    assert {r["column"]: r["non_null"] for r in profile.non_null_counts(df).collect()} == {"id": 4, "x": 2}
    assert [r["x"] for r in profile.impute_mean(df, "x").orderBy("id").collect()] == [1.0, 2.5, 2.5, 4.0]
    assert profile.drop_missing(df, ["x"]).count() == 2
    assert "x: double" in profile.schema_text(df)


def test_duplicates_with_nulls_and_ids(spark):
    df = spark.createDataFrame([(3, "a", None), (1, "a", None), (2, "b", "x")], "id int, t string, u string")
    assert not profile.has_duplicates(df).first()[0]
    assert profile.has_duplicates(df, ["id"]).first()[0]
    assert {tuple(r) for r in profile.drop_duplicates(df, "id").collect()} == {(1, "a", None), (2, "b", "x")}
    assert not profile.has_duplicates(df.where("id > 5")).first()[0]


def test_keyed_split_is_stable_under_partitioning(spark):
    df = spark.range(5000)
    a = rowsets.keyed_split(df, "id", [0.8, 0.2], 7)
    b = rowsets.keyed_split(df.repartition(13), "id", [0.8, 0.2], 7)
    ids = [{r["id"] for r in part.collect()} for part in a]
    assert ids == [{r["id"] for r in part.collect()} for part in b]
    assert not ids[0] & ids[1] and len(ids[0] | ids[1]) == 5000
    assert 0.75 < len(ids[0]) / 5000 < 0.85


def test_nested_holdout_shares(spark):
    train, test = spark.range(10_000), spark.range(10_000, 20_000)
    sizes = [part.count() for part in rowsets.nested_holdout(train, test, "id")]
    assert sum(sizes) == 20_000
    assert abs(sizes[2] - 3000) < 250 and abs(sizes[0] / (sizes[0] + sizes[1]) - 0.8) < 0.02


def test_dense_index_is_global(spark):
    df = spark.range(10_000).select(F.pmod(F.xxhash64("id"), F.lit(997)).alias("k"), "id")
    got = ordering.dense_index(df.repartition(16), [F.desc("k"), F.asc("id")], "at").orderBy("at").collect()
    want = sorted(((r["k"], r["id"]) for r in df.collect()), key=lambda p: (-p[0], p[1]))
    assert [r["at"] for r in got] == list(range(10_000))
    assert [(r["k"], r["id"]) for r in got] == want


def test_dense_index_splits_a_common_key(spark):
    """Half of the rows share a key; the sort still deals them to several ranges."""
    df = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("k"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    ranges = ordering._ranged(df, [F.asc("k"), F.xxhash64("k", "id")])
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert ranges.where("k = 7").select("_range").distinct().count() > 1
    got = ordering.dense_index(df, [F.asc("k")], "at").collect()
    assert sorted(r["at"] for r in got) == list(range(20_000))
    assert [r["k"] for r in sorted(got, key=lambda r: r["at"])] == sorted(r["k"] for r in got)


def test_running_totals(spark):
    df = spark.range(1, 5001).select("id", F.col("id").alias("v"))
    rows = ordering.running_totals(df.repartition(9), [F.asc("id")], {"v": "upto"}).collect()
    assert all(r["upto"] == r["id"] * (r["id"] + 1) // 2 for r in rows)
    assert {r["upto_all"] for r in rows} == {5000 * 5001 // 2}
    empty = ordering.running_totals(df.where("id < 0"), [F.asc("id")], {"v": "upto"})
    assert empty.count() == 0


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_join_with_a_hot_key(spark, how):
    """A third of the rows share one key; some keys, one of them hot, have no lookup row."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, "lost").otherwise(F.concat(F.lit("k"), F.col("id") % 50))
    facts = spark.range(3000).select(key.alias("k"), "id")
    lookup = spark.range(45).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("v"))
    lookup = lookup.unionByName(spark.createDataFrame([("hot", -1)], "k string, v bigint"))
    want = sorted(map(tuple, facts.join(lookup, "k", how).select("k", "id", "v").collect()), key=repr)
    counted = facts.groupBy("k").agg(F.count("*").alias("n"))
    for counts in (None, counted):
        joined = lookup_join(facts, lookup, "k", counts, how, share=10, least=5)
        assert sorted(map(tuple, joined.select("k", "id", "v").collect()), key=repr) == want


def test_salts_spread_the_hot_key(spark):
    """No task of the salted join gets the whole hot key."""
    facts = spark.range(20_000).select(F.lit("hot").alias("k"), "id")
    lookup = spark.createDataFrame([("hot", 1)], "k string, v int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = lookup_join(facts, lookup, "k", least=100).withColumn("p", F.spark_partition_id())
        sizes = [r["count"] for r in joined.groupBy("p").count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 20_000 and len(sizes) == 8 and max(sizes) < 6000


def test_rows_without_a_key_are_dealt_too(spark):
    facts = spark.range(20_000).select(F.lit(None).cast("string").alias("k"), "id")
    lookup = spark.createDataFrame([("a", 1)], "k string, v int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = lookup_join(facts, lookup, "k", how="left").withColumn("p", F.spark_partition_id())
        sizes = [r["count"] for r in joined.groupBy("p").count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 20_000 and len(sizes) == 8 and max(sizes) < 6000


def test_small_rows(spark):
    assert len(sizing.small_rows(spark.range(5), 5)) == 5
    assert sizing.small_rows(spark.range(6), 5) is None


def test_histogram_against_numpy(spark):
    import numpy as np

    values = {"a": [1, 1, 2, 5, 11, 21, 20, 3, 3, 3], "b": [4, 4, 4], "c": [0, 10]}
    rows = [(c, v) for c, vs in values.items() for v in vs] + [("a", None), (None, 3), ("d", None)]
    df = spark.createDataFrame(rows, "c string, v int")
    got = frequency.histogram(df, "c", F.col("v")).collect()
    assert {r["c"] for r in got} == {"a", "b", "c"}
    for name, data in values.items():
        counts, edges = np.histogram(data, bins=10)
        bins = sorted((r for r in got if r["c"] == name), key=lambda r: r["bin"])
        assert [r["n"] for r in bins] == counts.tolist()
        assert np.allclose([r["bin_from"] for r in bins] + [bins[-1]["bin_to"]], edges)


def test_class_distribution_drops_nulls(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "c string")
    assert [tuple(r) for r in frequency.class_distribution(df, "c").collect()] == [("a", 2)]


def test_common_words_drop_stop_words_after_the_cut(spark):
    words = ["the"] * 5 + ["cat"] * 4 + ["dog"] * 3
    df = spark.createDataFrame([("x", words)], "c string, w array<string>")
    rows = frequency.common_words(df, "c", F.col("w"), ["the"], k=2).collect()
    assert [tuple(r) for r in rows] == [("x", "cat", 4)]
    weights = frequency.term_weights(df, "c", F.col("w"), ["the"]).collect()
    assert {(r["word"], r["weight"]) for r in weights} == {("cat", 1.0), ("dog", 0.75)}


def test_popular_tags_rank_joined_tags(spark):
    rows = [("",)] * 3 + [("#a #b",)] * 2 + [("#a",)]
    df = spark.createDataFrame(rows, "t string")
    from verbatide.functions import text as T

    tags = T.hashtag_list(F.col("t"))
    assert [tuple(r) for r in frequency.popular_tags(df, tags).collect()] == [("a b", 2), ("a", 1)]
    assert [tuple(r) for r in frequency.popular_tags(df, tags, 1, 1, per_tag=True).collect()] == [("a", 3)]


def test_exact_split_sizes_and_strata(spark):
    rows = [(i, "abc"[i % 3] if i % 7 else None) for i in range(500)] + [(3, "a")] * 40
    df = spark.createDataFrame(rows, "id long, kind string").withColumn("_rank", F.lit(1))
    parts = rowsets.exact_split(df, "id", [7, 2, 1], 5, by="kind")
    counts = [{r["kind"]: r["n"] for r in p.groupBy("kind").agg(F.count("*").alias("n")).collect()} for p in parts]
    for kind in ("a", "b", "c", None):
        n = sum(k == kind for _, k in rows)
        ends = [int(n * share + 0.5) for share in (0.7, 0.9, 1.0)]
        assert [c[kind] for c in counts] == [ends[0], ends[1] - ends[0], ends[2] - ends[1]]
    assert sorted(map(tuple, parts[0].union(parts[1]).union(parts[2]).collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)
    assert [p.count() for p in rowsets.exact_split(df, "id", [1, 1], 5)] == [270, 270]
    assert [p.count() for p in rowsets.exact_split(df, "id", [1, 0], 5)] == [540, 0]
    assert rowsets.exact_split(df.limit(0), "id", [1, 1], 5)[0].count() == 0

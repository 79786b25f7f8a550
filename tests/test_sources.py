import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from verbatide import schemas
from verbatide.plans import prepare
from verbatide.session import scratch_path, shared_folder
from verbatide.operators import features, models
from verbatide.sources import (
    append_once,
    append_rows,
    drop_table,
    load_term_model,
    read_source,
    save_csv,
    save_term_model,
)
from verbatide.sources.readers import LATIN_1, URI_VARIABLE, collection_options
from verbatide.streaming import append_stream, clean_stream

TWEETS = [
    ("Paris, FR", 'He said "no"\nthen left', "09-03-2020", "Extremely Negative"),
    (None, "café #ok", "10-03-2020", "Positive"),
    ("x", "", "11-03-2020", None),
]


def test_latin1_csv_with_quotes_and_line_breaks(spark):
    path = scratch_path(spark, "csv")
    df = spark.createDataFrame(TWEETS, schemas.TEXTS_FIVE_LEVEL)
    save_csv(df, df.columns, path, {"encoding": "ISO-8859-1", "nullValue": "\\N"})
    raw = b"".join(open(os.path.join(path, f), "rb").read() for f in os.listdir(path) if f.endswith(".csv"))
    assert b"caf\xe9" in raw
    back = read_source(spark, "csv", path, schemas.TEXTS_FIVE_LEVEL, {"nullValue": "\\N", **LATIN_1})
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(TWEETS, key=repr)


def test_utf8_is_the_default_both_ways(spark):
    path = scratch_path(spark, "csv")
    df = spark.createDataFrame([("한 ✂ café", 1)], "t string, n int")
    save_csv(df, df.columns, path)
    assert [tuple(r) for r in read_source(spark, "csv", path, df.schema).collect()] == [("한 ✂ café", 1)]
    with pytest.raises(Exception, match="MALFORMED_CHARACTER_CODING"):
        save_csv(df, df.columns, scratch_path(spark, "csv"), LATIN_1)


@pytest.mark.parametrize("row_end", ["\n", "\r\n"])
@pytest.mark.parametrize("inside", ["\n", "\r\n"])
def test_line_ends_between_rows_and_inside_fields(spark, tmp_path, row_end, inside):
    lines = ["OriginalTweet,Sentiment", f'"one{inside}two",Positive', "three,Negative", ""]
    (tmp_path / "x.csv").write_bytes(row_end.join(lines).encode())
    rows = read_source(spark, "csv", str(tmp_path), StructType.fromDDL("OriginalTweet string, Sentiment string")).collect()
    assert [r["Sentiment"] for r in rows] == ["Positive", "Negative"]
    assert rows[0]["OriginalTweet"].replace("\r\n", "\n") == "one\ntwo"


@pytest.mark.parametrize("row", ["3", "4,5,6", "x,5"])
def test_malformed_rows_raise(spark, tmp_path, row):
    (tmp_path / "x.csv").write_text(f"a,b\n1,2\n{row}\n")
    with pytest.raises(Exception, match="MALFORMED"):
        read_source(spark, "csv", str(tmp_path), StructType.fromDDL("a int, b int")).collect()


def test_dropping_a_table_removes_its_files(spark, tmp_path):
    path = str(tmp_path / "rows")
    append_rows(spark.range(3), "table", "verbatide_dropped", options={"path": path})
    assert os.path.exists(path)
    drop_table(spark, "verbatide_dropped")
    assert not os.path.exists(path) and not spark.catalog.tableExists("verbatide_dropped")


def test_schema_is_required_for_text_formats(spark):
    with pytest.raises(ValueError, match="schema"):
        read_source(spark, "csv", "/nowhere")
    with pytest.raises(ValueError, match="kind"):
        read_source(spark, "xlsx", "/nowhere")


def test_append_with_index_and_inference(spark):
    path = scratch_path(spark, "json")
    df = spark.createDataFrame([("b",), ("a",)], "k string")
    append_rows(df, "json", path, index_by="k")
    append_rows(df.withColumn("index", F.lit(9)), "json", path)
    rows = sorted(map(tuple, read_source(spark, "json", path, infer=True).select("k", "index").collect()))
    assert rows == [("a", 0), ("a", 9), ("b", 1), ("b", 9)]


def test_catalog_table_and_drop(spark):
    spark.range(3).createOrReplaceTempView("some_rows")
    assert read_source(spark, "table", "some_rows").count() == 3
    drop_table(spark, "no_such_table")


def test_collection_options_take_the_uri_from_the_environment(monkeypatch):
    monkeypatch.delenv(URI_VARIABLE, raising=False)
    assert collection_options("d", "c") == {"database": "d", "collection": "c"}
    monkeypatch.setenv(URI_VARIABLE, "mongodb://host")
    assert collection_options("d", "c")["connection.uri"] == "mongodb://host"


def test_shared_folder_is_the_configured_one(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_folder(spark) == named
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_prepare_pipeline(spark):
    five = spark.createDataFrame(TWEETS, schemas.TEXTS_FIVE_LEVEL)
    scored = spark.createDataFrame(
        [("A <b>x</b>", "L", "2020-04-05", "-1.5"), ("B", "L", "2020-04-06", None), ("B", "L", "2020-04-06", None)],
        schemas.TEXTS_SCORED,
    )
    rows = prepare.prepare(five, scored).collect()
    got = {(r["ctext"], r["Feelings"], r["Sentiments"], r["TweetAt"]) for r in rows}
    assert len(rows) == 5  # the duplicate is gone
    assert ("he said no then left", "1", "Negative", "09-03-2020") in got
    assert ("", "0", "Neutral", "11-03-2020") in got
    assert ("a x", "1", "Negative", "05-04-2020") in got
    assert ("b", "1", "Negative", "06-04-2020") in got  # the mean's sign
    kept = prepare.from_scores(scored, impute=False).where("OriginalTweet = 'B'").first()
    assert kept["Sentiments"] == "Neutral"


def test_stream_gives_the_batch_rows(spark):
    source, sink = scratch_path(spark, "in"), scratch_path(spark, "out")
    df = spark.createDataFrame(TWEETS, schemas.TEXTS_FIVE_LEVEL)
    df.write.parquet(source)
    stream = spark.readStream.schema(schemas.TEXTS_FIVE_LEVEL).parquet(source)
    marks = scratch_path(spark, "marks")
    for _ in range(2):  # the second start finds nothing new
        append_stream(clean_stream(stream), sink, marks, until_done=True).awaitTermination(120)
    want = prepare.clean_table(prepare.from_five_levels(df))
    assert sorted(map(tuple, spark.read.parquet(sink).collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_a_retried_append_adds_what_is_missing(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (2, "b")], "id long, v string")
    for kind, place in (("parquet", str(tmp_path / "p")), ("csv", str(tmp_path / "c")), ("table", "append_once_rows")):
        append_once(rows.where("id = 1"), kind, place, "x", "id")
        for batch in ("x", "y", "x", "y"):
            append_once(rows, kind, place, batch, "id")
        schema = StructType.fromDDL("id long, v string, batch string")
        got = sorted(map(tuple, read_source(spark, kind, place, schema).collect()), key=repr)
        assert got == sorted([(r["id"], r["v"], b) for b in "xy" for r in rows.collect()], key=repr)
    drop_table(spark, "append_once_rows")


def test_exact_models_are_saved_and_loaded(spark, tmp_path):
    terms = spark.createDataFrame([("a", [0.1, -2.0]), ("b", [0.3, 0.4])], "term string, weights array<double>")
    save_term_model(models.TermModel(["x", "y"], [-0.5, -1.5], terms), str(tmp_path / "m"))
    save_term_model(models.TermModel(["x", "y"], [-0.5, -1.25], terms), str(tmp_path / "m"))
    model = load_term_model(spark, str(tmp_path / "m"))
    assert (model.classes, model.base) == (["x", "y"], [-0.5, -1.25])
    assert sorted(map(tuple, model.terms.collect())) == sorted(map(tuple, terms.collect()))
    save_term_model(features.TfIdf(spark.createDataFrame([("a", 1.5)], "term string, idf double")), str(tmp_path / "t"))
    assert load_term_model(spark, str(tmp_path / "t")).terms.collect()[0]["idf"] == 1.5

"""Appending to collections and tables, CSV extracts, dropping, and fitted models."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml import Model, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verbatide.operators.features import TfIdf
from verbatide.operators.models import TermModel
from verbatide.operators.rowsets import with_row_index
from verbatide.sources.readers import CSV_OPTIONS, FILE_FORMATS, collection_options, read_source, source_exists


def append_rows(
    df: DataFrame,
    kind: str,
    location: str,
    index_by: str | None = None,
    options: Mapping[str, str] | None = None,
) -> None:
    """Append to files, a catalog table or a collection, written by the executors. With
    ``index_by``, rows first get a dense ``index`` in that column's order."""
    if index_by:
        df = with_row_index(df, index_by)
    options = dict(options or {})
    if kind == "table":
        df.write.options(**options).mode("append").saveAsTable(location)
        return
    if kind == "mongodb":
        database, _, collection = location.partition(".")
        options = {**collection_options(database, collection), **options}
        df.write.format(kind).options(**options).mode("append").save()
        return
    if kind not in FILE_FORMATS:
        raise ValueError(f"unknown kind of sink: {kind}")
    if kind == "csv":
        options = {**CSV_OPTIONS, **options}
    df.write.format(kind).options(**options).mode("append").save(location)


def append_once(
    df: DataFrame, kind: str, location: str, batch: str, key: str | Sequence[str], options: Mapping[str, str] | None = None
) -> None:
    """Append the rows of one batch, with its name in the column ``batch``. A retry under the same name adds nothing, and after
    a run that was ended only the rows that are missing: rows whose ``key`` the batch has there already are left out."""
    keys = [key] if isinstance(key, str) else list(key)
    spark, fresh = df.sparkSession, df.withColumn("batch", F.lit(batch))
    if source_exists(spark, kind, location):
        there = read_source(spark, kind, location, fresh.schema, options).where(F.col("batch") == batch).select(*keys)
        same = reduce(lambda a, b: a & b, [fresh[k].eqNullSafe(there[k]) for k in keys])
        fresh = fresh.join(there, same, "left_anti")
    append_rows(fresh, kind, location, options=options)


def save_csv(df: DataFrame, columns: Sequence[str], path: str, options: Mapping[str, str] | None = None) -> None:
    """Write chosen columns as CSV with header, in UTF-8 or the encoding named in ``options``.
    Characters that the encoding does not have raise."""
    chosen = {**CSV_OPTIONS, "quoteAll": "true", **dict(options or {})}
    rows = df.select(*columns)
    encoding = chosen["encoding"]
    if encoding.upper() != "UTF-8":
        texts = [f.name for f in rows.schema if f.dataType.simpleString() == "string"]
        rows = rows.withColumns({t: F.decode(F.encode(t, encoding), encoding) for t in texts})
    rows.write.options(**chosen).mode("overwrite").csv(path)


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a table and its data, whether the catalog or the caller chose their place. A view's
    sources stay."""
    # Column names and identifiers are quoted, so a name is never read as SQL.
    parts = ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))
    place = None
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType == "EXTERNAL":
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {parts}").where("col_name = 'Location'")
        place = next((row["data_type"] for row in rows.collect()), None)
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).isTemporary:
        spark.catalog.dropTempView(name)
        return
    spark.sql(f"DROP TABLE IF EXISTS {parts}")
    if place:
        path = spark._jvm.org.apache.hadoop.fs.Path(place)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def save_model(model: Model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def save_term_model(model: TermModel | TfIdf, path: str) -> None:
    """Save an exact model: its terms as Parquet, the rest as one row of JSON."""
    head = {"kind": type(model).__name__}
    if isinstance(model, TermModel):
        head |= {"classes": model.classes, "base": model.base}
    spark = model.terms.sparkSession
    model.terms.write.mode("overwrite").parquet(f"{path}/terms")
    spark.createDataFrame([(json.dumps(head),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/head")


def load_term_model(spark: SparkSession, path: str) -> TermModel | TfIdf:
    """What ``save_term_model`` saved; the terms stay a table."""
    head, terms = json.loads(spark.read.text(f"{path}/head").first()["value"]), spark.read.parquet(f"{path}/terms")
    return TfIdf(terms) if head["kind"] == "TfIdf" else TermModel(head["classes"], head["base"], terms)

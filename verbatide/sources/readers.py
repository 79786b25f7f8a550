"""One entry for all inputs: files, catalog tables and document collections."""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

FILE_FORMATS = ("csv", "parquet", "json", "orc")
URI_VARIABLE = "MONGODB_URI"

# UTF-8 text with header, for reading and writing alike; Latin-1 files are asked for by name. Fields
# may hold quotes and line breaks, rows may end in LF or CRLF, rows with too few or too many fields raise. Such
# files cannot be split, so big inputs should come as many files, or with multiLine off where no field spans lines.
CSV_OPTIONS = {
    "header": "true",
    "encoding": "UTF-8",
    "multiLine": "true",
    "quote": '"',
    "escape": '"',
    "enforceSchema": "false",
    "mode": "FAILFAST",
}
LATIN_1 = {"encoding": "ISO-8859-1"}


def collection_options(database: str, collection: str, uri: str | None = None) -> dict[str, str]:
    """Connector options of a document collection. The URI, which holds credentials, is taken from
    the environment and never from code."""
    options = {"database": database, "collection": collection}
    uri = uri or os.environ.get(URI_VARIABLE)
    return {**options, "connection.uri": uri} if uri else options


def read_source(
    spark: SparkSession,
    kind: str,
    location: str,
    schema: StructType | None = None,
    options: Mapping[str, str] | None = None,
    infer: bool = False,
) -> DataFrame:
    """``kind`` is a file format, ``table``, or ``mongodb`` with ``location`` ``database.collection``.

    Text formats need a schema unless ``infer`` asks for a pass over the data to guess one.
    """
    options = dict(options or {})
    if kind == "table":
        return spark.table(location)
    if kind == "mongodb":
        database, _, collection = location.partition(".")
        reader = spark.read.format(kind).options(**{**collection_options(database, collection), **options})
        return (reader.schema(schema) if schema else reader).load()
    if kind not in FILE_FORMATS:
        raise ValueError(f"unknown kind of source: {kind}")
    if kind == "csv":
        options = {**CSV_OPTIONS, **options}
    reader = spark.read.format(kind)
    if schema is not None:
        reader = reader.schema(schema)
    elif kind in ("csv", "json"):
        if not infer:
            raise ValueError(f"{kind} needs a schema, or infer=True")
        options["inferSchema"] = "true"
    return reader.options(**options).load(location)


def source_exists(spark: SparkSession, kind: str, location: str) -> bool:
    """Whether there is something to read. A collection that is not there reads as empty, so it counts as there."""
    if kind == "table":
        return spark.catalog.tableExists(location)
    if kind == "mongodb":
        return True
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(path)

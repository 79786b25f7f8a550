"""Line de-duplication over levelled sorted runs of line hashes.

A run is a table of (key, n_docs, last), bucketed and sorted by key: how many documents hold a line, and
the largest document id among them. A new batch is merge-anti-joined with all runs: its unseen keys become
a run of level 0, its seen keys a run of updates. Runs of lines therefore never share a key. Two runs of one level are
merged into one of the next, so each key is rewritten a number of times that grows with the logarithm of the number
of batches; updates are merged likewise, by adding, and are applied to the lines at the end. All these joins are
sort-merge joins of equally bucketed tables, which move no rows. Everything is SQL functions; keys are 128-bit hashes. A line that a third of all documents share is one row per task once it is counted,
and meets its occurrences by a broadcast of at most ``HOT_SHARE`` keys.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verbatide.llm.common import LOWER, SPACE, UPPER, Scratch, delete, free_names

HOT_SHARE = 20_000  # keys holding over 1/20000 of all occurrences; by counting, fewer than 20000
BATCHES = 4


def lines_of(text: str) -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def line_keys(text: str, min_chars: int) -> Column:
    """Per line a 128-bit hash of the stripped line in lower-case A-Z, null for short lines."""
    lines = F.split(F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER), "\n", -1)

    def key(line: Column) -> Column:
        bare = F.btrim(line, F.lit(SPACE))
        return F.when(F.char_length(bare) >= min_chars, F.base64(F.unhex(F.md5(bare))))

    return F.transform(lines, key)


class LineRuns:
    """The runs of one corpus; in ``lines`` and ``updates`` level i is a (table name, path) or None."""

    def __init__(self, spark: SparkSession, buckets: int | None = None):
        self.spark = spark
        self.scratch = Scratch(spark, "runs")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.lines: list[tuple[str, str] | None] = []
        self.updates: list[tuple[str, str] | None] = []

    def _write(self, rows: DataFrame) -> tuple[str, str]:
        name, path = f"run_{uuid.uuid4().hex}", self.scratch.path("run")
        writer = rows.write.bucketBy(self.buckets, "key").sortBy("key").option("path", path)
        writer.saveAsTable(name)
        return name, path

    def _drop(self, *runs: tuple[str, str]) -> None:
        for name, path in runs:
            self.spark.sql(f"DROP TABLE {name}")
            delete(self.spark, path)

    def fresh(self, batch: DataFrame) -> DataFrame:
        """The rows of ``batch`` whose ``key`` is in no run."""
        for run in filter(None, self.lines):
            batch = batch.join(self.spark.table(run[0]).hint("merge"), "key", "left_anti")
        return batch

    def add(self, counts: DataFrame) -> None:
        """Add a batch's distinct (key, n_docs, last)."""
        batch = self._write(counts.repartition(self.buckets, "key"))
        if not any(self.lines):
            self._push(self.lines, batch)
            return
        unseen = self._write(self.fresh(self.spark.table(batch[0])))
        seen = self.spark.table(batch[0]).join(self.spark.table(unseen[0]).hint("merge"), "key", "left_anti")
        self._push(self.updates, self._write(seen))
        self._push(self.lines, unseen)
        self._drop(batch)

    def _push(self, levels: list[tuple[str, str] | None], run: tuple[str, str]) -> None:
        """Add a run at level 0, merging runs of equal level."""
        level = 0
        while level < len(levels) and levels[level]:
            older = levels[level]
            merged = self._write(self._merge(older[0], run[0]))
            self._drop(older, run)
            levels[level], run, level = None, merged, level + 1
        if level == len(levels):
            levels.append(None)
        levels[level] = run

    def _merge(self, one: str, two: str) -> DataFrame:
        a, b = self.spark.table(one).alias("a"), self.spark.table(two).alias("b")
        joined = a.hint("merge").join(b, F.col("a.key") == F.col("b.key"), "full_outer")
        n = F.coalesce(F.col("a.n_docs"), F.lit(0)) + F.coalesce(F.col("b.n_docs"), F.lit(0))
        key = F.coalesce(F.col("a.key"), F.col("b.key")).alias("key")
        return joined.select(key, n.alias("n_docs"), F.greatest("a.last", "b.last").alias("last"))

    def drop(self) -> None:
        """Delete all runs."""
        self._drop(*filter(None, [*self.lines, *self.updates]))
        self.lines, self.updates = [], []

    def compact(self) -> DataFrame:
        """All runs merged into one, with the updates applied."""
        runs = [run for run in [*self.lines, *self.updates] if run]
        while len(runs) > 1:
            one, two = runs.pop(0), runs.pop(0)
            runs.insert(0, self._write(self._merge(one[0], two[0])))
            self._drop(one, two)
        self.lines, self.updates = runs[:], []
        return self.spark.table(runs[0][0])


def dedup_lines(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_docs: int = 3,
    min_chars: int = 20,
    batches: int = BATCHES,
) -> DataFrame:
    """All rows and columns of ``docs`` with ``kept`` (the text left), ``n_lines`` and ``n_dropped``.

    A line whose key has at least ``min_chars`` characters and is found in at least ``min_docs``
    documents stays only in the documents with the largest id that holds it, there at every place. Every row
    counts as a document, repeated rows too, and all rows with that largest id keep the line; a null
    id is smaller than any other, and rows with null ids keep a line that no other row holds. Null
    and empty texts are one empty line. An empty table gives an empty result. Columns of ``docs`` with the new names are replaced.
    """
    spark = docs.sparkSession
    docs = docs.drop("kept", "n_lines", "n_dropped")
    scratch, runs = Scratch(spark, "lines"), LineRuns(spark)
    identity = F.xxhash64(F.col(text))
    batch = F.pmod(F.xxhash64(F.col(doc_id), identity), F.lit(batches)).cast("int")
    held = scratch.store(
        docs.select(
            F.col(doc_id).alias("_id"), identity.alias("_text"), batch.alias("_batch"), line_keys(text, min_chars).alias("_keys")
        ),
        "keys",
    )
    for number in range(batches):
        distinct = F.explode(F.array_distinct("_keys")).alias("key")
        rows = held.where(F.col("_batch") == number).select("_id", distinct).where(F.col("key").isNotNull())
        runs.add(rows.groupBy("key").agg(F.count("*").alias("n_docs"), F.max("_id").alias("last")))
    counted = runs.compact()
    shared = scratch.store(counted.where(F.col("n_docs") >= min_docs), "shared")
    total = counted.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n")).first()["n"]
    hot = shared.where(F.col("n_docs") * HOT_SHARE > total)
    cold = shared.where(F.col("n_docs") * HOT_SHARE <= total)
    places = held.select("_id", "_text", F.posexplode("_keys").alias("_at", "key")).where(F.col("key").isNotNull())
    elsewhere = ~F.col("_id").eqNullSafe(F.col("last"))
    common = places.join(F.broadcast(hot.select("key", "last")), "key").where(elsewhere)
    others = places.join(F.broadcast(hot.select("key")), "key", "left_anti")
    rare = others.join(cold.select("key", "last"), "key").where(elsewhere)
    id_, text_, drop, same, lines_ = free_names(docs.columns, "id text drop same lines")
    dropped = common.unionByName(rare).groupBy("_id", "_text").agg(F.collect_set("_at").alias("_drop"))
    dropped = dropped.select(F.col("_id").alias(id_), F.col("_text").alias(text_), F.col("_drop").alias(drop))
    dropped = scratch.store(dropped, "dropped")  # what the result reads besides the documents
    scratch.drop(held, shared)
    runs.drop()
    found = docs.withColumn(same, identity).join(
        dropped, F.col(doc_id).eqNullSafe(F.col(id_)) & (F.col(same) == F.col(text_)), "left"
    )
    lines = F.col(lines_)
    left = F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(drop)), lambda i: F.get(lines, i))
    plain = F.coalesce(F.col(text), F.lit(""))
    return (
        found.withColumn(lines_, lines_of(text))
        .withColumn("kept", F.when(F.col(drop).isNull(), plain).otherwise(F.concat_ws("\n", left)))
        .withColumn("n_lines", F.size(lines).cast("long"))
        .withColumn("n_dropped", F.coalesce(F.size(drop), F.lit(0)).cast("long"))
        .drop(id_, text_, same, drop, lines_)
    )

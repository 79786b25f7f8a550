"""Helpers shared by the operators: stored intermediate tables, words, bytes of texts."""

from __future__ import annotations

import gc
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verbatide.session import scratch_path

# The capital letters A-Z and the white space of the word contracts.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
SPACE = " \t\n\x0b\f\r"
ASCII_LOWER = str.maketrans(UPPER, LOWER)


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, as UTF-8 bytes.

    ``bytes.split`` and ``bytes.lower`` use exactly these sets; ``str`` methods use larger ones.
    """
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


class Scratch:
    """Intermediate tables in the shared folder; ``drop`` deletes those no longer read.

    A written table cuts lineage and outlives executors. What a returned DataFrame still reads is
    not dropped by the operator: a Spark result is lazy. Its folder is named by the caller's
    ``spark.checkpoint.dir``.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = scratch_path(spark, name)
        self._n = 0

    def path(self, name: str) -> str:
        self._n += 1
        return f"{self.root}/{self._n}-{name}"

    def store(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        stored = self.spark.read.schema(df.schema).parquet(path)
        stored._scratch_path = path
        return stored

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            delete(self.spark, table._scratch_path)

    def release(self) -> None:
        """Let Spark delete the shuffle files of finished queries.

        It does so when the driver's garbage collector finds that nothing refers to them; a driver
        with little to do may not collect for hours, while executors' disks fill.
        """
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """Write one file to the shared file system."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(where, True)
    out.write(bytearray(data))
    out.close()


def free_names(taken: Iterable[str], wanted: str) -> list[str]:
    """For each word of ``wanted`` a column name made from it that is not ``taken``; case does not tell names apart."""
    used, found = {name.lower() for name in taken}, []
    for word in wanted.split():
        name = f"_{word}"
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        found.append(name)
    return found


def commonest(counts: DataFrame, most: int, n: str = "n") -> DataFrame:
    """Rows of ``counts`` with the largest ``n``, at most ``most``; rows of about equal ``n`` stay together.

    A histogram over powers of 2^(1/16), at most 1024 rows, shows where to cut, so neither the driver
    nor a task meets more than the rows chosen.
    """
    step = F.floor(F.log2(F.col(n).cast("double")) * 16)
    sizes = counts.groupBy(step.alias("step")).agg(F.count("*").alias("rows")).collect()
    total, cut = 0, None
    for row in sorted(sizes, key=lambda r: -r["step"]):
        total += row["rows"]
        if total > most:
            break
        cut = row["step"]
    return counts.where(step >= cut) if cut is not None else counts.where(F.lit(False))


def crc_mod(column: Column, divisor: int) -> Column:
    """crc32 of the number written as text, modulo ``divisor``; a null id counts as empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit(""))) % divisor


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """64 bits that tell rows of one id but different texts apart."""
    return F.xxhash64(F.col(doc_id), F.col(text))

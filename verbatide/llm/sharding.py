"""Sharding by a two-pass external shuffle, in SQL functions only.

* The first pass scatters the rows into buckets by a seeded hash; there are as many buckets as
  memory-sized pieces of the input. Rows travel once. Spark's sort puts a bucket in the order of the hash and
  can spill, so neither a very long text nor a bucket that chance made large has to fit into memory.
* In the second pass the places of every bucket are put in the order of a Fisher-Yates shuffle (Spark's seeded
  ``shuffle`` of the sequence of places), and the bucket is written in that order. The buckets
  after each other are one random order of all rows.

Under the law ``rows`` that order is cut into shards whose counts differ by at most one. Under ``key`` a shard is the one
with the largest hash of (id, shard), whatever other rows there are, so one more shard takes rows only into
itself; buckets then lie within shards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verbatide.llm.common import Scratch, free_names

SEED = 20
OVERHEAD = 16  # bytes of a row besides its text
BUCKET_BYTES = 16 << 20
DEALT = 256  # partitions in which places are shuffled: fixed, so that one seed gives one order on any cluster
LAWS = ("rows", "key")


def key_shard(doc_id: Column, shards: int, seed: int = SEED) -> Column:
    """The shard with the largest hash of (id, shard)."""
    weights = [F.struct(F.xxhash64(F.lit(seed), doc_id, F.lit(s)).alias("w"), F.lit(s).alias("s")) for s in range(shards)]
    return F.array_max(F.array(*weights))["s"]


def _div(x: Column, y: int) -> Column:
    return F.call_function("div", x, F.lit(y).cast("long"))


def _first_places(counts: DataFrame) -> DataFrame:
    """``counts(part, bucket, n)`` with ``first``, the number of rows in the earlier buckets of the part.

    Buckets are summed in blocks first, so no window holds more than a thousandth of them.
    """
    blocks = counts.withColumn("block", F.floor(F.col("bucket") / 1024))
    until = Window.unboundedPreceding, -1
    sums = blocks.groupBy("part", "block").agg(F.sum("n").alias("all"))
    base = F.coalesce(F.sum("all").over(Window.partitionBy("part").orderBy("block").rowsBetween(*until)), F.lit(0))
    own = F.coalesce(F.sum("n").over(Window.partitionBy("part", "block").orderBy("bucket").rowsBetween(*until)), F.lit(0))
    placed = blocks.join(sums.select("part", "block", base.alias("base")), ["part", "block"])
    return placed.select("bucket", "n", (own + F.col("base")).cast("long").alias("first"))


def shard_texts(
    docs: DataFrame,
    shards: int,
    law: str = "rows",
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
    doc_id: str = "doc_id",
    text: str = "text",
    path: str | None = None,
) -> DataFrame:
    """The rows and columns of ``docs`` as written, with ``size`` (UTF-8 bytes of the text and 16 more),
    ``grown_shard`` (under ``key`` the shard if there were one more), ``shard`` and ``slot`` (0, 1, ... within the shard).

    The shards are Parquet folders ``shard=0`` and so on in ``path`` (by default in the shared folder), every file in the order
    of its slots. Each row is placed once. A null text has size 16 and a null id is a value like any other. Copies
    of a text and repeated ids are spread like other rows (under ``key`` an id has one shard); rows equal in id and text share a
    bucket. An empty table gives an empty result. Columns of ``docs`` that have the new names are replaced.
    """
    if law not in LAWS:
        raise ValueError(f"law is one of {', '.join(LAWS)}")
    if shards < 1:
        raise ValueError("at least one shard")
    spark = docs.sparkSession
    scratch = Scratch(spark, "shards")
    docs = docs.drop("size", "grown_shard", "shard", "slot")
    tie, part, bucket, first, places, place, at = free_names(docs.columns, "tie part bucket first places place at")
    size = (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + OVERHEAD).cast("long")
    facts = docs.agg(F.count("*").alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()
    pieces = max(1, -(-facts["bytes"] // bucket_bytes))

    own, grown = F.lit(0), F.lit(None).cast("int")
    if law == "key":
        own, grown = (key_shard(F.col(doc_id), count, seed) for count in (shards, shards + 1))
        pieces = -(-pieces // shards)
    rows = docs.withColumns({"size": size, "grown_shard": grown, part: own, tie: F.xxhash64(F.lit(seed), doc_id, text)})
    scattered = F.pmod(F.xxhash64(F.lit(seed), F.col(tie)), F.lit(pieces))
    rows = rows.withColumn(bucket, F.col(part).cast("long") * pieces + scattered)

    counts = rows.groupBy(F.col(part).alias("part"), F.col(bucket).alias("bucket")).agg(F.count("*").alias("n"))
    starts = _first_places(scratch.store(counts, "counts"))
    # Spark adds the number of the partition to the seed, so buckets are dealt by their own number.
    dealt = starts.repartitionById(DEALT, (F.col("bucket") % DEALT).cast("int")).sortWithinPartitions("bucket")
    shuffled = F.shuffle(F.sequence(F.lit(0), (F.col("n") - 1).cast("int")), F.lit(seed))
    orders = scratch.store(dealt.select(F.col("bucket").alias(bucket), F.col("first").alias(first), shuffled.alias(places)), "orders")

    rows = rows.withColumn(place, F.row_number().over(Window.partitionBy(bucket).orderBy(tie, "size")) - 1)
    rows = rows.join(orders, bucket).withColumn(at, (F.col(first) + F.get(F.col(places), F.col(place))).cast("long"))
    if law == "key":
        rows = rows.withColumns({"shard": F.col(part), "slot": F.col(at)})
    else:
        rows = rows.withColumn("shard", _div(F.col(at) * shards, max(1, facts["n"])).cast("int"))
        begin = _div(F.col("shard").cast("long") * facts["n"] + (shards - 1), shards)
        rows = rows.withColumn("slot", F.col(at) - begin)
    columns = [*docs.columns, "size", "grown_shard", "shard", "slot"]
    rows, target = rows.select(*columns), path or scratch.path("written")
    rows.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(target)
    return spark.read.schema(rows.schema).parquet(target).select(*columns)
